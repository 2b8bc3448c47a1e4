"""Operator 2, best-fit packing: bound-certified repacking.

Documents become token ids, documents longer than a sequence are cut, and the pieces are dealt to
groups of about ``group_rows``. Each group is packed by best-fit decreasing and its bin count is
compared with a lower bound from dual feasible functions. A group that meets its bound can't be
packed better on its own: only its one unfilled rest goes on. A group with a gap gives up all bins
that aren't full. What was given up is dealt anew to fewer groups and packed again, until one group
is left or the rounds are over.

Defined results: a null or empty text is the single id 0; repeated rows are packed as often as they
stand; an empty table gives an empty result; other columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written

CAPACITY, GROUP_ROWS, ROUNDS, CACHED_WORDS = 2048, 20_000, 4, 800_000
JOINED_WORDS = 256  # words encoded as one text
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def best_fit_packing(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                     capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = written(spark, texts.mapInArrow(_piece_mapper(tokenizer or tokenizer_path(), capacity), PIECES), "op2-pieces")
    done, rows = None, pieces.count()
    for turn in range(rounds):
        groups = max(1, -(-rows // group_rows))
        last = groups == 1 or turn == rounds - 1
        # The rows come from written files, so their numbers are the same however often a task runs; equal rows spread evenly.
        dealt = pieces.select(*PIECES_COLS, F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(turn)), F.lit(groups)).alias("group"))
        packed = written(spark, dealt.groupBy("group").applyInPandas(
            _packer(turn, capacity, last), PIECES + ", sequence_id long, offset long, certified boolean, open boolean"), f"op2-round{turn}")
        closed = packed.filter("not open").drop("open")
        done = closed if done is None else done.unionByName(closed)
        pieces = packed.filter("open").select(*PIECES_COLS)
        if last or not (rows := pieces.count()):
            break
    return done


PIECES_COLS = ["doc_id", "piece", "start", "length", "ids_crc32"]


class WordIds:
    """Token ids of texts, each different word encoded once.

    The vocabulary's own rule splits at white space and drops it, so a text's ids are its words' ids in a row.
    Words of letters alone are one unit of that rule each, and the last id of a unit is marked as such in the
    vocabulary: they are encoded many at a time, joined by spaces, and parted again at those marks.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.plain = Tokenizer(self.tokenizer.model)  # for a-z, which the vocabulary's normaliser and splitting leave as they are
        self.plain.pre_tokenizer = WhitespaceSplit()
        self.last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        if mark := getattr(self.tokenizer.model, "end_of_word_suffix", None):
            self.last[[i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token.endswith(mark)]] = True
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.first, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids in a row, and the offsets of the rows in it."""
        raw = data.tobytes()
        if b"<|" not in raw:  # the case of a special token's string counts
            data = A.ascii_lower(data)
            raw = data.tobytes()
        starts, ends = _units(data, *A.word_spans(data, offsets)[:2])
        first = np.searchsorted(starts, offsets)
        codes, unique = pd.factorize(A.span_hashes(data, starts, ends))
        if len(self.known) > self.cached:
            self._clear()
        keys = unique.tolist()
        number = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            where = np.zeros(len(keys), np.int64)
            where[codes] = np.arange(len(codes))  # some occurrence of each
            at = where[fresh]
            words = [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            order, size, ids = self._encoded(words)
            number[fresh[order]] = np.arange(len(self.size), len(self.size) + len(fresh))
            self.first = np.append(self.first, len(self.flat) + np.cumsum(size) - size)
            self.size = np.append(self.size, size)
            self.flat = np.append(self.flat, ids)
            self.known.update(zip([keys[i] for i in fresh.tolist()], number[fresh].tolist(), strict=True))
        at = number[codes]
        size = self.size[at]
        edge = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(edge[-1]) + np.repeat(self.first[at] - edge[:-1], size)
        return self.flat[place], edge[first]

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words' numbers in the order in which they are encoded, how many ids each has, and the ids in a row."""
        kinds: tuple[list[int], ...] = ([], [], [])
        for i, w in enumerate(words):
            kinds[2 if not w.isalpha() else 0 if w.isascii() and w.islower() else 1].append(i)
        sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        for tokenizer, kind in ((self.plain, kinds[0]), (self.tokenizer, kinds[1])):
            groups = [[words[i] for i in kind[k:k + JOINED_WORDS]] for k in range(0, len(kind), JOINED_WORDS)]
            for group, x in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                own = np.array(x.ids, np.uint32)
                ends = np.flatnonzero(self.last[own]) + 1
                # Each word has one mark at least. More marks than words: some word isn't one unit (its lower case has a sign).
                size, own = (np.diff(ends, prepend=0), own) if len(ends) == len(group) else self._each(group)
                sizes.append(size)
                ids.append(own)
        size, own = self._each([words[i] for i in kinds[2]])
        return np.array([i for kind in kinds for i in kind], np.int64), np.concatenate([*sizes, size]), np.concatenate([*ids, own])

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return size, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a Python worker, which Spark uses again; its cached words are bounded."""
    return WordIds(path)


_LETTER, _TRAIL = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_TRAIL[[ord(c) for c in "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"]] = True  # all ASCII signs but those at the ends of special tokens


def _units(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with the signs at their end cut off as units of their own: the vocabulary's rule parts a letter from the signs after it."""
    signed = np.flatnonzero(_TRAIL[data[ends - 1]])
    if not len(signed):
        return starts, ends
    place = np.flatnonzero(~_TRAIL[data])
    at = np.searchsorted(place, ends[signed])
    cut = np.where(at > 0, place[np.maximum(at - 1, 0)] + 1 if len(place) else 0, 0)
    split = cut > starts[signed]
    split[split] = _LETTER[data[cut[split] - 1]]
    inner = cut[split]
    # Both are sorted runs, which a stable sort merges.
    return np.sort(np.concatenate((starts, inner)), kind="stable"), np.sort(np.concatenate((ends, inner)), kind="stable")


def _piece_mapper(path: str, capacity: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        for batch in A.chunks(batches):
            ids, edges = encode(*A.buffers(batch.column("text")))
            rows: list[list] = [[], [], [], [], []]
            for doc, lo, hi in zip(batch.column("doc_id").to_pylist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = np.append(ids[lo:hi], np.uint32(0)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start:start + capacity]
                    for column, value in zip(rows, (doc, piece, start, len(part), zlib.crc32(part.tobytes())), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=PIECES_COLS)

    return emit


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins: longest first, each into the fullest bin it fits."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0  # bit r of rooms: some bin has r left
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at, used = capacity, used, used + 1
        bins[i], offsets[i] = at, capacity - room
        if left := room - size:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins, offsets, used


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual feasible functions."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, 64):  # x stays where (k + 1) x is whole, else it is rounded down to a multiple of 1 / k
        value = np.where((k + 1) * size % capacity == 0, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    many, total = np.concatenate(([0], np.cumsum(count))), np.concatenate(([0], np.cumsum(count * size)))
    e = np.arange(1, capacity // 2 + 1)  # over capacity - e: a bin each; below e: nothing; between: as it is
    big, middle = many[-1] - many[capacity - e + 1], total[capacity - e + 1] - total[e]
    return max(best, int((big + -(-middle // capacity)).max()))


def _packer(turn: int, capacity: int, last: bool):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        certified = used == lower_bound(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=used)
        # A certified group passes on its emptiest bin alone; one with a gap, every bin that isn't full.
        give = np.zeros(used, bool) if last else (np.arange(used) == fill.argmin()) & (fill < capacity) if certified else fill < capacity
        return rows.drop(columns="group").assign(
            sequence_id=(turn << 58) + (int(rows["group"].iloc[0]) << 24) + bins, offset=offsets, certified=certified, open=give[bins])

    return pack
