"""Operator 13, packing by first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

Documents become token ids and an end id. Whole sequences' worth of ids are cut off the front of a longer document and stand for
themselves; what remains (shorter than a sequence) is dealt to random groups of about ``group_rows`` and packed there without
the others: longest first, each into the first bin with room, which a tree of the bins' greatest rooms gives in O(log bins).

First fit leaves room in some bins. A sequence is padded to ``capacity`` unless its length is a power of two, so a bin is done
when it is full or at such a length. The room in the others is closed by giving away the emptiest bins' pieces, cut where they
don't fit; that is the only place where a document that fits into a sequence is cut. Of each group at most one bin is left,
which is cut at powers of two into sequences without padding.

Lengths alone are shuffled. The ids themselves stay in the written pieces and meet only the pieces that were cut.

Defined results: a null or empty text is the end id alone; repeated rows are packed as often as they stand; an empty table gives
an empty result; other columns are ignored; a null doc_id stays null.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written

CAPACITY, GROUP_ROWS, END_ID = 2048, 20_000, 1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACES = "row long, doc_id long, start long, first long, length long, piece_length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def first_fit_packing(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                      capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = texts.mapInArrow(_piece_mapper(tokenizer or tokenizer_path(), capacity, end_id), PIECES)
    pieces = written(spark, cut.withColumn("row", F.monotonically_increasing_id()), "op13-pieces")
    rests = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rests.count() // group_rows))
    dealt = rests.select("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"))
    placed = written(spark, dealt.groupBy("group").applyInPandas(_packer(capacity), PLACES), "op13-places")
    whole = F.col("length") == F.col("piece_length")
    parts = written(spark, placed.filter(~whole).drop("ids_crc32"), "op13-parts")
    checked = parts.join(rests.select("row", "ids"), "row").mapInArrow(_part_crc, ", ".join(f"{c} long" for c in RESULT))
    return (pieces.filter(F.col("length") == capacity)
            .select(*RESULT[:5], F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
            .unionByName(placed.filter(whole).select(*RESULT)).unionByName(checked))


def _byte_values() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves, the others follow U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteIds:
    """Token ids of texts by a byte-level vocabulary file.

    Where the file's rules are the plain ones (no normaliser, byte-level split by its usual pattern, ids in the order of merges),
    texts of Latin letters and ASCII signs go through a faster encoder over the same vocabulary, with the same ids. Texts with other
    characters, whose classes might differ between the two, or with a special token's string go through the file's own encoder.
    """

    LATIN = 0xC9  # lead byte of U+0240; below it are ASCII, Latin-1 and Latin Extended-A

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.own, self.fast, self.special = Tokenizer.from_file(path), None, []
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        model, split = rules["model"], rules["pre_tokenizer"] or {}
        self.special = [t["content"].encode() for t in rules["added_tokens"]]
        usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if rules["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout") and usual:
            self.fast = self._encoder(model, {t["content"] for t in rules["added_tokens"]})

    @staticmethod
    def _encoder(model: dict, special: set[str]):
        import public_tokenizers
        import tiktoken

        byte = _byte_values()
        ranks = {bytes(byte[c] for c in token): n for token, n in model["vocab"].items() if token not in special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in pairs]
        if made != sorted(made) or len(made) + 256 != len(ranks):
            return None
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str, raw: np.ndarray) -> np.ndarray:
        if self.fast is not None and (not len(raw) or int(raw.max()) < self.LATIN):
            held = raw.tobytes()
            if not any(s in held for s in self.special):
                try:
                    return self.fast.encode_to_numpy(text, disallowed_special=())
                except ValueError:  # its pattern engine refuses extremely long unbroken texts
                    pass
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)


def _piece_mapper(path: str, capacity: int, end_id: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ByteIds(path)
        for batch in A.chunks(batches):
            data, offsets = A.buffers(batch.column("text"))
            rows: list[list] = [[], [], [], [], [], []]
            for k, (doc, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                ids = np.append(encode(text or "", data[offsets[k]:offsets[k + 1]]), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity].tobytes()
                    size = len(part) // 4
                    for column, value in zip(rows, (doc, start, size, zlib.crc32(part), len(ids), part if size < capacity else None), strict=True):
                        column.append(value)
            kinds = (pa.int64(),) * 5 + (pa.binary(),)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return emit


class RoomTree:
    """Tournament tree over bins in order: each inner node holds the greatest room below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def first(self, size: int) -> int:
        """The first bin with room for ``size``; there has to be one."""
        at, room = 1, self.room
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        return at - self.leaves

    def take(self, bin: int, size: int) -> int:
        """Fill ``size`` of the bin; the place where it begins is the room before."""
        at, room = bin + self.leaves, self.room
        before = room[at]
        room[at] = before - size
        while at > 1:
            at //= 2
            best = room[2 * at] if room[2 * at] >= room[2 * at + 1] else room[2 * at + 1]
            if room[at] == best:
                break
            room[at] = best
        return before


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: longest first (ties in the given order), each into the first bin it fits."""
    bins, tree = np.zeros(len(lengths), np.int64), RoomTree(len(lengths), capacity)
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        bins[i] = at = tree.first(size)
        tree.take(at, size)
    return bins


def close_rooms(bins: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Bins of (item, first, length) parts without padding: full, or at a power of two.

    The emptiest bins' parts fill the room of the others, the fullest first; a part is cut where no whole one fits. The one bin that
    is left over is cut at powers of two.
    """
    def total(parts: list[tuple[int, int, int]]) -> int:
        return sum(n for _, _, n in parts)

    done = [b for b in bins if total(b) == capacity or total(b).bit_count() == 1]
    open_bins = sorted((b for b in bins if total(b) < capacity and total(b).bit_count() > 1), key=lambda b: -total(b))
    lo, hi = 0, len(open_bins) - 1
    while lo < hi:
        taker, giver = open_bins[lo], open_bins[hi]
        room = capacity - total(taker)
        while room and giver:
            whole = [p for p in giver if p[2] <= room]
            part = max(whole, key=lambda p: p[2]) if whole else min(giver, key=lambda p: p[2])
            giver.remove(part)
            item, first, n = part
            if n > room:
                giver.append((item, first + room, n - room))
                n = room
            taker.append((item, first, n))
            room -= n
        if not room:
            done.append(taker)
            lo += 1
        if not giver:
            hi -= 1
    if lo == hi and open_bins[lo]:
        rest, left = sorted(open_bins[lo], key=lambda p: -p[2]), total(open_bins[lo])
        while left:
            size = 1 << (left.bit_length() - 1)
            left, want, sequence = left - size, size, []
            while want:
                item, first, n = rest.pop(0)
                if n > want:
                    rest.insert(0, (item, first + want, n - want))
                    n = want
                sequence.append((item, first, n))
                want -= n
            done.append(sequence)
    return done


def _packer(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)  # the same result whatever order the rows arrive in
        lengths = rows["length"].to_numpy()
        held: dict[int, list[tuple[int, int, int]]] = {}
        for i, (at, n) in enumerate(zip(first_fit_decreasing(lengths, capacity).tolist(), lengths.tolist(), strict=True)):
            held.setdefault(at, []).append((i, 0, n))
        parts = [(i, first, n, s, place) for s, sequence in enumerate(close_rooms(list(held.values()), capacity)) for (i, first, n), place in
                 zip(sequence, np.cumsum([0] + [p[2] for p in sequence]).tolist(), strict=False)]
        item, first, n, sequence, place = (np.array(c, np.int64) for c in zip(*parts, strict=True))
        own = rows.iloc[item].reset_index(drop=True)
        # numbers below 0: those of the whole sequences are row numbers from 0 on
        return pd.DataFrame({
            "row": own["row"], "doc_id": own["doc_id"], "start": own["start"] + first, "first": first, "length": n, "piece_length": own["length"],
            "ids_crc32": own["ids_crc32"], "doc_tokens": own["doc_tokens"], "sequence_id": -1 - ((int(rows["group"].iloc[0]) << 24) + sequence), "offset": place})

    return pack


def _part_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = zip(batch.column("ids"), batch.column("first").to_pylist(), batch.column("length").to_pylist(), strict=True)
        crc = [zlib.crc32(memoryview(ids.as_buffer())[4 * first:4 * (first + n)]) for ids, first, n in spans]
        yield pa.RecordBatch.from_arrays([pa.array(crc, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in RESULT], names=RESULT)
