"""Operator 4, suffix-array dedup: two-stage suffix sorting of the blocks that may hold repeats.

The index of content-chosen blocks (``repeats``) decides most of the corpus: a block whose anchor
occurs once holds no repeat, a block that occurs unchanged elsewhere is a repeat as a whole. The
blocks left over share an anchor but not all of their surroundings. A repeated string of ``length``
bytes around an anchor reaches at least ``side`` bytes to its left or to its right, so those blocks
meet under the hash of that stretch, and each group's suffixes are sorted in two stages: only
suffixes smaller than their successors are sorted directly, the others are induced by scanning
buckets in order. Neighbours whose common prefix reaches ``length`` are repeats.

Equal blocks are merged before they move. A group of more than ``group_limit`` different blocks is
not put into one task: its windows are counted by hash with map-side aggregation, which gives the
same result for a group of any size.

Defined results: a null text counts as empty and a short text keeps everything; rows that repeat a
doc_id are texts of their own (a full copy is a repeat); a null doc_id is treated like any other
value; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm import repeats as R
from folio.llm.storage import keyed, written

LENGTH, GRAM, GROUP_LIMIT = 400, 32, 2000
SORT_BYTES = 1 << 20  # text looked at once inside a task
SORT_ROWS = 1 << 15  # strings compared at once, and what is equal to the last
PIECES = "side string, meet long, anchor long, doc_id long, crc long, a int, starts int, body binary"


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT, with_text: bool = False) -> DataFrame:
    """One row per document: bytes, removed bytes, maximal removed spans, digest and, on request, ``kept`` bytes."""
    docs = keyed(docs, id_col, text_col)
    known = docs.filter(F.length("text") > 0)
    blocks = known.mapInArrow(R.block_mapper(R.byte_anchors, length, gram), R.BLOCKS)
    # Aggregates are written before they are joined back, so that Spark can split the skewed side of the join.
    repeated = written(spark, blocks.groupBy("anchor").agg(F.count("*").alias("n"), F.min("block").alias("b0"), F.max("block").alias("b1"))
                       .filter("n > 1").select("anchor", (F.col("b0") != F.col("b1")).alias("mixed")), "op4-anchors")
    hits = written(spark, blocks.join(repeated, "anchor"), "op4-hits")
    mixed = written(spark, hits.filter("mixed").drop("mixed"), "op4-mixed")
    copies = written(spark, mixed.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "crc", "a")).alias("one")), "op4-copies")
    marked = written(spark, R.joined_by_count(spark, mixed, copies, ["anchor", "block"], "copies"), "op4-marked")
    whole = (hits.filter("not mixed").select("doc_id", "crc", "a", "b")
             .unionByName(marked.filter("copies > 1").select("doc_id", "crc", "a", "b")))
    # A block that occurs once is searched for; of an often repeated one, one occurrence is there to be found.
    search = (marked.filter((F.col("copies") == 1) | (F.struct("doc_id", "crc", "a") == F.col("one")))
              .select("doc_id", "crc", "a", "b", "anchor"))
    texts = R.compressed(docs)
    pieces = written(spark, R.with_hits(texts, R.per_document(search, "a", "b", "anchor"), "inner")
                     .mapInArrow(_piece_mapper(length, gram), PIECES), "op4-pieces")
    # Groups go to the tasks by one exchange; those too large for a task, at most one in ``group_limit`` rows, are known to all tasks and left out before it.
    met = pieces.groupBy("side", "meet").agg(F.count("*").alias("blocks"))
    large = written(spark, met.filter(F.col("blocks") > group_limit).drop("blocks"), "op4-large")
    sorted_spans = (pieces.join(F.broadcast(large), ["side", "meet"], "left_anti").repartition("side", "meet")
                    .sortWithinPartitions("side", "meet").mapInArrow(_suffix_sorter(length), "doc_id long, crc long, a int, b int"))
    windows = written(spark, pieces.join(F.broadcast(large), ["side", "meet"], "left_semi")
                      .mapInArrow(_window_mapper(length), "anchor long, content long, doc_id long, crc long, a int"), "op4-windows")
    often = written(spark, windows.groupBy("anchor", "content").agg(F.count("*").alias("n")).filter("n > 1"), "op4-often")
    counted = R.joined_by_count(spark, windows, often, ["anchor", "content"], "n").select("doc_id", "crc", "a", F.col("a").alias("b"))
    spans = R.per_document(whole.unionByName(sorted_spans).unionByName(counted), "a", "b")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return R.with_hits(texts, spans, "left").mapInArrow(_cutter(length, with_text), out)


def _piece_mapper(length: int, gram: int):
    """Documents with blocks to look at, to the blocks' bytes under the hashes of their left and right stretch."""
    side = (length - gram) // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.unpacked(batches):
            data, offsets = A.buffers(batch.column("text"))
            row, h = R.nested(batch.column("hits"), batch.num_rows)
            if not len(row):
                continue
            lead, tail = h["a"] + offsets[row], h["b"] + offsets[row]
            grams = A.byte_grams(data, gram.bit_length() - 1)
            at = _anchor_places(grams, lead, tail, h["anchor"], length, gram)
            run = A.RunHash(A.byte_values(data))
            raw = data.tobytes()
            for name, start, stop, a, b in (("L", at - side, at + gram, lead, np.minimum(tail, at - side)),
                                            ("R", at, at + gram + side, np.maximum(lead, at - side + 1), tail)):
                ok = np.flatnonzero(a <= b)
                if not len(ok):
                    continue
                meet = run(start[ok], stop[ok], np.zeros(len(ok), np.int64))
                bodies = [raw[x:y] for x, y in zip(a[ok].tolist(), (b[ok] + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([name] * len(ok)), pa.array(A.signed(meet)), pa.array(h["anchor"][ok]),
                    *A.taken(batch, row[ok], "doc_id", "crc"), pa.array((a - offsets[row])[ok].astype(np.int32)),
                    pa.array((b - a + 1)[ok].astype(np.int32)), pa.array(bodies, pa.binary())],
                    names=["side", "meet", "anchor", "doc_id", "crc", "a", "starts", "body"])

    return emit


def _anchor_places(grams: np.ndarray, lead: np.ndarray, tail: np.ndarray, anchor: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Place of each block's anchor: the leftmost least gram of its first window."""
    order = (grams >> np.uint64(32))
    return A.sliding_argmin(order, length - gram + 1)[lead]


def two_stage_sort(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of ``text`` (codes 0 to 256) by its first ``depth`` codes at least.

    Only suffixes smaller than their successors are sorted as strings; a larger suffix follows from
    the place of its successor when the buckets of first codes are scanned upwards.
    """
    n = len(text)
    # smaller than the successor? a run of equal codes goes by its end, and the last suffix is larger
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1].astype(np.int32))
    step[-1] = -1
    known = np.flatnonzero(step)
    smaller = step[known[np.searchsorted(known, np.arange(n))]] > 0
    mine, fresh = _sort_directly(text, np.flatnonzero(smaller), depth)
    return _induce(text, smaller, mine, fresh, np.unique(text))[0]


def _sort_directly(text: np.ndarray, direct: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``direct`` by their first ``depth`` codes, and which of them differ there from the one before."""
    padded = np.zeros(len(text) + 7, np.uint64)
    padded[:len(text)] = text + np.uint64(1)
    key = padded[direct]  # the first seven codes (1..256, 0 past the end) fit one number
    for j in range(1, 7):
        key = (key << np.uint64(9)) | padded[direct + j]
    sort = np.argsort(key, kind="stable")
    mine, key = direct[sort], key[sort]
    fresh = np.ones(len(mine), bool)
    fresh[1:] = key[1:] != key[:-1]
    # Those that are equal so far are compared as whole strings, some runs of equal ones at a time.
    tied = ~fresh
    tied[:-1] |= ~fresh[1:]
    at = np.flatnonzero(tied)
    width = 1 if len(text) and text.max() < 256 else 2
    raw = text.astype(np.uint8 if width == 1 else ">u2").tobytes()
    heads = np.flatnonzero(fresh[at])
    start = 0
    while start < len(at):
        more = heads[np.searchsorted(heads, start + SORT_ROWS):]
        stop = int(more[0]) if len(more) else len(at)
        some = at[start:stop]
        strings = [(raw[i * width:(i + depth) * width], i) for i in mine[some].tolist()]
        strings.sort(key=itemgetter(0))
        mine[some] = [i for _, i in strings]
        fresh[some] = [True, *[x[0] != y[0] for x, y in pairwise(strings)]]
        start = stop
    return mine, fresh


def _induce(text: np.ndarray, smaller: np.ndarray, mine: np.ndarray, fresh: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole order and ranks from the sorted smaller suffixes: scan buckets upwards, place each larger predecessor."""
    n = len(text)
    own = np.searchsorted(text[mine], codes, side="left"), np.searchsorted(text[mine], codes, side="right")
    waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    order_parts, new_parts = [], []

    def place(at: np.ndarray, new: np.ndarray) -> None:
        """Append suffixes in order, and queue their larger predecessors by first code."""
        order_parts.append(at)
        new_parts.append(new)
        group = np.cumsum(new)
        ok = (at > 0) & ~smaller[at - 1]
        before, group = at[ok] - 1, group[ok]
        heads = text[before]
        sort = np.argsort(heads, kind="stable")
        before, heads, group = before[sort], heads[sort], group[sort]
        first = np.ones(len(before), bool)
        first[1:] = (heads[1:] != heads[:-1]) | (group[1:] != group[:-1])
        cut = [0, *(np.flatnonzero(heads[1:] != heads[:-1]) + 1).tolist(), len(before)]
        for x, y in pairwise(cut if len(before) else []):
            waiting.setdefault(int(heads[x]), []).append((before[x:y], first[x:y]))

    last = n - 1  # the only larger suffix without a successor comes first in its bucket
    for c, lo, hi in zip(codes.tolist(), *own, strict=True):
        if text[last] == c:
            place(np.array([last]), np.array([True]))
        while waiting.get(c):
            parts, firsts = zip(*waiting.pop(c), strict=True)
            place(np.concatenate(parts), np.concatenate(firsts))
        if hi > lo:
            new = fresh[lo:hi].copy()
            new[0] = True
            place(mine[lo:hi], new)
    order, new = np.concatenate(order_parts), np.concatenate(new_parts)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    return order, rank


def adjacent_common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Codes (``most`` at the most) that each suffix in ``order`` shares with the one before it; the first has 0."""
    n, run = len(text), A.RunHash(A.mix(text.astype(np.uint64) + np.uint64(1)))
    shared = np.zeros(n, np.int64)
    left, right = order[:-1], order[1:]
    h = 1 << (most.bit_length() - 1)
    while h:
        x, y = left + shared[1:], right + shared[1:]
        ok = np.flatnonzero((x + h <= n) & (y + h <= n))
        x, y, salt = x[ok], y[ok], np.zeros(len(ok), np.int64)
        shared[1 + ok[run(x, x + h, salt) == run(y, y + h, salt)]] += h
        h >>= 1
    return np.minimum(shared, most)


def alike_neighbours(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Which suffixes in ``order`` share ``length`` codes or more with the one before them."""
    run = A.RunHash(A.mix(text.astype(np.uint64) + np.uint64(1)))
    left, right = order[:-1], order[1:]
    ok = np.flatnonzero(np.maximum(left, right) + length <= len(text))
    alike, salt = np.zeros(len(order), bool), np.zeros(len(ok), np.int64)
    alike[1 + ok] = run(left[ok], left[ok] + length, salt) == run(right[ok], right[ok] + length, salt)
    return alike


def _suffix_sorter(length: int):
    """Groups of blocks, in order of their key, to the spans of repeated windows. A block that meets no other holds no repeat."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for side, rows in _whole_groups(batches):
            meet = rows.column("meet").to_numpy()
            new = np.append(True, meet[1:] != meet[:-1])
            met = rows.filter(pa.array(~(new & np.append(new[1:], True))))
            ends = np.cumsum(pc.binary_length(met.column("body")).to_numpy())
            meet = met.column("meet").to_numpy()
            heads = np.flatnonzero(np.append(True, meet[1:] != meet[:-1])) if len(meet) else np.zeros(0, np.int64)
            start = 0
            while start < met.num_rows:  # whole groups, SORT_BYTES at least
                enough = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + SORT_BYTES)) + 1
                more = heads[np.searchsorted(heads, enough):]
                stop = int(more[0]) if len(more) else met.num_rows
                yield from _sorted_spans(met.slice(start, stop - start), length)
                start = stop

    return emit


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    """Rows of one side, cut between groups; the last group of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        side, meet = batch.column("side").to_numpy(zero_copy_only=False), batch.column("meet").to_numpy()
        cuts = np.flatnonzero((side[1:] != side[:-1]) | (meet[1:] != meet[:-1])) + 1
        turns = np.flatnonzero(side[1:] != side[:-1]) + 1  # at most one a batch and task
        key = (side[0], meet[0])
        if held and (held[-1].column("side")[-1].as_py(), held[-1].column("meet")[-1].as_py()) != key:
            yield held[0].column("side")[0].as_py(), pa.Table.from_batches(held)
            held = []
        start = 0
        for stop in [*turns.tolist(), *([int(cuts[-1])] if len(cuts) else [])]:
            if stop > start:
                held.append(batch.slice(start, stop - start))
                yield side[start], pa.Table.from_batches(held)
                held, start = [], stop
        held.append(batch.slice(start))
    if held:
        yield held[0].column("side")[0].as_py(), pa.Table.from_batches(held)


def _joined(rows: pa.Table, first: np.ndarray | None = None, starts: np.ndarray | None = None, length: int = 0) -> tuple[np.ndarray, ...]:
    """The blocks' bytes plus 1 with a 0 after each; block and place of each code; starts of each block. With ``first`` and ``starts``, only that many windows from that place on."""
    data, offsets = A.buffers(rows.column("body").combine_chunks())
    if first is None:
        first, stop, starts = offsets[:-1], offsets[1:], rows.column("starts").to_numpy().astype(np.int64)
    else:
        first = offsets[:-1] + first
        stop = first + starts + length - 1
    sizes = stop - first + 1
    own = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text = np.zeros(len(own), np.uint16)
    inside = place < sizes[own] - 1
    text[inside] = data[(first[own] + place)[inside]] + np.uint16(1)
    return text, own, place, starts


def _sorted_spans(rows: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    # Of each block, the stretch of windows that share their hash with another place; only these are worth sorting.
    text, own, place, starts = _joined(rows)
    at = np.flatnonzero(place < starts[own])
    h = A.RunHash(A.mix(text.astype(np.uint64) + np.uint64(1)))(at, at + length, np.zeros(len(at), np.int64))
    order = np.argsort(h)
    same = np.append(False, h[order[1:]] == h[order[:-1]])
    shared = np.sort(at[order[same | np.append(same[1:], False)]])
    if not len(shared):
        return
    block, lead = np.unique(own[shared], return_index=True)
    first, last = place[shared[lead]], place[shared[np.append(lead[1:], len(shared)) - 1]]
    rows = rows.take(pa.array(block))
    text, own, place, starts = _joined(rows, first, last - first + 1, length)
    order = two_stage_sort(text, length)
    alike = alike_neighbours(text, order, length)
    repeat = np.zeros(len(text), bool)
    repeat[order[1:][alike[1:]]] = True
    repeat[order[:-1][alike[1:]]] = True
    hit = np.flatnonzero(repeat & (place < starts[own]))
    if not len(hit):
        return
    new = np.append(True, (np.diff(hit) > 1) | (np.diff(own[hit]) > 0))
    lead = np.flatnonzero(new)
    tail = np.append(lead[1:], len(hit)) - 1
    block = own[hit[lead]]
    a = rows.column("a").to_numpy()[block] + first[block]
    ids = [rows.column(c).combine_chunks().take(pa.array(block)) for c in ("doc_id", "crc")]
    yield pa.RecordBatch.from_arrays([*ids, pa.array((a + place[hit[lead]]).astype(np.int32)), pa.array((a + place[hit[tail]]).astype(np.int32))],
                                     names=["doc_id", "crc", "a", "b"])


def _window_mapper(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches, "body", A.CHUNK_BYTES // 8):
            data, offsets = A.buffers(batch.column("body"))
            counts = batch.column("starts").to_numpy().astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), counts)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = offsets[row] + place
            content = A.RunHash(A.byte_values(data))(at, at + length, np.zeros(len(at), np.int64))
            a = batch.column("a").to_numpy()[row] + place
            anchor, *ids = A.taken(batch, row, "anchor", "doc_id", "crc")
            yield pa.RecordBatch.from_arrays([anchor, pa.array(A.signed(content)), *ids, pa.array(a.astype(np.int32))], names=["anchor", "content", "doc_id", "crc", "a"])

    return emit


def _cutter(length: int, with_text: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.unpacked(batches):
            data, offsets = A.buffers(batch.column("text"))
            row, h = R.nested(batch.column("hits"), batch.num_rows)
            gone = A.cover(offsets[row] + h["a"], offsets[row] + h["b"] + length, len(data)) if len(row) else np.zeros(len(data), bool)
            removed, spans, digests, kept = [], [], [], []
            for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                g = gone[x:y]
                removed.append(int(g.sum()))
                spans.append(int(g[:1].sum() + (g[1:] & ~g[:-1]).sum()))
                kept.append(data[x:y][~g].tobytes())
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return emit
