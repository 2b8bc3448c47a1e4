"""Operator 10, line dedup: sharded cuckoo filters over exact reference counts.

A line's key is the line stripped of ASCII space at both ends with A-Z lower-cased. ``LineIndex``
holds one reference row per (key, document) and its counts; documents can be inserted and deleted
at any time, and the counts of the keys they touch follow, so a dropped line comes back when the
documents that made it frequent are deleted.

Cuckoo filters of the frequent keys, one per shard, let a task pass over lines that can't be
frequent; what a filter lets through is decided by the exact counts. The filters are sent to the
tasks while their size is under ``filter_bytes``; beyond it every line meets the counts in a join.

Defined results: a null or empty text is one empty line; a row counts as a document, also where a
doc_id repeats, and all rows of the largest doc_id keep their lines; a line that stands several times
in a kept document stays as often; rows with a null doc_id keep all lines and count for nothing; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm import repeats as R
from folio.llm.storage import keyed, written

MIN_CODE_POINTS, MIN_DOCS = 40, 5
SHARD_KEYS, FILTER_BYTES = 50_000, 32 << 20
LINES = "h1 long, h2 long, doc_id long, crc long, line int"


class CuckooFilter:
    """Four 16-bit fingerprints per bucket, two buckets per key; supports insert, delete and lookup."""

    def __init__(self, keys: int):
        self.buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / 3.4))))
        self.slots = np.zeros((self.buckets, 4), np.uint16)

    @staticmethod
    def _parts(h1: np.ndarray, h2: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h1, h2 = h1.astype(np.int64).view(np.uint64), h2.astype(np.int64).view(np.uint64)
        print_ = (h2 % np.uint64(65535) + np.uint64(1)).astype(np.uint64)
        one = (h1 & np.uint64(buckets - 1)).astype(np.int64)
        return print_.astype(np.uint16), one, one ^ (A.mix(print_) & np.uint64(buckets - 1)).astype(np.int64)

    def insert(self, h1: np.ndarray, h2: np.ndarray) -> None:
        prints, ones, twos = self._parts(h1, h2, self.buckets)
        for p, one, two in zip(prints.tolist(), ones.tolist(), twos.tolist(), strict=True):
            if not (self._put(p, one) or self._put(p, two) or self._kick(p, two)):
                raise OverflowError("the filter is full")

    def _put(self, p: int, at: int) -> bool:
        free = np.flatnonzero(self.slots[at] == 0)
        if len(free):
            self.slots[at, free[0]] = p
        return bool(len(free))

    def _kick(self, p: int, at: int) -> bool:
        for turn in range(500):
            slot = (turn * 7 + p) & 3
            p, self.slots[at, slot] = int(self.slots[at, slot]), p
            at ^= int(A.mix(np.array([p], np.uint64))[0] & np.uint64(self.buckets - 1))
            if self._put(p, at):
                return True
        return False

    def delete(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Remove keys that were inserted."""
        for p, one, two in zip(*(x.tolist() for x in self._parts(h1, h2, self.buckets)), strict=True):
            for at in (one, two):
                held = np.flatnonzero(self.slots[at] == p)
                if len(held):
                    self.slots[at, held[0]] = 0
                    break

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        prints, one, two = self._parts(h1, h2, self.buckets)
        return ((self.slots[one] == prints[:, None]) | (self.slots[two] == prints[:, None])).any(axis=1)

    @classmethod
    def of(cls, h1: np.ndarray, h2: np.ndarray) -> CuckooFilter:
        """A filter holding all the keys, as large as that takes."""
        room = len(h1)
        while True:
            made = cls(room)
            try:
                made.insert(h1, h2)
            except OverflowError:
                room = max(room, 8) * 2
                continue
            return made


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end of each line, start and end of its key, and each row's first line number."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(offsets, breaks, side="right") - 1
    starts = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    first = np.concatenate(([0], np.cumsum(1 + np.bincount(row, minlength=len(offsets) - 1))))
    ends = np.empty(len(starts), np.int64)
    ends[:-1] = starts[1:] - 1
    ends[first[1:] - 1] = offsets[1:]
    w0, w1, _ = A.word_spans(data, offsets)
    at, to = np.searchsorted(w0, starts), np.searchsorted(w1, ends, side="right")
    full = to > at
    k0, k1 = starts.copy(), starts.copy()
    k0[full], k1[full] = w0[at[full]], w1[to[full] - 1]
    return starts, ends, k0, k1, first


def _keys(batch: pa.RecordBatch, least: int) -> tuple[np.ndarray, ...]:
    """Row, line number in its row and two hashes of every line whose key is long enough."""
    data, offsets = A.buffers(batch.column("text"))
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    _, _, k0, k1, first = line_spans(data, offsets)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    line = np.flatnonzero(points[k1] - points[k0] >= least)
    row = np.searchsorted(first, line, side="right") - 1
    low = A.ascii_lower(data)
    h1, h2 = A.span_hashes(low, k0[line], k1[line]), A.span_hashes(low ^ np.uint8(0x5A), k0[line], k1[line])
    return row, line - first[row], A.signed(h1), A.signed(h2)


def _line_mapper(least: int, filters=None, shards: int = 0, each_once: bool = False):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            row, line, h1, h2 = _keys(batch, least)
            if filters is not None and len(row):
                shard = h1.view(np.uint64) % np.uint64(shards)
                ok = np.zeros(len(row), bool)
                for s, made in filters.value.items():
                    own = np.flatnonzero(shard == s)
                    ok[own] = made.contains(h1[own] // shards, h2[own])
                row, line, h1, h2 = row[ok], line[ok], h1[ok], h2[ok]
            if each_once and len(row):
                order = np.lexsort((h2, h1, row))
                r, a, b = row[order], h1[order], h2[order]
                keep = order[np.append(True, (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]))]
                row, line, h1, h2 = row[keep], line[keep], h1[keep], h2[keep]
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), *A.taken(batch, row, "doc_id", "crc"), pa.array(line.astype(np.int32))],
                                                 names=["h1", "h2", "doc_id", "crc", "line"])

    return emit


class LineIndex:
    """References (key, document) of a corpus; grows and shrinks by documents."""

    def __init__(self, spark: SparkSession, references: DataFrame, least: int = MIN_CODE_POINTS, min_docs: int = MIN_DOCS):
        self.spark, self.references, self.least, self.min_docs = spark, references, least, min_docs

    @classmethod
    def of(cls, spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           least: int = MIN_CODE_POINTS, min_docs: int = MIN_DOCS) -> LineIndex:
        return cls(spark, _references(docs, id_col, text_col, least), least, min_docs)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        more = _references(docs, id_col, text_col, self.least)
        return LineIndex(self.spark, written(self.spark, self.references.unionByName(more), "lines"), self.least, self.min_docs)

    def delete(self, ids: DataFrame) -> LineIndex:
        """Without the documents whose ids are the first column of ``ids``."""
        gone = ids.select(F.col(ids.columns[0]).cast("long").alias("doc_id")).distinct()
        return LineIndex(self.spark, written(self.spark, self.references.join(gone, "doc_id", "left_anti"), "lines"), self.least, self.min_docs)

    def counts(self) -> DataFrame:
        """Exact (h1, h2, n_docs, last_doc) of every key."""
        return self.references.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))

    def apply(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
              shard_keys: int = SHARD_KEYS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
        """One row per document: doc_id, n_lines, n_dropped, kept_sha256 and, on request, kept_text."""
        frequent = written(self.spark, self.counts().filter(F.col("n_docs") >= self.min_docs).select("h1", "h2", "last_doc"), "op10-frequent")
        docs = keyed(docs, id_col, text_col)
        shards = max(1, -(-(n := frequent.count()) // shard_keys))
        filters = None
        if 5 * n <= filter_bytes:  # five bytes a key at the most
            made = (frequent.withColumn("shard", F.col("h1") - F.col("h1"))
                    if shards == 1 else frequent.withColumn("shard", _unsigned_mod("h1", shards)))
            rows = made.groupBy("shard").applyInPandas(_filter_builder(shards), "shard long, slots binary").collect()
            filters = self.spark.sparkContext.broadcast({r.shard: _opened(r.slots) for r in rows})
        lines = docs.filter("doc_id is not null").mapInArrow(_line_mapper(self.least, filters, shards), LINES)
        drops = lines.join(frequent, ["h1", "h2"]).filter("doc_id < last_doc").select("doc_id", "crc", "line")
        out = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", crc long, kept_text string" if with_text else "")
        return R.with_hits(R.compressed(docs), R.per_document(drops, "line"), "left").mapInArrow(_dropper(with_text), out)


def _unsigned_mod(column: str, n: int):
    """The column's 64 bits as an unsigned number modulo n."""
    high = F.shiftrightunsigned(F.col(column), 32) % n
    low = F.col(column).bitwiseAND(F.lit(0xFFFFFFFF)) % n
    return (high * (2**32 % n) + low) % n


def _references(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    return (keyed(docs, id_col, text_col).filter("doc_id is not null and text is not null")
            .mapInArrow(_line_mapper(least, each_once=True), LINES).select("h1", "h2", "doc_id"))


def _filter_builder(shards: int):
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(rows["h1"].to_numpy() // shards, rows["h2"].to_numpy())
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "slots": [made.slots.tobytes()]})

    return build


def _opened(slots: bytes) -> CuckooFilter:
    made = CuckooFilter(1)
    made.slots = np.frombuffer(slots, np.uint16).reshape(-1, 4)
    made.buckets = len(made.slots)
    return made


def _dropper(with_text: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.unpacked(batches):
            row, h = R.nested(batch.column("hits"), batch.num_rows)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lines, dropped, digests, texts = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                parts = text.as_buffer().to_pybytes().split(b"\n")
                gone = set(h["line"][bounds[i]:bounds[i + 1]].tolist()) if bounds[i + 1] > bounds[i] else ()
                kept = b"\n".join(p for k, p in enumerate(parts) if k not in gone) if gone else b"\n".join(parts)
                lines.append(len(parts))
                dropped.append(len(gone))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
            columns = [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests)]
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
            if with_text:
                columns, names = [*columns, batch.column("crc"), pa.array(texts, pa.string())], [*names, "crc", "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return emit


def line_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False,
               least: int = MIN_CODE_POINTS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The whole table as one insertion, applied to itself."""
    return LineIndex.of(spark, docs, id_col, text_col, least, min_docs).apply(docs, id_col, text_col, with_text)
