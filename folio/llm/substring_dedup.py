"""Operator 1, substring dedup: relative Lempel-Ziv parsing against every indexed reference block.

Each document is greedily factored against the index of all documents with a smaller id
(``repeats``). A block of the document that the index holds unchanged is a factor; neighbouring
factors from one source join into a longer one. At factor boundaries, where the surroundings of an
anchor differ between documents, each window is looked up on its own. Factors of at least
``window`` words become duplicate spans.

Defined results: a null or empty text has no words and keeps the empty string; a text with fewer
than ``window`` words keeps all; rows that repeat a doc_id don't count as earlier than each other
(only a smaller doc_id does); a null doc_id neither removes nor loses anything; an empty table gives
an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm import repeats as R
from folio.llm.storage import keyed, written

WINDOW, GRAM = 13, 5
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, factors array<struct<start:int,end:int,source:long>>"


def relative_lz_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      window: int = WINDOW, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row per document: counts, digest, the factors removed and, on request, ``kept_text``."""
    docs = keyed(docs, id_col, text_col)
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    blocks = known.mapInArrow(R.block_mapper(R.word_anchors, window, gram), R.BLOCKS)
    # Aggregates are written before they are joined back, so that Spark can split the skewed side of the join.
    repeated = written(spark, blocks.groupBy("anchor")
                       .agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"),
                            F.min("block").alias("b0"), F.max("block").alias("b1"))
                       .filter("source < last").select("anchor", "source", (F.col("b0") != F.col("b1")).alias("mixed")), "op1-anchors")
    hits = written(spark, blocks.join(repeated, "anchor").filter("mixed or source < doc_id"), "op1-hits")
    texts = R.compressed(docs)

    # Of equal blocks under a mixed anchor only the first document's are looked into; the others are factors as they are.
    mixed = hits.filter("mixed").drop("source")
    firsts = written(spark, mixed.groupBy("anchor", "block").agg(F.min("doc_id").alias("source")), "op1-firsts")
    mixed = written(spark, mixed.join(firsts, ["anchor", "block"]).select("doc_id", "crc", "anchor", "a", "b", "source"), "op1-mixed")
    edges = R.per_document(mixed.filter("source = doc_id"), "a", "b", "anchor")
    windows = written(spark, R.with_hits(texts, edges, "inner")
                      .mapInArrow(_window_mapper(window), "anchor long, content long, doc_id long, crc long, a int"), "op1-windows")
    sources = written(spark, windows.groupBy("anchor", "content").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
                      .filter("source < last").drop("last"), "op1-sources")
    boundary = (windows.join(sources, ["anchor", "content"]).filter("source < doc_id")
                .select("doc_id", "crc", "a", F.col("a").alias("b"), "source"))
    whole = hits.filter("not mixed").unionByName(mixed.filter("source < doc_id"), allowMissingColumns=True).select("doc_id", "crc", "a", "b", "source")
    spans = R.per_document(whole.unionByName(boundary), "a", "b", "source")
    out = RESULT + (", kept_text string" if with_text else "")
    return R.with_hits(texts, spans, "left").mapInArrow(_parser(window, with_text), out)


def _window_mapper(window: int):
    """Documents and blocks of theirs to one row per window of those blocks."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.unpacked(batches):
            values, first, _ = R.word_units(batch)
            row, h = R.nested(batch.column("hits"), batch.num_rows)
            a, b, anchor = h["a"], h["b"], h["anchor"]
            counts = (b - a + 1).astype(np.int64)
            if not counts.sum():
                continue
            each = np.repeat(np.arange(len(a)), counts)
            start = a[each] + np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
            content = A.grams(values, window)[start + first[row[each]]]
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor[each]), pa.array(A.signed(content)), *A.taken(batch, row[each], "doc_id", "crc"),
                pa.array(start.astype(np.int32))], names=["anchor", "content", "doc_id", "crc", "a"])

    return emit


def parse(starts: np.ndarray, ends: np.ndarray, sources: np.ndarray) -> list[tuple[int, int, int]]:
    """Greedy factors over candidate spans: at each place the candidate that reaches furthest."""
    order = np.lexsort((-ends, starts))
    factors: list[list[int]] = []
    for s, e, source in zip(starts[order].tolist(), ends[order].tolist(), sources[order].tolist(), strict=True):
        if factors and e <= factors[-1][1]:
            continue
        if factors and source == factors[-1][2] and s <= factors[-1][1]:
            factors[-1][1] = e
        else:
            factors.append([max(s, factors[-1][1]) if factors else s, e, source])
    return [tuple(f) for f in factors]


def _parser(window: int, with_text: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.unpacked(batches):
            data, offsets = A.buffers(batch.column("text"))
            starts, ends, first = A.word_spans(data, offsets)
            raw = data.tobytes()
            row, h = R.nested(batch.column("hits"), batch.num_rows)
            bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
            removed, digests, factors, texts = [], [], [], []
            for i in range(batch.num_rows):
                s, e = starts[first[i]:first[i + 1]], ends[first[i]:first[i + 1]]
                lo, hi = bounds[i], bounds[i + 1]
                found = parse(h["a"][lo:hi], h["b"][lo:hi] + window, h["source"][lo:hi]) if hi > lo else []
                drop = np.zeros(len(s), bool)
                for x, y, _ in found:
                    drop[x:y] = True
                kept = b" ".join([raw[x:y] for x, y in zip(s[~drop].tolist(), e[~drop].tolist(), strict=True)])
                removed.append(int(drop.sum()))
                digests.append(hashlib.sha256(kept).hexdigest())
                factors.append([{"start": x, "end": y, "source": z} for x, y, z in found])
                texts.append(kept.decode() if with_text else None)
            columns = [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(digests),
                       pa.array(factors, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("source", pa.int64())])))]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "factors"]
            if with_text:
                columns, names = [*columns, pa.array(texts, pa.string())], [*names, "kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return emit
