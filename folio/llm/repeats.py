"""Index of content-chosen blocks, shared by the two exact substring operators.

A text is a row of units (words or bytes). Every window of ``window`` units picks the least-hashed
``k``-gram inside it as its anchor, so equal windows share an anchor at the same distance. The
windows that pick one anchor occurrence form a *block*: one contiguous stretch of text. The index
holds one small row per block (two per ``window`` on average), not one per unit:

* an anchor that isn't repeated proves that none of its windows is repeated;
* where all blocks of an anchor are equal, each of them is repeated as a whole;
* only blocks of a *mixed* anchor (same anchor, different surroundings) need a closer look.

The anchor counts are aggregated on the map side, so a passage that a third of all documents share
costs one row per task; the join that follows is split by Spark where a key is skewed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A

BLOCKS = "anchor long, block long, doc_id long, crc long, a int, b int"


def word_units(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, and each row's first and last word number."""
    data, offsets = A.buffers(batch.column("text"))
    starts, ends, first = A.word_spans(data, offsets)
    return A.span_hashes(data, starts, ends), first[:-1], first[1:]


def word_anchors(batch: pa.RecordBatch, window: int, k: int) -> tuple:
    values, first, last = word_units(batch)
    hashes = A.grams(values, k)
    return (*A.anchored_runs(hashes, hashes >> np.uint64(32), first, last, window, k), values, first)


def byte_anchors(batch: pa.RecordBatch, window: int, k: int) -> tuple:
    data, offsets = A.buffers(batch.column("text"))
    hashes = A.byte_grams(data, k.bit_length() - 1)
    return (*A.anchored_runs(hashes, hashes >> np.uint64(32), offsets[:-1], offsets[1:], window, k), A.byte_values(data), offsets[:-1])


def block_mapper(anchors: Callable, window: int, k: int) -> Callable:
    """mapInArrow function: documents to one row per block, places relative to the row's first unit."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            hashes, at, lead, tail, row, values, first = anchors(batch, window, k)
            if not len(at):
                continue
            run = A.RunHash(values)
            yield pa.RecordBatch.from_arrays([
                pa.array(A.signed(hashes)), pa.array(A.signed(run(lead, tail + window, at - lead))),
                *A.taken(batch, row, "doc_id", "crc"),
                pa.array((lead - first[row]).astype(np.int32)), pa.array((tail - first[row]).astype(np.int32)),
            ], names=["anchor", "block", "doc_id", "crc", "a", "b"])

    return emit


def compressed(docs: DataFrame, *further: str) -> DataFrame:
    """(doc_id, crc, further long columns, blob): the text as a zstandard frame, so that a shuffle by document moves less."""
    names = ["doc_id", "crc", *further]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in A.chunks(batches):
            blobs = [packer.compress(t.as_buffer()) if t.is_valid else None for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(blobs, pa.binary())], names=[*names, "blob"])

    return docs.mapInArrow(pack, ", ".join(f"{c} long" for c in names) + ", blob binary")


def unpacked(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """Batches with ``blob`` turned back into ``text`` bytes, cut to bounded chunks."""
    opener = zstandard.ZstdDecompressor()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            texts = [opener.decompress(b.as_buffer()) if b.is_valid else b"" for b in part.column("blob")]
            whole = pa.RecordBatch.from_arrays(
                [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "blob"] + [pa.array(texts, pa.large_binary())],
                names=[n for n in part.schema.names if n != "blob"] + ["text"])
            yield from A.chunks(iter([whole]))


def nested(column: pa.Array, rows: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A list<struct> column as the row of each element and the fields' flat arrays."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    fields = {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}
    return np.repeat(np.arange(rows), sizes), fields


def with_hits(texts: DataFrame, hits: DataFrame, how: str) -> DataFrame:
    """Documents beside their spans; a null doc_id matches a null doc_id."""
    on = texts.doc_id.eqNullSafe(hits.doc_id) & (texts.crc == hits.crc)
    return texts.join(hits, on, how).select(texts.doc_id, texts.crc, "blob", "hits")


def per_document(spans: DataFrame, *fields: str) -> DataFrame:
    """One row per document with its spans in a list; the list is bounded by the document's own length."""
    return spans.groupBy("doc_id", "crc").agg(F.collect_list(F.struct(*fields)).alias("hits"))


HOT_SHARE = 1000


def joined_by_count(spark: SparkSession, rows: DataFrame, counted: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``rows`` with a table that has one row a key and the key's number of rows there.

    Keys with more than a ``HOT_SHARE``-th of all rows, of which there are fewer than ``HOT_SHARE`` by arithmetic, are broadcast, so no task
    gets a hot key's rows; the rest is joined by shuffle. Both inputs are written tables.
    """
    most = rows.count() / HOT_SHARE
    hot, cold = counted.filter(F.col(count) > most), counted.filter(F.col(count) <= most)
    spread = rows.join(F.broadcast(hot), keys)
    dealt = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return spread.unionByName(dealt)
