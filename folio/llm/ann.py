"""Operator 6, approximate nearest neighbours: multiprobe p-stable hashing.

Unit vectors are hashed by ``tables`` x ``bits`` functions floor((a.x + b) / width) with Gaussian a (2-stable).
A query visits its own bucket of each table and ``probes`` - 1 neighbours of it in the order of their estimated
success: the nearer a projection lies to a cell's border, the likelier a neighbour lies beyond it. What the
tables yield is merged and ranked by the exact cosine of the original vectors in double precision.

Equal vectors are one entry that carries its smallest ids, so a vector that a third of all rows share is
hashed and compared once. A bucket is worked on in blocks of ``block_rows`` entries by
``block_queries`` queries, whatever its size. Queries that found fewer than ``k`` rows are compared with all
entries in the same blocks.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; vectors of
another length than the query's aren't its candidates; equal scores go by the smaller id; fewer rows
than ``k`` give fewer ranks; repeated ids are rows of their own; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written

TABLES, BITS, WIDTH, PROBES, SEED = 16, 6, 1.6, 28, 7
BLOCK_ROWS, BLOCK_QUERIES = 4000, 1000


def functions_of(dim: int, tables: int, bits: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64([seed, dim]))
    return rng.standard_normal((dim, tables * bits)), rng.uniform(0, width, tables * bits)


def probe_offsets(inside: np.ndarray, probes: int) -> list[np.ndarray]:
    """Bucket offsets in the order of estimated success, the bucket itself first; ``inside``: place in the cell, 0 to 1."""
    n = len(inside)
    cost = np.concatenate([inside**2, (1 - inside) ** 2])  # squared distance to the lower and the upper border
    order = np.argsort(cost, kind="stable")
    cost, place, way = cost[order], order % n, np.where(order < n, -1, 1)
    found = [np.zeros(n, np.int64)]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        score, chosen = heapq.heappop(heap)
        at = place[list(chosen)]
        if len(set(at.tolist())) == len(at):  # not both borders of one projection
            step = np.zeros(n, np.int64)
            step[at] = way[list(chosen)]
            found.append(step)
        last = chosen[-1]
        if last + 1 < 2 * n:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*chosen, last + 1)))
    return found


def multiprobe_search(spark: SparkSession, vectors: DataFrame, every: int = 50, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                      tables: int = TABLES, bits: int = BITS, width: float = WIDTH, probes: int = PROBES, seed: int = SEED) -> DataFrame:
    """One row per found neighbour: query_id, rank, vec_id, score; queries are the rows whose id ``every`` divides."""
    kind = vectors.schema[vec_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    usable = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.filter("id is not null and vec is not null").filter(usable).withColumn("cls", F.xxhash64("vec"))
    entries = written(spark, rows.mapInArrow(_condense(k + 1), f"cls long, vec {kind}, ids array<long>").groupBy("cls")
                      .agg(F.first("vec").alias("vec"), F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")), "op6-entries")
    asked = written(spark, rows.filter(F.pmod("id", F.lit(every)) == 0).select("id", "cls"), "op6-queries")
    queries = entries.select("cls", "vec").join(asked.select("cls").distinct(), "cls")

    shape = (tables, bits, width, seed)
    schema = f"tab int, bucket long, cls long, vec {kind}"
    index = entries.mapInArrow(_hasher(shape, 1), schema)
    probed = queries.mapInArrow(_hasher(shape, probes), schema)
    first = written(spark, _searched(spark, index, probed, k + 1, kind), "op6-found")

    some = first.join(entries.select("cls", F.size("ids").alias("n")), "cls").groupBy("q").agg(F.sum("n").alias("n")).filter(F.col("n") > k)
    lacking = queries.join(some.select(F.col("q").alias("cls")), "cls", "left_anti")
    everything = [d.select(F.lit(-1).alias("tab"), F.size("vec").cast("long").alias("bucket"), "cls", "vec") for d in (entries, lacking)]
    rest = _searched(spark, *everything, k + 1, kind)

    found = first.unionByName(rest).groupBy("q", "cls").agg(F.max("score").alias("score"))
    found = found.join(entries.select("cls", "ids"), "cls")
    best = (found.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])))
            .filter(F.col("place") <= k + 1).select("q", "score", F.explode("ids").alias("vec_id")))
    ranked = asked.select(F.col("id").alias("query_id"), F.col("cls").alias("q")).join(best, "q").filter("query_id <> vec_id")
    return (ranked.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, in double precision, each scaled by a power of two to components of at most 1.

    That changes no cosine, and squares of very large or small components neither overflow nor vanish.
    """
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))[1])


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = batch.column("vec").value_lengths().to_numpy()
    for size in np.unique(sizes):
        yield batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))


def _condense(most: int):
    """Rows to one per different vector of a batch, with its smallest ids."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, ids = batch.column("cls").to_numpy(), batch.column("id").to_numpy()
            order = np.lexsort((ids, cls))
            cut = np.flatnonzero(np.append(True, cls[order][1:] != cls[order][:-1]))
            held = [ids[order[a:b]][:most].tolist() for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)], strict=True)]
            lead = pa.array(order[cut])
            yield pa.RecordBatch.from_arrays([batch.column("cls").take(lead), batch.column("vec").take(lead), pa.array(held, pa.list_(pa.int64()))], names=["cls", "vec", "ids"])

    return emit


def _hasher(shape: tuple, probes: int):
    """Vectors to one row per table and bucket visited."""
    tables, bits, width, seed = shape

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole) if whole.num_rows else ():
                x = _matrix(batch.column("vec"))
                a, b = functions_of(x.shape[1], tables, bits, width, seed)
                cells = ((x / np.linalg.norm(x, axis=1, keepdims=True)) @ a + b) / width
                low = np.floor(cells).astype(np.int64)
                inside = cells - low
                for t in range(tables):
                    own = slice(t * bits, (t + 1) * bits)
                    if probes == 1:
                        row, at = np.arange(len(x)), low[:, own]
                    else:
                        steps = [probe_offsets(inside[i, own], probes) for i in range(len(x))]
                        row = np.repeat(np.arange(len(x)), [len(s) for s in steps])
                        at = low[row, own] + np.array([s for each in steps for s in each])
                    bucket = np.full(len(row), x.shape[1], np.uint64)
                    for j in range(bits):
                        bucket = A.mix(bucket ^ at[:, j].astype(np.uint64))
                    pick = pa.array(row)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), t, np.int32)), pa.array(A.signed(bucket)), batch.column("cls").take(pick),
                                                      batch.column("vec").take(pick)], names=["tab", "bucket", "cls", "vec"])

    return emit


def _searched(spark: SparkSession, index: DataFrame, probed: DataFrame, k: int, kind: str) -> DataFrame:
    """(q, cls, score): the best ``k`` entries of each block of a bucket for each query that visits it."""
    sizes = index.groupBy("tab", "bucket").agg(F.count("*").alias("rows")).join(probed.groupBy("tab", "bucket").agg(F.count("*").alias("asks")), ["tab", "bucket"])
    sizes = written(spark, sizes.select("tab", "bucket", F.ceil(F.col("rows") / BLOCK_ROWS).alias("m"), F.ceil(F.col("asks") / BLOCK_QUERIES).alias("n")), "op6-buckets")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    stored = index.join(sizes, ["tab", "bucket"]).select("tab", "bucket", F.pmod("cls", "m").alias("i"), spread(F.col("n")).alias("j"), F.lit(False).alias("ask"), "cls", "vec")
    asking = probed.join(sizes, ["tab", "bucket"]).select("tab", "bucket", spread(F.col("m")).alias("i"), F.pmod("cls", "n").alias("j"), F.lit(True).alias("ask"), "cls", "vec")

    def block(group: pa.Table) -> pa.Table:
        ask = group.column("ask").to_numpy(zero_copy_only=False).astype(bool)
        parts = [group.filter(pa.array(m)).combine_chunks() for m in (ask, ~ask)]
        if not (parts[0].num_rows and parts[1].num_rows):
            none = np.zeros(0, np.int64)
            return pa.table({"q": none, "cls": none, "score": np.zeros(0)})
        qs, cs = (p.column("cls").to_numpy() for p in parts)
        x, y = (_matrix(p.column("vec").combine_chunks()) for p in parts)
        s = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :])
        if s.shape[1] > k:
            least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            a, b = np.nonzero(s >= least[:, None])  # ties at the border all stay
        else:
            a, b = (v.ravel() for v in np.indices(s.shape))
        return pa.table({"q": qs[a], "cls": cs[b], "score": s[a, b]})

    return stored.unionByName(asking).groupBy("tab", "bucket", "i", "j").applyInArrow(block, "q long, cls long, score double")
