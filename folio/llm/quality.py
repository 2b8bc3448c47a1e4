"""Operator 7, quality classifier: co-training of a text view and a metadata view.

The text view sees the make-up of the whole text (shares of letters, capitals, digits and signs,
lengths, repetition); the metadata view sees the language, the source and the stated length. Both are
ridge logistic regressions whose Newton steps sum over all rows in Spark. In each round a view takes the
other's confident judgements on unlabelled documents as further labels, if that view's confident
judgements hold on the labelled ones. A last regression on the labelled rows calibrates the two views into one score.

Everything covers all rows: there is no sample. What reaches the driver is a few thousand sums.

Defined results: a null text counts as empty; a null language, source or length is a value of its own;
missing metadata columns are left out; with labels of one class only, every score is that
class's share; an empty table gives an empty result; repeated rows are scored alike; labels whose value is null
are not used; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written

ROUNDS, NEWTON, CONFIDENT, PSEUDO_WEIGHT, RIDGE = 2, 4, 0.95, 0.2, 1.0
HOLDS = 0.9  # share of a view's confident judgements that must hold on labelled rows before the other view takes them
SOURCES, LANGS = 32, 8
FAR = 8.0  # views' logits beyond this count as this
TEXT = 18
META = SOURCES + LANGS + 2


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in A.chunks(batches):
        data, offsets = A.buffers(batch.column("text"))
        n = np.diff(offsets)
        starts, ends, first = A.word_spans(data, offsets)
        words = np.diff(first)

        def per_row(mask: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(mask)))
            return total[offsets[1:]] - total[offsets[:-1]]

        between = lambda lo, hi: (data >= lo) & (data <= hi)
        upper, lower, digit, high = per_row(between(65, 90)), per_row(between(97, 122)), per_row(between(48, 57)), per_row(data >= 128)
        space, newline = per_row(A._SPACE[data]), per_row(data == 10)
        low = A.ascii_lower(data)
        h = A.span_hashes(low, starts, ends)
        row = np.repeat(np.arange(len(n)), words)
        order = np.lexsort((h, row))
        r, v = row[order], h[order]
        lead = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (v[1:] != v[:-1]))) if len(r) else np.zeros(0, np.int64)
        times = np.diff(np.append(lead, len(r)))
        distinct = np.bincount(r[lead], minlength=len(n))
        most = np.zeros(len(n))
        np.maximum.at(most, r[lead], times)
        length = ends - starts
        long_words = np.bincount(row, weights=length > 12, minlength=len(n))
        spread = np.bincount(row, weights=length.astype(float) ** 2, minlength=len(n))
        w, b = np.maximum(words, 1), np.maximum(n, 1)
        signs = n - upper - lower - digit - high - space
        named = [per_row(data == ord(c)) for c in "|%!#$&*.,"]
        cols = [upper / b, digit / b, high / b, signs / b, space / b, newline / b, np.log1p(n), np.log1p(words), (n - space) / w, np.sqrt(spread / w),
                long_words / w, distinct / w, most / w, named[0] / w, sum(named[1:7]) / w, named[2] / w, named[7] / w, named[8] / w]
        flat = np.ascontiguousarray(np.stack(cols, axis=1).astype(np.float64))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "crc", "source", "lang", "size")] + [
            pa.ListArray.from_arrays(np.arange(0, flat.size + 1, TEXT, dtype=np.int32), pa.array(flat.ravel()))],
            names=["doc_id", "crc", "source", "lang", "size", "text_view"])


def co_trained_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       label_col: str = "quality", rounds: int = ROUNDS, newton: int = NEWTON) -> DataFrame:
    """One row per document: doc_id, crc, score (0 to 1), text_score, meta_score, predicted (1 where score >= 0.5)."""
    have = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col(id_col), F.col(text_col), have("source").alias("__source"), have("lang").alias("__lang"), have("n_chars").cast("double").alias("__size"))
    rows = base.select(F.col(id_col).cast("long").alias("doc_id"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
                       F.col(text_col).alias("text"), F.pmod(F.xxhash64("__source"), F.lit(SOURCES)).alias("source"),
                       F.pmod(F.xxhash64("__lang"), F.lit(LANGS)).alias("lang"), F.coalesce(F.log1p(F.greatest("__size", F.lit(0.0))), F.lit(0.0)).alias("size"))
    features = rows.mapInArrow(_features, "doc_id long, crc long, source long, lang long, size double, text_view array<double>")
    truth = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).filter("y is not null and doc_id is not null")
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    table = written(spark, features.join(truth, "doc_id", "left"), "op7-features")

    sums = table.select(*[f(F.col("text_view")[i]).alias(f"{n}{i}") for i in range(TEXT) for n, f in (("m", F.avg), ("s", F.stddev_pop))],
                        F.avg("size").alias("ms"), F.stddev_pop("size").alias("ss"), F.avg("y").alias("y")).first()
    if sums is None or sums.y is None or sums.y in (0.0, 1.0):
        share = F.lit(float(sums.y if sums is not None and sums.y is not None else 1.0))
        return table.select("doc_id", "crc", share.alias("score"), share.alias("text_score"), share.alias("meta_score"), (share >= 0.5).cast("int").alias("predicted"))
    scale = (np.array([sums[f"m{i}"] for i in range(TEXT)] + [sums.ms]), np.maximum([sums[f"s{i}"] for i in range(TEXT)] + [sums.ss], 1e-9))

    weights = [np.zeros(TEXT + 1), np.zeros(META + 1)]
    weights[0][-1] = weights[1][-1] = np.log(sums.y / (1 - sums.y))
    taken = [False, False]  # does view 0 (1) take the judgements of the other?
    for turn in range(rounds + 1):
        for _ in range(newton):
            weights = _newton(spark, table, scale, weights, taken)
        if turn < rounds:
            taken = _held(table, scale, weights)
    blend = np.array([1.0, 0.0, 0.0])
    for _ in range(newton):
        blend = _blend(spark, table, scale, weights, blend)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, z, _ = _views(batch, scale)
            t, m = (np.clip(v, -FAR, FAR) for v in (x @ weights[0], z @ weights[1]))
            p = _sigmoid(np.stack([t, m, np.ones(len(t))], axis=1) @ blend)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("crc"), pa.array(p), pa.array(_sigmoid(t)), pa.array(_sigmoid(m)),
                                              pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "crc", "score", "text_score", "meta_score", "predicted"])

    return table.mapInArrow(score, "doc_id long, crc long, score double, text_score double, meta_score double, predicted int")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _views(batch: pa.RecordBatch, scale) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Standardised text view and metadata view, each with a constant, and the labels (NaN where there is none)."""
    n = batch.num_rows
    x = np.ones((n, TEXT + 1))
    x[:, :-1] = (batch.column("text_view").flatten().to_numpy().reshape(n, TEXT) - scale[0][:-1]) / scale[1][:-1]
    z = np.zeros((n, META + 1))
    z[np.arange(n), batch.column("source").to_numpy()] = 1
    z[np.arange(n), SOURCES + batch.column("lang").to_numpy()] = 1
    size = (batch.column("size").to_numpy() - scale[0][-1]) / scale[1][-1]
    z[:, -3], z[:, -2], z[:, -1] = size, size ** 2, 1
    return np.clip(x, -8, 8), np.clip(z, -8, 8), batch.column("y").to_numpy(zero_copy_only=False).astype(float)


def _summed(table: DataFrame, parts) -> dict[int, np.ndarray]:
    """Sums over all rows of what ``parts`` gives for a batch: pairs of a number and a flat array of fixed length."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for k, v in parts(batch):
                    total[k] = total.get(k, 0) + v
        for k, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(v), pa.int32()), pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], names=["k", "i", "v"])

    rows = table.mapInArrow(emit, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).toPandas()
    return {int(k): g.sort_values("i")["v"].to_numpy() for k, g in rows.groupby("k")}


def _step(total: np.ndarray, old: np.ndarray) -> np.ndarray:
    d = len(old)
    ridge = np.full(d, RIDGE)
    ridge[-1] = 1e-6
    return old - np.linalg.solve(total[:d * d].reshape(d, d) + np.diag(ridge), total[d * d:] + ridge * old)


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, weights: np.ndarray) -> np.ndarray:
    p = _sigmoid(x @ weights)
    # a curvature kept from vanishing: a full step can't overshoot where the classes separate
    return np.concatenate([(x.T * (w * np.maximum(p * (1 - p), 0.1))) @ x, (x.T @ (w * (p - y)))[None]], axis=0).ravel()


def _newton(spark: SparkSession, table: DataFrame, scale, weights: list, taken: list[bool]) -> list[np.ndarray]:
    """One step of both views: labelled rows, and unlabelled ones that the other view is confident about."""

    def parts(batch: pa.RecordBatch):
        x, z, y = _views(batch, scale)
        other = (_sigmoid(z @ weights[1]), _sigmoid(x @ weights[0]))
        for k, own in enumerate((x, z)):
            q = other[k]
            sure = np.isnan(y) & taken[k] & ((q >= CONFIDENT) | (q <= 1 - CONFIDENT))
            w = np.where(np.isnan(y), np.where(sure, PSEUDO_WEIGHT, 0.0), 1.0)
            yield k, _sums(own, np.where(np.isnan(y), q >= 0.5, y), w, weights[k])

    total = _summed(table, parts)
    return [_step(total[k], weights[k]) for k in (0, 1)]


def _held(table: DataFrame, scale, weights: list) -> list[bool]:
    """Whether each view's confident judgements of either kind hold on labelled rows; in the order of who would take them."""

    def parts(batch: pa.RecordBatch):
        x, z, y = _views(batch, scale)
        for k, p in enumerate((_sigmoid(z @ weights[1]), _sigmoid(x @ weights[0]))):
            yield k, np.array([np.sum(p >= CONFIDENT, where=~np.isnan(y)), np.sum((p >= CONFIDENT) & (y == 1)), np.sum(p <= 1 - CONFIDENT, where=~np.isnan(y)),
                               np.sum((p <= 1 - CONFIDENT) & (y == 0))], float)

    total = _summed(table, parts)
    return [bool(total[k][1] >= HOLDS * total[k][0] and total[k][3] >= HOLDS * total[k][2] and total[k][0] + total[k][2] > 0) for k in (0, 1)]


def _blend(spark: SparkSession, table: DataFrame, scale, weights: list, blend: np.ndarray) -> np.ndarray:
    def parts(batch: pa.RecordBatch):
        x, z, y = _views(batch, scale)
        both = np.stack([np.clip(x @ weights[0], -FAR, FAR), np.clip(z @ weights[1], -FAR, FAR), np.ones(len(y))], axis=1)
        yield 0, _sums(both, np.nan_to_num(y), (~np.isnan(y)).astype(float), blend)

    return _step(_summed(table, parts)[0], blend)
