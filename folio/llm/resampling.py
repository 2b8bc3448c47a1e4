"""Operator 11, importance resampling towards a target distribution.

Features are the runs of 1 to ``longest`` consecutive words, hashed to buckets by CRC-32. A bucket's gain compares its share
of the target's features with its share of the documents' features; a document's weight is its mean gain. Documents are drawn
without replacement by the highest sums of weight and Gumbel noise, which the id fixes.

CRC-32 is linear over XOR: a span's value is the XOR of one contribution per byte, which depends on the byte and its distance
from the span's end alone, and of a constant of the length. The contributions stand in a table of ``reach`` distances, so all
spans of a chunk are hashed by one lookup and one ``bitwise_xor.reduceat``; a longer span is cut into blocks of ``reach`` bytes
from its end, whose values are folded in pairs.

Only counts by bucket (at most ``buckets`` rows), counts by score (scores are bounded, see ``GUMBEL``) and offsets by partition
leave the tasks; the ranks come from a range sort of the drawn scores.

Defined results: a null or empty text has no features, weight 0 and no draw unless ``least_words`` is 0; repeated rows are
documents of their own, in the order of their row numbers; a null doc_id is the empty string in the noise and last among ties;
an empty table gives an empty result, an empty target uniform shares; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written
from folio.operators.ordering import global_row_number

BUCKETS, LONGEST, PERCENT, LEAST_WORDS, SEED = 10_000, 1, 10, 20, 2024
REACH, SLICE_BYTES = 64, 1 << 20
# Noise lies in -3131..22873 and gains in +-1000 ln((n + 1) (n + buckets)) for n features, so there are some 10^5 scores at most.
GUMBEL = "CAST(floor(-1000 * ln(-ln((conv(substr(sha2(concat('{}:', coalesce(CAST(doc_id AS STRING), '')), 256), 1, 8), 16, 10) + 0.5D) / 4294967296D))) AS BIGINT)"

_OTHER = np.ones(256, bool)  # bytes between words
_OTHER[48:58] = _OTHER[97:123] = _OTHER[128:] = False


class PositionCrc:
    """CRC-32 of many byte spans at once, from contributions by byte and distance from the end."""

    def __init__(self, reach: int = REACH):
        if reach < 1 or reach & (reach - 1):
            raise ValueError("reach must be a power of two")
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
        self.reach, self._step = reach, step
        self.table = np.empty((reach, 256), np.uint32)  # [distance, byte]
        self.table[0] = step
        for d in range(1, reach):
            self.table[d] = self._zero(self.table[d - 1])
        state = np.full(reach + 1, 0xFFFFFFFF, np.uint32)
        for n in range(1, reach + 1):
            state[n] = self._zero(state[n - 1:n])[0]
        self.constant = ~state  # of each length up to reach
        lanes = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
        self._shifts = [self._zero(lanes)]  # [j]: 2**j zero bytes more, as four byte-indexed tables

    def _zero(self, state: np.ndarray) -> np.ndarray:
        return (state >> np.uint32(8)) ^ self._step[state & np.uint32(255)]

    def _shift(self, state: np.ndarray, j: int) -> np.ndarray:
        """The states after 2**j further zero bytes."""
        while len(self._shifts) <= j:
            last = self._shifts[-1]
            self._shifts.append(self._apply(last, last))
        return self._apply(self._shifts[j], state)

    @staticmethod
    def _apply(lanes: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = lanes[0][state & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ lanes[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def _blocks(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Linear values of blocks of 1 to ``reach`` bytes, in slices of about ``SLICE_BYTES``."""
        out = np.empty(len(starts), np.uint32)
        size = ends - starts
        edge = np.cumsum(size)
        lo = 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(edge, (edge[lo - 1] if lo else 0) + SLICE_BYTES, side="right")))
            lens = size[lo:hi]
            at = np.cumsum(lens) - lens
            place = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
            parts = self.table[np.repeat(lens, lens) - 1 - place, data[np.repeat(starts[lo:hi], lens) + place]]
            out[lo:hi] = np.bitwise_xor.reduceat(parts, at)
            lo = hi
        return out

    def _constants(self, size: np.ndarray) -> np.ndarray:
        state = np.full(len(size), 0xFFFFFFFF, np.uint32)
        for j in range(int(size.max(initial=0)).bit_length()):
            state = np.where(size >> j & 1, self._shift(state, j), state)
        return ~state

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC-32 of data[start:end] for every span; spans may overlap, an empty one gives 0."""
        size = ends - starts
        out = np.zeros(len(size), np.uint32)
        short = np.flatnonzero((size > 0) & (size <= self.reach))
        out[short] = self._blocks(data, starts[short], ends[short]) ^ self.constant[size[short]]
        long = np.flatnonzero(size > self.reach)
        if len(long):
            count = -(-size[long] // self.reach)
            place = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)  # 0 is the last block of its span
            stop = np.repeat(ends[long], count) - place * self.reach
            value = self._blocks(data, np.maximum(stop - self.reach, np.repeat(starts[long], count)), stop)
            j = self.reach.bit_length() - 1
            while len(value) > len(long):  # a block and the one before it become one of twice the length
                odd = np.flatnonzero(place & 1)
                value[odd - 1] ^= self._shift(value[odd], j)
                value, place, j = np.delete(value, odd), np.delete(place, odd) >> 1, j + 1
            out[long] = value ^ self._constants(size[long])
        return out


def _features(batch: pa.RecordBatch, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, feature starts and ends, each row's first feature (rows + 1 entries), each row's number of words."""
    data, offsets = A.buffers(batch.column("text"))
    data = A.ascii_lower(data)
    starts, ends, first = A.word_spans(data, offsets, _OTHER)
    words = np.diff(first)
    if longest == 1:
        return data, starts, ends, first, words
    size = ends - starts + 1  # every word and one space
    edge = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(edge[-1]) - np.repeat(edge[:-1], size)
    joined = data[np.minimum(np.repeat(starts, size) + place, max(len(data) - 1, 0))]
    joined[edge[1:] - 1] = 32
    row = np.repeat(np.arange(len(words)), words)
    lo, hi, rows = [], [], []
    for n in range(1, longest + 1):
        at = np.flatnonzero(np.arange(len(row)) + n <= first[row + 1])
        lo.append(edge[at])
        hi.append(edge[at + n] - 1)
        rows.append(row[at])
    rows = np.concatenate(rows)
    order = np.argsort(rows, kind="stable")
    return joined, np.concatenate(lo)[order], np.concatenate(hi)[order], np.searchsorted(rows[order], np.arange(len(words) + 1)), words


def _counter(buckets: int, longest: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, total = PositionCrc(), np.zeros(buckets, np.int64)
        for batch in A.chunks(batches):
            data, starts, ends, _, _ = _features(batch, longest)
            total += np.bincount(crc(data, starts, ends) % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return count


def _weigher(gains: np.ndarray, longest: int):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = PositionCrc()
        for batch in A.chunks(batches):
            data, starts, ends, first, words = _features(batch, longest)
            sums = np.concatenate(([0], np.cumsum(gains[crc(data, starts, ends) % np.uint32(len(gains))])))
            n = np.diff(first)
            weight = (sums[first[1:]] - sums[first[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return weigh


def bucket_gains(spark: SparkSession, docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, s, t, gain): feature counts of documents and target, and floor(1000 ln) of the smoothed shares' ratio."""
    def counts(texts: DataFrame, name: str) -> DataFrame:
        return texts.select("text").mapInArrow(_counter(buckets, longest), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(name))

    found = spark.range(buckets).withColumnRenamed("id", "bucket").join(counts(docs, "s"), "bucket", "left").join(counts(target, "t"), "bucket", "left").na.fill(0)
    whole = Window.partitionBy()  # over at most ``buckets`` rows
    return (found.withColumn("all_s", F.sum("s").over(whole)).withColumn("all_t", F.sum("t").over(whole))
            .selectExpr("bucket", "s", "t", f"CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(all_s + {buckets} AS DOUBLE)) / "
                                            f"(CAST(s + 1 AS DOUBLE) * CAST(all_t + {buckets} AS DOUBLE)))) AS BIGINT) AS gain"))


def importance_resample(spark: SparkSession, docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
                        buckets: int = BUCKETS, longest: int = LONGEST, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight, score and rank (null where it isn't drawn)."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    gained = bucket_gains(spark, texts, target.select(F.col(target_col).alias("text")), buckets, longest).collect()
    gains = np.zeros(buckets, np.int64)
    for r in gained:
        gains[r.bucket] = r.gain
    weighed = texts.mapInArrow(_weigher(gains, longest), "doc_id long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + F.expr(GUMBEL.format(seed))).withColumn("row", F.monotonically_increasing_id())
    scored = written(spark, scored, "op11-scores")
    fit = F.col("n_words") >= least_words
    by_score = scored.filter(fit).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = by_score.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("score"))))  # a row per score, bounded as said above
    drawn = above.agg((F.sum("n") * percent / 100).cast("long")).first()[0] or 0
    least = above.filter(F.col("upto") >= drawn).agg(F.max("score")).first()[0] if drawn else None
    columns = [F.col(c) for c in ("doc_id", "n_words", "n_features", "weight", "score")]
    if least is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    inside = fit & (F.col("score") >= least)
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("row")]
    ranked = global_row_number(scored.filter(inside), order, "place")
    place = F.col("place").cast("long")
    return (ranked.select(*columns, F.when(place <= drawn, place).alias("rank"))
            .unionByName(scored.filter(~inside).select(*columns, F.lit(None).cast("long").alias("rank"))))
