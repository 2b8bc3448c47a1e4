"""Operator 8, toxicity: compression distance to two zstandard dictionaries.

One dictionary is trained on ordinary text, one is built from toxic text: the words and stems that toxic
documents hold far more often, the most telling ones last (a trained one would hold mostly the ordinary
words that fill toxic documents too). Each window of a text is compressed with the ordinary dictionary alone
and with both; the bytes that the toxic one saves say how toxic the window is. A logistic regression over
a document's largest and mean savings, fitted on the labelled rows, gives thresholds and the score.

Dictionaries and regression are fitted on at most ``sample`` labelled documents of each class, chosen by a
hash of their id, one text of each id and ``sample_bytes`` bytes of a class; every document is scored over its whole text. Only the text and the labels of rows that are not
held out are used.

Defined results: a null or empty text is one empty window and gets the score of no savings; without
two classes among the usable labels all scores are 0; labels that are null are not used; rows that
repeat a doc_id are scored alike by their text; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import written

SAMPLE, SAMPLE_BYTES = 2000, 24 << 20  # labelled documents of a class, and bytes of text of a class, at most
WINDOW, ORDINARY_BYTES = 8, 8 << 10
TOP, LARGE, FOLDS = 3, 2, 5
LEAST_DOCS, LEAST_RATIO = 3, 8.0
MOST_CHANCE = 1e-8  # that a stem which says nothing passes; there are up to about a million stems
STEMS = (5, 6, 7, 8, 10)


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


class Scorer:
    """The two dictionaries, and the savings of a chunk of texts."""

    def __init__(self, ordinary: bytes, toxic: bytes, weights: np.ndarray | None = None):
        self.ordinary, self.toxic, self.weights = ordinary, toxic, weights
        self._made = None

    def __getstate__(self):
        return self.ordinary, self.toxic, self.weights

    def __setstate__(self, state):
        self.__init__(*state)

    def _compressors(self):
        if self._made is None:
            made = []
            for content in (self.ordinary, self.ordinary + self.toxic):
                kept = zstandard.ZstdCompressionDict(content or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                how = zstandard.ZstdCompressionParameters(window_log=17, hash_log=14, chain_log=14, search_log=4, min_match=4, target_length=16,
                                                          strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
                kept.precompute_compress(compression_params=how)
                made.append(zstandard.ZstdCompressor(dict_data=kept, compression_params=how))
            self._made = made
        return self._made

    def savings(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document of each window, and its saved bytes per hundred."""
        plain, both = (c.compress for c in self._compressors())
        low = A.ascii_lower(data)
        starts, ends, first = A.word_spans(low, offsets)
        count = np.diff(first)
        windows = -(-count // WINDOW)
        row = np.repeat(np.arange(len(count)), windows)
        lead = (np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW + first[row]
        last = np.minimum(lead + WINDOW, first[row + 1]) - 1
        raw = low.tobytes()
        saved = np.zeros(len(row))
        for i, (a, b) in enumerate(zip(starts[lead].tolist(), ends[last].tolist(), strict=True)):
            part = raw[a:b]
            saved[i] = len(plain(part)) - len(both(part))
        return row, saved

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per document: the largest savings, sorted, the mean, and the share of windows with large savings."""
        n = len(offsets) - 1
        row, saved = self.savings(data, offsets)
        out = np.zeros((n, TOP + 4))
        order = np.lexsort((-saved, row))
        r, v = row[order], saved[order]
        edge = np.searchsorted(r, np.arange(n + 1))
        size = np.diff(edge)
        for j in range(TOP):
            ok = size > j
            out[ok, j] = v[edge[:-1][ok] + j]
        some = np.maximum(size, 1)
        out[:, TOP] = np.bincount(row, weights=saved, minlength=n) / some
        out[:, TOP + 1] = np.log1p(np.bincount(row, weights=saved >= LARGE, minlength=n))
        out[:, TOP + 2] = 10 * np.bincount(row, weights=saved >= LARGE, minlength=n) / some
        out[:, TOP + 3] = 1
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(self.features(data, offsets) @ self.weights, -40, 40)))


def _packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)


def _stems(word: bytes) -> list[bytes]:
    """The word and its beginnings of some length; a stem may take any ending."""
    return [word[:n] for n in STEMS if n < len(word)] + [word]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary's content; with too few samples for training, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(dict.fromkeys(samples))[-size:]


def _chance(k: int, m: int, n_toxic: int, n_ordinary: int) -> float:
    """Most chance (Chernoff's bound) that ``k`` or more of the ``k + m`` documents with a stem are toxic if the stem says nothing."""
    share, base = k / (k + m), n_toxic / (n_toxic + n_ordinary)
    if share <= base:
        return 1.0
    apart = share * np.log(share / base) + ((1 - share) * np.log((1 - share) / (1 - base)) if m else 0.0)
    return float(np.exp(-(k + m) * apart))


def _telling(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> bytes:
    """The stems that the toxic documents hold beyond chance, the most telling ones last. Each stem is judged by its own counts alone.

    Copies count once, since they say nothing new about a stem.
    """
    has = [Counter(p for words in {tuple(w) for w in docs} for p in {q for w in set(words) for q in _stems(w)}) for docs in (toxic, ordinary)]
    n_toxic, n_ordinary = (len({tuple(w) for w in docs}) for docs in (toxic, ordinary))
    ratio = n_ordinary / n_toxic
    worth = {p: k * float(np.log(k * ratio / (has[1][p] + 1))) for p, k in has[0].items()
             if k >= min(LEAST_DOCS, n_toxic) and k * ratio >= LEAST_RATIO * (has[1][p] + 1)
             and (n_toxic < LEAST_DOCS or _chance(k, has[1][p], n_toxic, n_ordinary) <= MOST_CHANCE)}
    # each word stands for its most telling stem; the most telling come last, next to the text that is compressed
    best = {max(_stems(w), key=lambda p: (worth.get(p, 0.0), len(p))) for words in toxic for w in set(words)}
    return b"".join(b" " + p for p in sorted((p for p in best if p in worth), key=lambda p: (worth[p], p)))


def fit(toxic: list[str], ordinary: list[str]) -> Scorer:
    """Dictionaries and calibration from two samples of texts."""
    if not toxic or not ordinary:
        return Scorer(b"", b"")
    split = [[A.ascii_lower(np.frombuffer(t.encode(), np.uint8)).tobytes().split() for t in texts] for texts in (toxic, ordinary)]
    plain = [b" ".join(words[i:i + WINDOW]) for words in split[1] for i in range(0, len(words), WINDOW)]
    made = Scorer(_dictionary(plain, ORDINARY_BYTES), _telling(*split))
    x = np.concatenate([made.features(*_packed([t.encode() for t in texts])) for texts in (toxic, ordinary)])
    y = np.repeat([1.0, 0.0], [len(toxic), len(ordinary)])
    w = np.zeros(x.shape[1])
    for _ in range(25):  # ridge Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x.T * (p * (1 - p) + 1e-9)) @ x + 0.05 * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (p - y) + 0.05 * w)
    made.weights = w
    return made


def compression_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) == 0
    truth = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("y is not null and doc_id is not null").filter(~out)
    truth = truth.groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = None
    for y in (1, 0):
        part = truth.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    fitted = rows.join(F.broadcast(chosen), "doc_id").filter("text is not null").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    fitted = written(spark, fitted.withColumn("size", F.octet_length("text")), "op8-fitted")  # at most ``sample`` rows a class
    # the byte bound stands in the plan, before any text reaches the driver
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    within = fitted.select("doc_id", F.sum("size").over(order).alias("upto")).filter(F.col("upto") <= sample_bytes).select("doc_id")
    bounded = fitted.join(within, "doc_id")
    texts: dict[int, list[str]] = {0: [], 1: []}
    for r in bounded.orderBy("y", F.xxhash64("doc_id"), "doc_id").select("text", "y").toLocalIterator():
        texts[r.y].append(r.text)
    scorer = spark.sparkContext.broadcast(fit(texts[1], texts[0]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            values = scorer.value.scores(*A.buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.withColumn("held_out", F.coalesce(out, F.lit(False))).mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
