"""Operator 12, periodic runs of words: seeds on diagonals, extended once each.

A run is a maximal stretch of at least max(``least``, ``copies`` x period) words that repeats with its smallest period. On the
diagonal of lag q (word i against word i + q) a run of period q is an unbroken match of at least max(least, copies q) - q words.
Lags are taken in bands; the least of these guaranteed overlaps in a band is k, and a band goes on as long as its lags are at
most k. Every run then holds a k-gram that occurs again one period later and, since k is no shorter than the period, nowhere in
between: a nearer copy would give the stretch a smaller period. So it is enough to pair each k-gram with its next occurrence
in the document, which makes at most one pair a word and band; bands grow by a constant factor. Of pairs whose
predecessor has the same lag only the first is kept, and a table by lag of the furthest covered place lets
a second seed of the same stretch go. What is left is extended both ways by comparing words.

k-grams meet by 64-bit hashes; the extension compares words by 64-bit hashes of their bytes. Each document is handled where it
stands: there is no shuffle.

Defined results: a null or empty text has no words, no runs and an empty kept text; repeated rows are documents of their own;
an empty table gives an empty result; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import arrays as A

LEAST, COPIES = 6, 4
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def periodic_runs(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), kept_text: the words left, joined by one space.

    A word goes if it stands in a run after that run's first period. ``copies`` is at least 2.
    """
    if copies < 2 or least < 2:
        raise ValueError("a run needs two copies at least")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_mapper(least, copies), f"doc_id long, n_words long, runs array<{RUN}>, kept_text string")


def longest_run(runs: F.Column) -> F.Column:
    """The run with the greatest length; ties by the smallest start, then period. Null where there is none."""
    ordered = F.array_sort(F.transform(runs, lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    best = F.get(ordered, F.lit(0))
    return F.when(F.size(runs) > 0, F.struct(best.start.alias("start"), (-best.less).alias("length"), best.period.alias("period")))


def bands(longest: int, least: int = LEAST, copies: int = COPIES) -> Iterator[tuple[int, int, int]]:
    """(least lag, greatest lag, k) of each band, for documents of up to ``longest`` words."""
    lags = np.arange(1, longest // copies + 1)
    overlap = np.maximum(least, copies * lags) - lags
    at = 0
    while at < len(lags) and max(least, copies * (at + 1)) <= longest:
        lowest = np.minimum.accumulate(overlap[at:])
        fits = lowest >= lags[at:]
        n = len(fits) if fits.all() else int(np.argmin(fits))
        yield int(lags[at]), int(lags[at + n - 1]), int(lowest[n - 1])
        at += n


def _match(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """First place from ``at`` on whose word differs from the one ``lag`` later; at most ``stop``."""
    step = 32
    while at < stop:
        to = min(at + step, stop)
        differ = words[at:to] != words[at + lag:to + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = to, step * 2
    return stop


def _match_back(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """Start of the unbroken match that ends before ``at``; at least ``stop``."""
    step = 32
    while at > stop:
        to = max(at - step, stop)
        differ = words[to:at] != words[to + lag:at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = to, step * 2
    return stop


def find_runs(words: np.ndarray, first: np.ndarray, least: int = LEAST, copies: int = COPIES) -> np.ndarray:
    """Rows (document, start, length, period) of all runs; document d holds the word hashes first[d]:first[d + 1]."""
    size = np.diff(first)
    hashed = A.RunHash(words)
    found: list[tuple[int, int, int, int]] = []
    for lo, hi, k in bands(int(size.max(initial=0)), least, copies):
        rows = np.flatnonzero(size >= max(least, copies * lo))
        counts = size[rows] - k + 1
        row = np.repeat(rows, counts)
        at = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
        key = hashed(at, at + k, row)
        order = np.argsort(key, kind="stable")
        key, place = key[order], at[order]
        next_to = np.flatnonzero(key[1:] == key[:-1])
        seed, lag = place[next_to], place[next_to + 1] - place[next_to]
        doc = row[order][next_to]
        near = (lag >= lo) & (lag <= hi) & (size[doc] >= np.maximum(least, copies * lag))
        seed, lag, doc = seed[near], lag[near], doc[near]
        order = np.lexsort((seed, lag))
        seed, lag, doc = seed[order], lag[order], doc[order]
        head = np.ones(len(seed), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (seed[1:] != seed[:-1] + 1) | (doc[1:] != doc[:-1])
        covered: dict[int, int] = {}  # furthest place covered, by lag
        for i, q, d in zip(seed[head].tolist(), lag[head].tolist(), doc[head].tolist(), strict=True):
            if i < covered.get(q, -1):
                continue
            start, stop = _match_back(words, i, q, int(first[d])), _match(words, i, q, int(first[d + 1]) - q)
            covered[q] = stop
            if stop - start + q >= max(least, copies * q):
                found.append((d, start - int(first[d]), stop - start + q, q))
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), np.int64).reshape(-1, 4)


def _mapper(least: int, copies: int):
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches):
            data, offsets = A.buffers(batch.column("text"))
            starts, ends, first = A.word_spans(data, offsets)
            runs = find_runs(A.span_hashes(data, starts, ends), first, least, copies)
            keep = np.ones(len(starts), bool)
            if len(runs):
                begin = first[runs[:, 0]] + runs[:, 1]
                keep = ~A.cover(begin + runs[:, 3], begin + runs[:, 2], len(starts))
            text, edges = _joined(data, offsets, starts, ends, first, keep)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1)), pa.int32()),
                                             pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], fields=list(kind)))
            kept = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(text))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), lists, kept.cast(pa.string())],
                                             names=["doc_id", "n_words", "runs", "kept_text"])

    return emit


def _joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's kept words joined by one space: all bytes, and the rows' offsets in them."""
    kept = np.flatnonzero(keep)
    row = np.searchsorted(first, kept, side="right") - 1
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    stay = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    inner = ends[kept[:-1][row[:-1] == row[1:]]]  # the byte after a word that another one of its row follows is a space
    out = data.copy()
    out[inner] = 32
    stay[inner] = True
    return out[stay], np.concatenate(([0], np.cumsum(stay)))[offsets]
