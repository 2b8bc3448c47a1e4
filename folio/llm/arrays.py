"""Vectorised text primitives used inside Spark's Arrow tasks.

Everything here is a small helper over one bounded chunk of rows: byte buffers, word spans,
64-bit content hashes and content-chosen anchors. Spark does the partitioning, shuffling and
grouping around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20  # text bytes handled at once; one longer text makes a chunk of its own

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    kept = _powers.get(int(base))
    if kept is None or len(kept) < n:
        size = max(n, CHUNK_BYTES + 1)
        kept = np.full(size, base, dtype=np.uint64)
        kept[0] = 1
        np.multiply.accumulate(kept, out=kept)
        if size <= 4 * CHUNK_BYTES:
            _powers[int(base)] = kept
    return kept[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose text stays near ``limit`` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and row offsets (from 0); a null row is empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column, b"" if kind == pa.large_binary() else "").cast(kind)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each run of non-space bytes, and each row's first word number (rows + 1 entries).

    ``space`` marks the bytes between words, by default the six ASCII characters; a word never crosses rows.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~space[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = word[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < n]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = word[1:]
    cuts = offsets[1:] - 1
    after[cuts[cuts >= 0]] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit content hash of each byte span; spans don't overlap and are in order."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    at = np.cumsum(lens) - lens
    total = int(at[-1] + lens[-1])
    place = np.arange(total, dtype=np.int64) - np.repeat(at, lens)
    picked = data[np.repeat(starts, lens) + place]
    sums = np.add.reduceat(_BYTE[picked] * powers(int(lens.max()))[place], at)
    return mix(sums ^ (lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values (len - k + 1 of them)."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    n = len(values) - k + 1
    out = values[:n].copy()
    for j in range(1, k):
        out *= _BASE
        out += values[j:j + n]
    return mix(out)


def byte_grams(data: np.ndarray, log_k: int) -> np.ndarray:
    """Hash of every run of 2**log_k consecutive bytes, by doubling."""
    h, k = _BYTE[data], 1
    for _ in range(log_k):
        if len(h) <= k:
            return np.zeros(0, np.uint64)
        h = h[:-k] * np.uint64(pow(int(_BASE), k, 2**64)) + h[k:]
        k *= 2
    return mix(h)


class RunHash:
    """Hashes of arbitrary runs of a value array, from prefix sums."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(len(values)), out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray) -> np.ndarray:
        back = powers(len(self.sums), _INV)
        h = (self.sums[end] - self.sums[start]) * back[start]
        return mix(h ^ (mix((end - start).astype(np.uint64)) + salt.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def sliding_argmin(order: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in every run of ``width`` values (32-bit values, numbers below 2**32)."""
    n = len(order)
    if n < width:
        return np.zeros(0, np.int64)
    packed = (order.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = packed
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(back[:m], ahead[width - 1:width - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchored_runs(hashes: np.ndarray, order: np.ndarray, first: np.ndarray, last: np.ndarray,
                  window: int, k: int) -> tuple[np.ndarray, ...]:
    """Content-chosen anchors: every window of ``window`` units picks the least k-gram inside it.

    ``first``/``last`` bound each row's units. Returns (anchor hash, anchor place, first and last window start
    that picked it, row); a window belongs to exactly one entry, and equal windows pick the same anchor at the
    same distance from their start.
    """
    picked = sliding_argmin(order, window - k + 1)
    counts = np.maximum(last - first - window + 1, 0)
    total = int(counts.sum())
    if total == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    row = np.repeat(np.arange(len(first)), counts)
    starts = np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    at = picked[starts]
    change = np.empty(total, bool)
    change[0] = True
    change[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    lead = np.flatnonzero(change)
    tail = np.append(lead[1:], total) - 1
    return hashes[at[lead]], at[lead], starts[lead], starts[tail], row[lead]


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Boolean mask of 0..n-1 covered by the half-open intervals."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.minimum(starts, n), 1)
    np.add.at(edge, np.minimum(ends, n), -1)
    return np.cumsum(edge[:-1]) > 0


def taken(batch: pa.RecordBatch, row: np.ndarray, *names: str) -> list[pa.Array]:
    """The named columns' values at the given rows, nulls included."""
    at = pa.array(row, pa.int64())
    return [batch.column(n).take(at) for n in names]


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
