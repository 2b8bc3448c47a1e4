"""Operator 9, benchmark decontamination: template canonicalisation.

Words lose their case (A-Z and the Latin-1 capitals) and the punctuation around them; numbers,
quantities, names and units become typed placeholders. A capitalised word that begins a sentence or line, and one with
several capitals, may be a name or not: its windows stand in both readings, in items and in documents, and of
the readings that meet at a place the one with the fewest names counts. Windows of five template words of every
benchmark item are hash-joined with the windows of every document. An item whose windows are found
in a document by ``share`` or more is a leak if its slots are filled consistently there: one value
of the item has one value, so a question with other numbers and names
is caught and a text that merely has placeholders in the same places isn't. A document may hold an item more than once,
each time filled otherwise: it is enough that one occurrence reaches both shares, or the document as a whole. Windows
found at the same distance from their places in the item are an occurrence, and so are those whose distances follow each other closely
(words put in or left out between them).

The benchmark's window hashes are sent to the tasks while there are at most ``most_windows`` of them (eight bytes
each); beyond that the windows of all documents meet them in a join.

Defined results: a null, empty or blank document or item leaks nothing; an item shorter than a window
is one window of all its words; items without slots are consistent; equal items each count; rows
that repeat a doc_id are texts of their own; an empty table on either side gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm.storage import keyed, written

SIZE, SHARE, MOST_WINDOWS = 5, 0.8, 4 << 20
ORDINARY, NUMBER, NAME, UNIT, QUANTITY = range(5)
UNITS = ("mm cm m km mg g kg t ml l s min h ms mph km/h kb mb gb hz khz mhz ghz w kw v a j kj cal kcal n pa mol "
         "inch inches foot feet yard yards mile miles ounce ounces pound pounds ton tons gallon gallons liter liters litre litres "
         "meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms second seconds minute minutes "
         "hour hours day days week weeks month months year years dollar dollars euro euros cent cents percent degree degrees").split()
WINDOWS = "doc_id long, crc long, hash long, pos int, kinds array<int>, vals array<long>"

_DIGIT, _LETTER, _UPPER, _STOP, _EDGE = (np.zeros(256, bool) for _ in range(5))
_DIGIT[48:58] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_UPPER[65:91] = True
_STOP[[ord(c) for c in ".!?:;"]] = True
_EDGE[33:48] = _EDGE[58:65] = _EDGE[91:97] = _EDGE[123:127] = True


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template hash, kind and own hash of each word, each row's first word, and the words that may be names as well."""
    starts, ends, first = A.word_spans(data, offsets)
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64), first, np.zeros(0, bool)
    high = np.zeros(len(data), bool)  # second byte of a Latin-1 capital in UTF-8
    high[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low = A.ascii_lower(data) + np.where(high, np.uint8(32), np.uint8(0))
    upper_at = _UPPER[data]
    upper_at[:-1] |= high[1:]
    # what is left between the punctuation at both ends; a word of punctuation alone stays whole
    core = ~_EDGE[data]
    place = np.flatnonzero(core)
    a, b = np.searchsorted(place, starts), np.searchsorted(place, ends)
    full = b > a
    s, e = starts.copy(), ends.copy()
    s[full], e[full] = place[a[full]], place[b[full] - 1] + 1
    own = A.span_hashes(low, s, e)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[e] - total[s]

    digits, letters, capitals = count(_DIGIT[data]), count(_LETTER[data]), count(upper_at)
    begins = np.ones(n, bool)
    begins[1:] = _STOP[data[ends[:-1] - 1]]
    gap = np.concatenate(([0], np.cumsum(data == 10)))
    begins[1:] |= gap[starts[1:]] > gap[ends[:-1]]
    begins[first[:-1][first[:-1] < n]] = True
    kind = np.zeros(n, np.int8)
    kind[upper_at[s] & (capitals == 1) & ~begins] = NAME
    kind[np.isin(own, _unit_hashes())] = UNIT
    kind[(digits > 0) & (letters == 0)] = NUMBER
    kind[(digits > 0) & (letters > 0) & (letters <= 3)] = QUANTITY
    return np.where(kind == ORDINARY, own, _fixed()[kind]), kind, own, first, (kind == ORDINARY) & upper_at[s]


def _fixed() -> np.ndarray:
    """Hash of each kind's placeholder."""
    return A.mix(np.arange(1, 6, dtype=np.uint64))


def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    starts, ends, _ = A.word_spans(data, np.array([0, len(data)]))
    return A.span_hashes(data, starts, ends)


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, before it is mixed: the sum of each word times a power."""
    n = max(0, len(words) - k + 1)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * A._BASE + words[j:j + n]
    return out


def _window_mapper(size: int, wanted=None, whole: bool = False):
    """Texts to their template windows: all of them, or those whose hash is among ``wanted``.

    ``whole`` keeps one window of all words of a text shorter than ``size`` (for items); documents give
    the shorter windows that ``wanted`` asks for.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches, limit=A.CHUNK_BYTES // 2):
            hashes, kind, own, first, maybe = template(*A.buffers(batch.column("text")))
            count = np.diff(first)
            sizes = [(size, None)] if whole else [(k, w) for k, w in (wanted.value if wanted is not None else {size: None}).items()]
            if whole:
                sizes += [(k, count == k) for k in range(1, size)]
            other = np.where(maybe, _fixed()[NAME], own) - hashes  # from a word's first reading to its second
            for k, pick in sizes:
                full = _grams(hashes, k)
                rows = np.where(pick, count, 0) if whole and pick is not None else count
                room = np.maximum(rows - k + 1, 0)
                rows_of = np.repeat(np.arange(len(count)), room)
                starts = np.arange(len(rows_of)) - np.repeat(np.cumsum(room) - room, room) + first[rows_of]
                # words of each window with a second reading, as bits
                open_words = np.zeros(len(starts), np.int64)
                for j in range(k):
                    twofold = maybe[starts + j] if len(starts) else np.zeros(0, bool)
                    if j == 0 and not whole and len(starts):
                        # an item's first word begins a sentence there, but may stand as a name in the middle of one here
                        twofold = twofold | (kind[starts] == NAME)
                    open_words |= twofold.astype(np.int64) << j
                for second in range(1 << k):
                    chosen = np.flatnonzero(open_words & second == second) if second else np.arange(len(starts))
                    if not len(chosen):
                        continue
                    row, at = rows_of[chosen], starts[chosen]
                    h = full[at]
                    for j in range(k):
                        if second >> j & 1:
                            h = h + other[at + j] * A.powers(k)[k - 1 - j]
                    yield from windows(batch, A.mix(h) + np.uint64(k), row, at, k, pick, second, kind, own, first)

    def windows(batch, h, row, at, k, pick, second, kind, own, first):
        if not whole and pick is not None:
            found = pick[np.minimum(np.searchsorted(pick, h), len(pick) - 1)] == h
            row, at, h = row[found], at[found], h[found]
        if not len(h):
            return
        kinds = kind[at[:, None] + np.arange(k)]
        for j in range(k):
            if second >> j & 1:
                kinds[:, j] = np.where(kinds[:, j] == NAME, ORDINARY, NAME)
        values = np.where(kinds == ORDINARY, np.uint64(0), own[at[:, None] + np.arange(k)])
        edges = pa.array(np.arange(0, len(h) * k + 1, k, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([
            *A.taken(batch, row, "doc_id", "crc"), pa.array(A.signed(h)), pa.array((at - first[row]).astype(np.int32)),
            pa.ListArray.from_arrays(edges, pa.array(kinds.ravel().astype(np.int32))),
            pa.ListArray.from_arrays(edges, pa.array(A.signed(values.ravel())))], names=["doc_id", "crc", "hash", "pos", "kinds", "vals"])

    return emit


def template_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text: str = "text", size: int = SIZE, share: float = SHARE, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """One row per (document, item) that leaks: doc_id, crc, item_id, n_windows, n_found, slots_consistent share."""
    docs = keyed(docs, id_col, text_col).filter("doc_id is not null and text is not null")
    items = keyed(benchmark, item_col, item_text).filter("doc_id is not null and text is not null")
    index = written(spark, items.mapInArrow(_window_mapper(size, whole=True), WINDOWS).select(
        F.struct("doc_id", "crc").alias("item"), "hash", F.size("kinds").alias("k"), F.col("pos").alias("at"), F.col("vals").alias("item_vals")), "op9-index")
    hashes = index.select("hash", "k").distinct()
    if hashes.count() <= most_windows:
        rows = hashes.toPandas()
        wanted = {int(k): np.sort(g["hash"].to_numpy(np.int64).view(np.uint64)) for k, g in rows.groupby("k")}
        windows = docs.mapInArrow(_window_mapper(size, spark.sparkContext.broadcast(wanted)), WINDOWS)
    else:
        wanted = {r.k: None for r in hashes.select("k").distinct().collect()}
        windows = docs.mapInArrow(_window_mapper(size, spark.sparkContext.broadcast(wanted)), WINDOWS)
    # one row for each different filling of an item's window in a document, with all its places
    found = windows.groupBy("doc_id", "crc", "hash", "kinds", "vals").agg(F.collect_set("pos").alias("places"))
    met = written(spark, found.join(index, "hash").select("doc_id", "crc", "item", "at", "kinds", "vals", "item_vals", "places"), "op9-met")
    totals = index.groupBy("item").agg(F.countDistinct("at").alias("n_windows"))
    near = (met.select("doc_id", "crc", "item", "at").distinct().groupBy("doc_id", "crc", "item").agg(F.count("*").alias("n_found"))
            .join(totals, "item").filter(F.col("n_found") >= share * F.col("n_windows")))
    near = written(spark, near, "op9-near")
    pair = ["doc_id", "crc", "item"]
    placed = met.join(near, pair).withColumn("pos", F.explode("places")).withColumn("shift", F.col("pos") - F.col("at"))
    names = F.size(F.filter("kinds", lambda x: x == NAME))
    placed = (placed.groupBy(*pair, "n_windows", "at", "shift").agg(F.min(F.struct(names.alias("names"), "kinds", "vals", "item_vals")).alias("best"))
              .select(*pair, "n_windows", "at", "shift", "best.kinds", "best.vals", "best.item_vals"))
    before = F.lag("shift").over(Window.partitionBy(*pair).orderBy("shift"))
    new = (F.col("shift") - before > F.greatest(F.lit(1), F.floor((1 - share) * F.col("n_windows")))).cast("int")
    run = F.sum("new").over(Window.partitionBy(*pair).orderBy("shift"))
    shifts = placed.select(*pair, "n_windows", "shift").distinct().withColumn("new", F.coalesce(new, F.lit(0))).select(*pair, "shift", run.alias("run"))
    # the document as a whole, runs of close shifts, and single shifts
    spots = F.array(F.struct(F.lit(0).alias("way"), F.lit(0).cast("long").alias("place")), F.struct(F.lit(1).alias("way"), F.col("run").cast("long").alias("place")),
                    F.struct(F.lit(2).alias("way"), F.col("shift").cast("long").alias("place")))
    tried = written(spark, placed.join(shifts, [*pair, "shift"]).withColumn("spot", F.explode(spots))
                    .select(*pair, "spot", "n_windows", "at", "kinds", "vals", "item_vals").distinct(), "op9-spots")
    spot = [*pair, "spot"]
    held = (tried.groupBy(*spot, "n_windows").agg(F.countDistinct("at").alias("n_found")).filter(F.col("n_found") >= share * F.col("n_windows")))
    slots = (tried.join(held.select(*spot), spot)
             .select(*spot, F.explode(F.arrays_zip("kinds", "vals", "item_vals")).alias("s")).filter(f"s.kinds <> {ORDINARY}")
             .groupBy(*spot, "s.item_vals", "s.vals").agg(F.count("*").alias("k")))
    same = (slots.groupBy(*spot, "item_vals").agg(F.max("k").alias("most"), F.sum("k").alias("all"))
            .groupBy(*spot).agg((F.sum("most") / F.sum("all")).alias("consistent")))
    same = (held.join(same, spot, "left").groupBy(*pair).agg(F.max(F.coalesce("consistent", F.lit(1.0))).alias("consistent")))
    return (near.join(same, pair)
            .filter(F.col("consistent") >= share)
            .select("doc_id", "crc", F.col("item.doc_id").alias("item_id"), "n_windows", "n_found", "consistent"))
