"""Operator 3, n-gram Jaccard join: grouped prefix join.

A document's set is its distinct word shingles. Equal sets are one class. Shingles are ordered so
that those found often come last, the rest by hash; two sets can only be similar enough if they share
a shingle among the first ``n - ceil(t n) + 1`` of that order. Classes with the same prefix and size are one
group. Groups that share a prefix shingle are compared by size, by place of that shingle and by parity bits of the
whole sets, what remains is expanded to the groups' members and verified on the whole texts.

Links are only needed up to reachability, so a crowd of similar documents isn't compared all with
all: first each class meets a few pivots per shared shingle, and classes found to be
connected need no further comparison with each other. After that every pair that shares a prefix shingle,
passes the filters (size, place, and a sketch of parity bits that can't lose a link) and lies in different components is verified, so no link between components is lost.

The order of shingles only steers the work. It counts shingles over all documents, keeps those that
repeat within a task's stretch of text, and sends at most ``most_frequent`` of them to the tasks.

Defined results: a null, empty or blank text has the empty set and is linked with nothing; fewer words
than ``size`` make one shingle of them all; rows that repeat a doc_id are texts of their own; rows
with a null doc_id get no part in any component but their own (null); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.llm import arrays as A
from folio.llm import repeats as R
from folio.llm.storage import keyed, small_batches, written

SIZE, PERCENT, MOST_FREQUENT, PIVOTS = 3, 90, 1 << 20, 2
SKETCH = 32  # shingles for each word of 64 bits in a sketch, whose words are a power of two
MEETING_WORDS = 16  # of a sketch that go with every row of a bucket, however long the text
FLIPS = 0x1E3779B97F4A7C15
STRETCH = 4 << 20  # shingles counted at once in a task
STRETCH_REPEATS, STRETCH_PARTS, FREQUENT = 4, 8, 32


def grouped_prefix_join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                        percent: int = PERCENT, most_frequent: int = MOST_FREQUENT, pivots: int = PIVOTS) -> DataFrame:
    """One row per document: doc_id, crc, n_shingles, class_id, component_id."""
    with small_batches(spark):
        return _joined(spark, keyed(docs, id_col, text_col), size, percent, most_frequent, pivots)


def _joined(spark: SparkSession, docs: DataFrame, size: int, percent: int, most_frequent: int, pivots: int) -> DataFrame:
    known = docs.filter("doc_id is not null and text is not null")
    late = spark.sparkContext.broadcast(_frequent(known, size, most_frequent))

    signatures = written(spark, known.mapInArrow(_signature_mapper(size, percent, late),
                                                 "doc_id long, crc long, n long, cls long, grp long, sketch array<long>, prefix array<long>"), "op3-signatures")
    classes = written(spark, signatures.filter("n > 0").groupBy("cls")
                      .agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "crc")).alias("one"),
                           *[F.first(c).alias(c) for c in ("n", "grp", "sketch", "prefix")]), "op3-classes")
    # Prefixes are looked at once for each group, not once for each document.
    grouped = classes.groupBy("grp", "n").agg(F.first("prefix").alias("prefix"), F.count("*").alias("k"))
    # Most tokens stand in one group only: one exchange by token finds and drops them, in order of groups.
    prefixes = grouped.select(F.posexplode("prefix").alias("pos", "token"), "grp", "n")
    beside = Window.partitionBy("token").orderBy("grp")
    found = prefixes.select("*", F.lag("grp").over(beside).alias("before"), F.lead("grp").over(beside).alias("after"))
    buckets = found.filter("before is not null or after is not null").select("token", "grp", "n", "pos")
    buckets = buckets.unionByName(grouped.filter("k > 1").select(F.col("grp").alias("token"), "grp", "n", F.lit(0).alias("pos")))
    rows = written(spark, buckets.join(classes.select("grp", "cls"), "grp").select("token", "cls", "grp", "n", "pos"), "op3-rows")

    sketches = classes.select("cls", "n", "sketch")
    starred = written(spark, _near(_star(spark, rows, pivots, percent), sketches, percent), "op3-starred")
    links = written(spark, _verified(starred, _texts(spark, known, classes, starred), size, percent), "op3-links")
    nodes = classes.select(F.col("cls").alias("node"), F.col("rep").alias("label"))
    forest = star_forest(spark, links)
    label = labelled(nodes, forest)
    pairs = _across(spark, rows, classes.join(label, F.col("cls") == F.col("node")).select("grp", "cls", F.col("label").alias("comp"), "n", "sketch"), percent)
    pairs = written(spark, pairs.join(starred, ["a", "b"], "left_anti"), "op3-pairs")
    more = written(spark, _verified(pairs, _texts(spark, known, classes, pairs), size, percent), "op3-more-links")
    label = labelled(nodes, star_forest(spark, forest.unionByName(more))).select(F.col("node").alias("cls"), F.col("label").alias("comp"))
    linked = signatures.join(label, "cls", "left")
    result = linked.select("doc_id", "crc", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cls")).alias("class_id"),
                           F.coalesce("comp", "doc_id").alias("component_id"))
    rest = docs.filter("doc_id is null or text is null").select("doc_id", "crc", F.when(F.col("text").isNull(), F.lit(0)).cast("long").alias("n_shingles"),
                                                                F.lit(None).cast("long").alias("class_id"), F.col("doc_id").alias("component_id"))
    return result.unionByName(rest)


def star_forest(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(a, b): each linked node a but the least of its component, and that least node b.

    Rounds of two steps over all links, until nothing changes: every node ties its greater neighbours to the least node it sees, then itself
    and its smaller neighbours to the least of those. Distances to the least node shrink by a factor, so the rounds grow with the logarithm
    of the longest chain.
    """
    edges = written(spark, links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.u).filter("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(spark, large, "stars")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(spark, small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        last, mark = mark, tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == last:
            return edges


def labelled(nodes: DataFrame, forest: DataFrame) -> DataFrame:
    """(node, label) with the least label of each node's component; ``nodes`` may bring several labels in."""
    rooted = nodes.join(forest, nodes.node == forest.a, "left").select("node", "label", F.coalesce("b", "node").alias("root"))
    best = rooted.groupBy("root").agg(F.min("label").alias("best"))
    return rooted.join(best, "root").select("node", F.col("best").alias("label"))


def _passes(n1, n2, p1, p2, percent: int):
    """Size and place filter: the most that two sets can share after meeting at places p1 and p2."""
    most = F.least(p1, p2) + 1 + F.least(n1 - p1 - 1, n2 - p2 - 1)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * most >= percent * (n1 + n2))


def _prefix_overlap(n1, n2, percent: int):
    """Shingles that the prefixes of two linked sets share at least, and the half of them that may be left out from the prefixes' ends.

    In the common order, a shingle up to the smaller of the two prefixes' ends is shared in the prefixes or not at all; beyond it a set has
    no more than what its prefix leaves.
    """
    rest = lambda n: F.ceil(F.lit(percent) * n / 100) - 1
    shared = F.greatest(F.lit(1), F.ceil(F.lit(percent) * (n1 + n2) / (100 + percent)) - F.greatest(rest(n1), rest(n2)))
    return shared, F.ceil(shared / 2)


def _early(n1, n2, p1, p2, percent: int):
    """Whether a meeting lies before the last places of both prefixes. Of ``shared`` meetings, in order, only the last ``late - 1`` can lie there:
    so linked sets keep more than ``shared - late``, and frequent shingles, which stand last, make fewer rows."""
    _, late = _prefix_overlap(n1, n2, percent)
    size = lambda n: n - F.ceil(F.lit(percent) * n / 100) + 1
    return (p1 <= size(n1) - late) & (p2 <= size(n2) - late)


def _may_link(n1, n2, s1, s2, percent: int):
    """Parity bits of shingles by hash: sets differ in at least as many shingles as their bits do, so this loses no link.

    Of two sketches the one with twice as many words is folded.
    """
    words = F.least(F.size(s1), F.size(s2))

    def folded(s):
        return F.when(F.size(s) == words, s).otherwise(F.zip_with(F.slice(s, F.lit(1), words), F.slice(s, words + 1, words), lambda x, y: x.bitwiseXOR(y)))

    apart = F.aggregate(F.zip_with(folded(s1), folded(s2), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & ((100 + percent) * apart <= (100 - percent) * (n1 + n2))


def _folded_to(sketch, words: int):
    """A sketch with at most so many words: what a sketch of that width holds, as each bit's place is its hash modulo the width."""
    xor = lambda i: F.aggregate(F.sequence(i + 1, F.size(sketch), F.lit(words)), F.lit(0).cast("long"), lambda t, j: t.bitwiseXOR(F.element_at(sketch, j)))
    return F.when(F.size(sketch) <= words, sketch).otherwise(F.transform(F.sequence(F.lit(0), F.lit(words - 1)), xor))


def _near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    one = sketches.select(F.col("cls").alias("a"), F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    two = sketches.select(F.col("cls").alias("b"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    return pairs.join(one, "a").join(two, "b").filter(_may_link(F.col("n1"), F.col("n2"), F.col("s1"), F.col("s2"), percent)).select("a", "b")


def _star(spark: SparkSession, rows: DataFrame, pivots: int, percent: int) -> DataFrame:
    """Each class with ``pivots`` other classes of every bucket it is in, which all of the bucket's classes meet."""
    met = []
    for turn in range(pivots):
        band = F.floor(F.log(F.col("n").cast("double")) / np.log(100 / percent) + F.lit(turn / pivots))
        banded = rows.withColumn("band", band)
        # Class ids are hashes: the least of them, with other bits flipped in each turn, is a class by chance. A class alone in its bucket is no pivot.
        pivot = banded.groupBy("token", "band").agg(F.min(F.struct(F.col("cls").bitwiseXOR(F.lit(FLIPS * turn % 2**63)).alias("order"), "n", "pos")).alias("p"), F.count("*").alias("k"))
        pivot = written(spark, pivot.filter("k > 1").select("token", "band", F.col("p.order").bitwiseXOR(F.lit(FLIPS * turn % 2**63)).alias("pcls"),
                                                            F.col("p.n").alias("pn"), F.col("p.pos").alias("ppos")), f"op3-pivots{turn}")
        near = banded.join(pivot, ["token", "band"]).filter("cls <> pcls").filter(_passes(F.col("n"), F.col("pn"), F.col("pos"), F.col("ppos"), percent))
        met.append(near.select(F.least("cls", "pcls").alias("a"), F.greatest("cls", "pcls").alias("b")))
    return reduce(DataFrame.unionByName, met).distinct()


def _meets(minor: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(c1, g1, n1, c2, g2, n2, met): how often two groups of different components meet; the smaller component stands first.

    Where both sides bring ``bits1`` and ``bits``, sketches of groups of one class (null: of several), pairs whose sketches are too far
    apart make no rows: a crowd of texts that resemble each other without being linked costs comparisons, but nothing is written for it.
    Plain columns as keys: with structs compared and hashed in it, the join's loop took the compiler of each executor half a GB of memory.
    """
    # Two groups outside the main component meet once in a bucket.
    on = ((minor.token == groups.token) & ((groups.comp == minor.main) | (minor.c1 < groups.comp))
          & _passes(F.col("n1"), F.col("n"), F.col("p1"), F.col("pos"), percent) & _early(F.col("n1"), F.col("n"), F.col("p1"), F.col("pos"), percent))
    if "bits1" in minor.columns:
        on = on & (F.col("bits1").isNull() | F.col("bits").isNull() | _may_link(F.col("n1"), F.col("n"), F.col("bits1"), F.col("bits"), percent))
    first = F.col("c1") < F.col("comp")
    both = {"c": ("c1", "comp"), "g": ("g1", "grp"), "n": ("n1", "n")}
    keys = [F.when(first, F.col(x)).otherwise(F.col(y)).alias(f"{k}1") for k, (x, y) in both.items()]
    keys += [F.when(first, F.col(y)).otherwise(F.col(x)).alias(f"{k}2") for k, (x, y) in both.items()]
    return minor.join(groups, on).select(*keys).groupBy("c1", "g1", "n1", "c2", "g2", "n2").agg(F.count("*").alias("met"))


def _across(spark: SparkSession, rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """All pairs left that lie in different components: in each bucket, those outside its main component with all others.

    Pairs are formed between groups (of one component) and expanded to the members afterwards, where the sketches pass.
    """
    held = written(spark, classes, "op3-held")
    # One class stands for its group; bits go with it only if it is the group's one class, so that no member is judged by another's.
    lone = held.groupBy("grp", "comp").agg(F.count("*").alias("k"), F.min("cls").alias("cls"), F.first("sketch").alias("sketch"))
    lone = lone.select("cls", "comp", "k", F.when(F.col("k") == 1, _folded_to(F.col("sketch"), MEETING_WORDS)).alias("bits"))
    groups = rows.join(written(spark, lone, "op3-lone"), "cls").select("token", "grp", "n", "pos", "comp", "k", "bits")
    weight = groups.select("token", "comp", "k").repartition("token").groupBy("token", "comp").agg(F.sum("k").alias("k"))
    main = written(spark, weight.groupBy("token").agg(F.max(F.struct("k", "comp")).alias("m"), F.count("*").alias("comps")).filter("comps > 1")
                   .select("token", F.col("m.comp").alias("main")), "op3-main")
    # Both sides of the join read one exchange by token: the same columns and filters, so that Spark sees one plan.
    groups = groups.select("token", "grp", "n", "pos", "comp", "bits").filter(" and ".join(f"{c} is not null" for c in ("token", "grp", "n", "pos", "comp"))).repartition("token")
    minor = groups.join(main, "token").filter("comp <> main").select("token", "main", F.col("grp").alias("g1"), F.col("n").alias("n1"), F.col("pos").alias("p1"),
                                                                     F.col("comp").alias("c1"), F.col("bits").alias("bits1"))
    meets = _meets(minor, groups, percent)
    shared, late = _prefix_overlap(F.col("n1"), F.col("n2"), percent)
    pairs = meets.filter((F.col("g1") == F.col("g2")) | (F.col("met") > shared - late)).select("g1", "c1", "g2", "c2")
    one = held.select(F.col("grp").alias("g1"), F.col("comp").alias("c1"), F.col("cls").alias("x"), F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    two = held.select(F.col("grp").alias("g2_"), F.col("comp").alias("c2_"), F.col("cls").alias("y"), F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    near = _may_link(F.col("n1"), F.col("n2"), F.col("s1"), F.col("s2"), percent)
    return pairs.join(one, ["g1", "c1"]).join(two, (F.col("g2") == F.col("g2_")) & (F.col("c2") == F.col("c2_")) & near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _shingles(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, row by row, and the rows' offsets in them."""
    data, offsets = A.buffers(batch.column("text"))
    low = A.ascii_lower(data)
    starts, ends, first = A.word_spans(low, offsets)
    words = A.span_hashes(low, starts, ends)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), np.maximum(count - size + 1, 0))
    at = np.arange(len(row)) - np.repeat(np.cumsum(np.maximum(count - size + 1, 0)) - np.maximum(count - size + 1, 0), np.maximum(count - size + 1, 0))
    full = A.grams(words, size)
    hashes = full[at + first[row]] if len(row) else np.zeros(0, np.uint64)
    for k in range(1, size):  # a shorter text is one shingle
        short = np.flatnonzero(count == k)
        if len(short):
            own = A.mix(A.grams(words, k)[first[short]] + np.uint64(k))
            row, hashes = np.append(row, short), np.append(hashes, own)
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    if len(row):
        new = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))
        row, hashes = row[new], hashes[new]
    return hashes, np.searchsorted(row, np.arange(batch.num_rows + 1))


def _frequent(docs: DataFrame, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many documents hold, sorted, and the logarithm of how many."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def counted():
            for part in range(STRETCH_PARTS):  # each sorted by itself, so that less is held at once
                values, counts = np.unique(np.concatenate([h[h % np.uint64(STRETCH_PARTS) == part] for h in held]), return_counts=True)
                keep = counts >= STRETCH_REPEATS
                yield pa.RecordBatch.from_arrays([pa.array(A.signed(values[keep])), pa.array(counts[keep].astype(np.int64))], names=["token", "k"])

        for batch in A.chunks(batches, limit=A.CHUNK_BYTES // 2):
            held.append(_shingles(batch, size)[0])
            total += len(held[-1])
            if total > STRETCH:
                yield from counted()
                held, total = [], 0
        if total:
            yield from counted()

    counts = docs.mapInArrow(emit, "token long, k long").groupBy("token").agg(F.sum("k").alias("k")).filter(F.col("k") >= FREQUENT)
    top = counts.orderBy(F.desc("k"), "token").limit(most).toPandas()
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.log2(top["k"].to_numpy(np.float64))[order].astype(np.uint64)


def _ordered(batch: pa.RecordBatch, size: int, percent: int, late) -> tuple[np.ndarray, ...]:
    """Per row: offsets of its set, set size, prefix length, and the set in the global order."""
    hashes, edges = _shingles(batch, size)
    tokens, level = late.value
    rank = hashes >> np.uint64(6)
    if len(tokens) and len(hashes):
        at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
        rank = rank | np.where(tokens[at] == hashes, (level[at] + np.uint64(1)) << np.uint64(58), np.uint64(0))
    n = np.diff(edges)
    row = np.repeat(np.arange(len(n)), n)
    hashes = hashes[np.lexsort((rank, row))]
    return hashes, edges, n, np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0), row


def _prefix(batch, size, percent, late):
    hashes, edges, n, length, row = _ordered(batch, size, percent, late)
    pos = np.arange(len(hashes)) - edges[row]
    run = A.RunHash(hashes)
    group = run(edges[:-1], edges[:-1] + length, n)
    return hashes, edges, n, row, pos, pos < length[row], group


def _signature_mapper(size: int, percent: int, late):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in A.chunks(batches, limit=A.CHUNK_BYTES // 2):
            hashes, edges, n, _, _, inside, group = _prefix(batch, size, percent, late)
            whole = A.RunHash(hashes)(edges[:-1], edges[1:], np.zeros(len(n), np.int64))
            row = np.repeat(np.arange(len(n)), n)
            words = 1 << np.ceil(np.log2(np.maximum(n, SKETCH) / SKETCH)).astype(np.int64)
            lead = np.concatenate(([0], np.cumsum(words)))
            odd = np.bincount(64 * lead[row] + (hashes & (64 * words[row] - 1).astype(np.uint64)).astype(np.int64), minlength=64 * lead[-1]) & 1
            sketch = pa.ListArray.from_arrays(lead.astype(np.int32), pa.array(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)))
            ends = np.concatenate(([0], np.cumsum(inside)))[edges].astype(np.int32)
            prefix = pa.ListArray.from_arrays(ends, pa.array(A.signed(hashes[inside])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("crc"), pa.array(n, pa.int64()), pa.array(A.signed(whole)), pa.array(A.signed(group)), sketch, prefix],
                                             names=["doc_id", "crc", "n", "cls", "grp", "sketch", "prefix"])

    return emit


def _texts(spark: SparkSession, known: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, blob): one text of each class that is in a pair; no other text moves."""
    needed = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    needed = written(spark, needed.join(classes.select("cls", "one.*"), "cls"), "op3-needed")
    picked = known.join(needed, ["doc_id", "crc"]).dropDuplicates(["doc_id", "crc", "cls"])
    return written(spark, R.compressed(picked, "cls").select("cls", "blob"), "op3-texts")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, np.ndarray] | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                left = _sets(part.column("blob_a"), size)
                right = []
                for key, blob in zip(b, part.column("blob_b"), strict=True):
                    if last is None or last[0] != key:
                        last = (key, _sets(pa.array([blob.as_py()], pa.binary()), size)[0])
                    right.append(last[1])
                keep = []
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append((100 + percent) * both >= percent * (len(x) + len(y)))
                if any(keep):
                    yield pa.RecordBatch.from_arrays([pa.array([v for v, k in zip(a, keep, strict=True) if k], pa.int64()),
                                                      pa.array([v for v, k in zip(b, keep, strict=True) if k], pa.int64())], names=["a", "b"])

    blobs = pairs.select("a", "b").join(texts.select(F.col("cls").alias("a"), F.col("blob").alias("blob_a")), "a")
    blobs = blobs.join(texts.select(F.col("cls").alias("b"), F.col("blob").alias("blob_b")), "b")
    return blobs.mapInArrow(emit, "a long, b long")


def _sets(blobs: pa.Array, size: int) -> list[np.ndarray]:
    ones = pa.RecordBatch.from_arrays([blobs], names=["blob"])
    out: list[np.ndarray] = []
    for batch in R.unpacked(iter([ones]), len(blobs)):
        hashes, edges = _shingles(batch, size)
        out += [hashes[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return out
