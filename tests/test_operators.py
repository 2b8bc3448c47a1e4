"""Operator invariants and semantic traps, checked against brute force on small inputs."""

import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import clean_age, clean_year, normalize_key, parse_location
from folio.operators import analysis, gold, ordering, serving, silver

RATING_SCHEMA = "user_id int, isbn string, rating int, is_explicit boolean"
BOOK_SCHEMA = ("isbn string, title string, author string, year_of_publication int, publisher string, "
               "image_url string, source string")


def _ratings(spark, rows):
    return spark.createDataFrame([(u, i, r, r > 0) for u, i, r in rows], RATING_SCHEMA)


def test_implicit_only_book_has_null_quality(spark):
    ratings = _ratings(spark, [(1, "A", 0), (2, "A", 0), (3, "B", 8)])
    books = spark.createDataFrame([("A", "t1", "x", 1990, "p", "u", "kaggle"),
                                   ("B", "t2", "y", 1991, "p", "u", "kaggle")], BOOK_SCHEMA)
    got = {r.title: r for r in gold.v_books(ratings, books).collect()}
    assert got["t1"].readers_total == 2 and got["t1"].ratings_cnt == 0
    assert got["t1"].avg_rating is None and got["t1"].weighted_rating is None
    assert got["t2"].weighted_rating == 8.0          # C = 8, so the prior pulls nowhere


def test_genre_double_counting_and_distinct_option(spark):
    ratings = _ratings(spark, [(1, "A", 6)])
    books = spark.createDataFrame([("A", "t", "x", 1990, "p", "u", "kaggle")], BOOK_SCHEMA)
    enr = spark.createDataFrame([("A", ["Fiction, general", "Fiction, fantasy", "etc."])],
                                "isbn string, subjects array<string>")
    dup = {r.genre: r.ratings_cnt for r in gold.v_books_by_genre(ratings, books, enr).collect()}
    assert dup == {"Fiction": 2, "Fantasy": 1}
    once = {r.genre: r.ratings_cnt for r in gold.v_books_by_genre(ratings, books, enr, distinct_tokens=True).collect()}
    assert once == {"Fiction": 1, "Fantasy": 1}


def test_dedup_with_hot_key_is_deterministic(spark):
    rows = [("K", f"f{i:05d}", f"t{i}") for i in range(3000)] + [("L", "f1", "x")]
    random.Random(7).shuffle(rows)
    df = spark.createDataFrame(rows, "isbn string, _source_file string, title string").repartition(8)
    got = {r.isbn: (r._source_file, r.title) for r in silver.dedup_first(df, "isbn", ["_source_file"]).collect()}
    assert got == {"K": ("f00000", "t0"), "L": ("f1", "x")}


def test_global_row_number_matches_sort(spark):
    vals = [(random.Random(i).randint(0, 50), f"k{i}") for i in range(2000)]
    df = spark.createDataFrame(vals, "n int, k string").repartition(7)
    numbered = ordering.global_row_number(df, [F.col("n").desc(), F.col("k").asc()])
    got = [(r.n, r.k, r.rn) for r in numbered.orderBy("rn").collect()]
    expected = sorted(vals, key=lambda v: (-v[0], v[1]))
    assert [(n, k) for n, k, _ in got] == expected
    assert [rn for _, _, rn in got] == list(range(1, 2001))


def test_exact_quantiles_match_numpy(spark):
    rng = random.Random(3)
    vals = [float(rng.choice([1, 1, 1, 2, 3, 5, 8, 22, 40])) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    row = analysis.exact_quantiles(df, "v", (0.5, 0.99, 0.25)).collect()[0]
    for tag, p in (("q_p5", 0.5), ("q_p99", 0.99), ("q_p25", 0.25)):
        assert math.isclose(row[tag], round(float(np.quantile(vals, p)), 3), abs_tol=1e-9)


def test_top_user_share_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1] * 50 + list(range(2, 400))), "A", 0) for _ in range(5000)]
    got = analysis.top_user_share(_ratings(spark, rows)).collect()[0]
    counts = {}
    for u, _, _ in rows:
        counts[u] = counts.get(u, 0) + 1
    k = -(-len(counts) // 100)
    top = sum(sorted(counts.values(), reverse=True)[:k])
    assert (got.users, got.top_users, got.top_users_ratings) == (len(counts), k, top)
    assert got.top_share_pct == round(100 * top / 5000, 1)


def test_ratings_split_is_a_partition(spark):
    raw = spark.createDataFrame(
        [("1", " a ", "5"), ("x", "b", "5"), ("2", "  ", "3"), ("3", "c", "11"), ("4", None, "0"),
         ("5", "d", "n/a"), ("6", "e", "0")], "`User-ID` string, ISBN string, `Book-Rating` string"
    ).withColumn("_source_file", F.lit("f")).withColumn("_ingested_at", F.current_timestamp())
    acc = silver.silver_ratings(raw).collect()
    rej = silver.quarantine_ratings(raw).collect()
    assert len(acc) + len(rej) == 7
    assert sorted(r.isbn for r in acc) == ["A", "E"]
    assert {r.reason for r in rej} == {silver.RATINGS_REASON}


def test_display_resort_keeps_rows(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "i int, w double")
    top = serving.ds_top_authors(df.select(F.col("i").cast("string").alias("author"),
                                           F.lit(30).cast("long").alias("ratings_cnt"),
                                           F.col("w").alias("avg_rating"), F.col("w").alias("weighted_rating")))
    shown = serving.for_display(top, "weighted_rating").collect()
    assert sorted(r.author for r in shown) == sorted(r.author for r in top.collect())
    assert [r.weighted_rating for r in shown] == sorted(r.weighted_rating for r in shown)


_TEXT = st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=20)


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.lists(_TEXT, min_size=1, max_size=15))
def test_rule_invariants(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], T.StructType([T.StructField("t", T.StringType())]))
    out = df.select(clean_year("t").alias("y"), clean_age("t").alias("a"), parse_location("t").alias("loc"),
                    normalize_key("t").alias("k"), normalize_key(normalize_key("t")).alias("kk")).collect()
    for r in out:
        assert r.y is None or 1450 <= r.y <= 2004
        assert r.a is None or 5 <= r.a <= 100
        assert r.k == r.kk
        for part in (r.loc.city, r.loc.state, r.loc.country):
            assert part is None or (part != "" and part == part.lower())


def test_priority_union_equals_anti_join_formulation(spark):
    raw = spark.createDataFrame(
        [("0000000011", "t1", "A B", "1990", "p", "u1", "f1"), (" 0000000011 ", "t1b", "A B", "1991", "p", "u2", "f2"),
         ("0000000022", "t2", "C D", "1992", "p", "u3", "f1"), (None, "tn", "E F", "1993", "p", "u4", "f1")],
        "ISBN string, `Book-Title` string, `Book-Author` string, `Year-Of-Publication` string, Publisher string, "
        "`Image-URL-L` string, _source_file string").withColumn("_ingested_at", F.current_timestamp())
    author = "array<struct<name:string,key:string>>"
    lookup = spark.createDataFrame(
        [("0000000011", "orphan", True, "x", "2001", "g1"), ("0000000033", "orphan", True, "y", "2002", "g1"),
         ("0000000033", "orphan", True, "y2", "2003", "g2"), (None, "orphan", True, "z", "2004", "g1"),
         ("0000000044", "catalog", True, "w", "2005", "g1"), ("0000000055", "orphan", False, None, None, "g1")],
        "isbn string, target string, found boolean, title string, publish_date string, _source_file string"
    ).withColumn("authors", F.array(F.struct(F.lit("Q R").alias("name"), F.lit("k").alias("key"))).cast(author)) \
     .withColumn("_ingested_at", F.current_timestamp())
    cols = ["isbn", "title", "author", "year_of_publication", "publisher", "image_url", "_source_file", "source"]
    got = sorted((tuple(r) for r in silver.silver_books(raw, lookup).select(*cols).collect()), key=repr)
    primary = silver.primary_books(raw)
    expected_df = primary.unionByName(silver.recovered_books(lookup, primary)).select(*cols)
    expected = sorted((tuple(r) for r in expected_df.collect()), key=repr)
    assert got == expected
    assert sum(1 for r in got if r[0] is None) == 2           # one NULL key per source
    assert {r[0]: r[-1] for r in got if r[0]}["0000000011"] == "kaggle"


_KEYS = st.sampled_from(["a", "b", "c", None])


@settings(max_examples=15, deadline=None, derandomize=True)
@given(st.lists(st.tuples(_KEYS, st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=60))
def test_dedup_first_equals_sorted_pick(spark, rows):
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(3)
    got = sorted((tuple(r) for r in silver.dedup_first(df, "k", ["o"]).collect()), key=repr)
    best = {}
    for k, o, v in rows:
        if k not in best or (o, v) < best[k]:
            best[k] = (o, v)
    assert got == sorted(((k, o, v) for k, (o, v) in best.items()), key=repr)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=300), st.integers(1, 6))
def test_global_row_number_random(spark, vals, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v int, i int").repartition(parts)
    got = [(r.v, r.i) for r in ordering.global_row_number(df, [F.col("v").asc(), F.col("i").desc()]).orderBy("rn").collect()]
    assert got == sorted(((v, i) for i, v in enumerate(vals)), key=lambda t: (t[0], -t[1]))


@settings(max_examples=10, deadline=None, derandomize=True)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=200))
def test_exact_quantiles_random(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    row = analysis.exact_quantiles(df, "v").collect()[0]
    assert row.groups == len(vals)
    assert math.isclose(row.q_p5, round(float(np.quantile(vals, 0.5)), 3), abs_tol=1e-9)
    assert math.isclose(row.q_p99, round(float(np.quantile(vals, 0.99)), 3), abs_tol=1e-9)


def test_key_detail_lists_each_copy(spark):
    from folio.operators import profiling
    from folio.plans.model import Layers

    raw = Layers(spark, "/root/testdata/sf0.001").raw_books
    dup = profiling.duplicate_keys(raw).first()
    assert profiling.key_detail(raw, dup.ISBN).count() == dup.cnt
