"""Distributed quantiles and lazy numbering against plain definitions; one scan, one exchange, one step per rule in the plans."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import analysis, enrichment, ordering, profiling, silver
from folio.plans import pipeline
from folio.plans.model import Layers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, values", [
    ("distinct", lambda r: [r.random() * 10 ** r.randrange(-200, 200) * r.choice([1, -1]) for _ in range(3000)]),
    ("crowded", lambda r: [1.0] * 1500 + [2.0] * 1500),
    ("two and some", lambda r: [1.0] * 700 + [r.random() for _ in range(900)] + [5.0] * 800),
    ("one", lambda r: [3.5]), ("same", lambda r: [7.0] * 40), ("nulls", lambda r: [None, 4.0, None, 9.0, 1.0])])
def test_quantiles_of_any_column(spark, name, values):
    rows = values(random.Random(1))
    df = spark.createDataFrame([(v,) for v in rows], "`my value` double").repartition(5)
    probs = (0.5, 0.99, 0.25)
    for accuracy, enough in ((10_000, 50_000), (50, 20), (10, 1)):
        row = analysis.exact_quantiles(df, "my value", probs, accuracy, enough).collect()[0]
        known = [v for v in rows if v is not None]
        assert row.groups == len(known)
        for p, got in zip(probs, row[1:], strict=True):
            want = float(np.quantile(known, p))
            assert got == pytest.approx(want, rel=1e-9, abs=5.1e-4), (accuracy, enough, p)


def test_quantiles_of_nothing(spark):
    assert list(analysis.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v").collect()[0]) == [0, None, None]


def test_support_quantiles_join_the_ratings_once(spark, monkeypatch):
    plans = []
    first = type(spark.range(1)).first
    monkeypatch.setattr(type(spark.range(1)), "first", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), first(self))[1])
    row = analysis.support_quantiles(Layers(spark, SF).v_books()).collect()[0]
    assert plans and not any("Join" in p or "parquet" in p for p in plans)
    counts = [r.ratings_cnt for r in Layers(spark, SF).v_books().where("ratings_cnt > 0").select("ratings_cnt").collect()]
    assert list(row) == pytest.approx([len(counts), np.quantile(counts, 0.5), np.quantile(counts, 0.99)], abs=5.1e-4)


def test_quantiles_take_few_passes_and_no_global_window(spark, monkeypatch):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    passes = []
    first = type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: (passes.append(self._jdf.queryExecution().executedPlan().toString()), first(self))[1])
    row = analysis.exact_quantiles(df, "v", enough=2000).collect()[0]
    assert row.q_p5 == pytest.approx(float(np.quantile([i * 7919 % 200_003 for i in range(200_000)], 0.5)))
    assert len(passes) <= 1 + 2 * math.ceil(math.log(200_000 / 2000, 2500)) and not any("Window" in p for p in passes)


def test_radix_numbers_are_the_sorted_places(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(4), "".join(rng.choice("01X") for _ in range(rng.randrange(0, 11)))) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, k string").repartition(6)
    for widths in ((4, 3), (1,), (2, 2, 2, 2)):
        got = [(r.g, r.k) for r in ordering.radix_row_number(df, F.col("g"), "k", widths).orderBy("rn").collect()]
        assert got == sorted(rows)
        assert [r.rn for r in ordering.radix_row_number(df, F.col("g"), "k", widths).select("rn").orderBy("rn").collect()] == list(range(1, 3001))


def test_building_the_batches_starts_no_job(spark):
    sc, lay = spark.sparkContext, Layers(spark, SF)
    ratings, books = lay.raw_ratings, lay.raw_books  # opening Parquet files reads their schema by a job
    sc.setJobGroup("lazy", "building")
    try:
        batches = enrichment.request_batches(enrichment.target_keys(ratings, books))
        assert not sc.statusTracker().getJobIdsForGroup("lazy")
        assert batches.count() > 0
        assert sc.statusTracker().getJobIdsForGroup("lazy")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_batch_answers_that_cannot_be_read_are_refused(spark):
    requests = spark.createDataFrame([("A", "orphan")], "isbn string, target string")
    answers = spark.createDataFrame([('{"ISBN:A": {"ti',)], "body string")
    with pytest.raises(Exception, match="can't be read"):
        enrichment.answered_requests(requests, answers).collect()
    whole = spark.createDataFrame([('{"ISBN:A": {"title": "t"}}',)], "body string")
    assert enrichment.answered_requests(requests, whole).count() == 1


# ------------------------------------------------------------ plans
def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_step_of_a_rule_stands_once(spark):
    lay = Layers(spark, SF)
    raw = lay.raw_users.select("*")
    users = _optimized(silver.silver_users(raw))
    assert (users.count("split("), users.count("regexp_replace(")) == (1, 3)
    books = spark.createDataFrame([], lay.raw_books.schema)
    plan = _optimized(silver.silver_books(spark.read.schema(books.schema).parquet(f"{SF}/part.parquet")))
    assert plan.count("encode(") == 2 * 3  # twice for each of title, author and publisher


def test_key_figures_read_no_texts_of_the_catalogue(spark):
    plan = _optimized(Layers(spark, SF).v_kpi_summary())
    assert "encode(" not in plan and "regexp_replace(" not in plan


def _final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _scans_run(plan: str, table: str) -> int:
    return sum(1 for ln in plan.splitlines() if "FileScan" in ln and f"{table}.parquet" in ln)


def test_share_of_total_takes_one_scan(spark):
    df = profiling.rating_distribution(Layers(spark, SF).raw_ratings)
    plan = _final(df)
    assert "Reused" in plan


@pytest.fixture(scope="module")
def written(spark):
    import os
    import tempfile

    root = tempfile.mkdtemp(prefix="folio-sel-")
    landing = os.path.join(root, "landing")
    pipeline.deliver_fixture(spark, SF, landing)
    pipeline.run_bronze(spark, landing, os.path.join(root, "ckpt"), "sel_bronze")
    return spark


def test_bucketed_frames_have_one_exchange(written):
    from folio.operators import gold

    other = pipeline._bucket_session(written, 5)
    raw, ratings, lookup = (other.table(f"sel_bronze.{t}") for t in ("books", "ratings", "open_library"))
    for df in (silver.silver_books(raw, lookup), gold.rating_stats(silver.silver_ratings(ratings)), silver.silver_enrichment(lookup)):
        plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        assert re.findall(r"Exchange (\w+)\((\w+)#\d+, (\d+)\)", plan) == [("hashpartitioning", "isbn", "5")]


def test_each_bucket_is_one_sorted_file(written):
    import os

    report = pipeline.run_silver(written, "sel_bronze", "sel_silver", buckets=5)
    for name in ("books", "rating_stats", "book_enrichment"):
        rows = written.sql(f"DESCRIBE TABLE EXTENDED sel_silver.{name}_{report.counts['run_id']}").where("col_name = 'Location'").collect()
        folder = rows[-1].data_type.removeprefix("file:")
        buckets = [m[1] for n in os.listdir(folder) if (m := re.search(r"_(\d{5})\.c\d+", n)) and not n.startswith(".")]
        assert len(buckets) == len(set(buckets)) > 1
