"""End-to-end: landing files -> availableNow streams -> silver tables -> gold SQL views.

The SQL views over the materialised tables must equal the DataFrame builders run lazily
over the bridge, and a second run without new files must ingest nothing.
"""

import os
import re
import tempfile

import pytest

from folio.plans import pipeline
from folio.plans.model import Layers

SF = "/root/testdata/sf0.001"
VIEWS = ["v_books", "v_authors", "v_books_by_genre", "v_authors_by_year_publisher", "v_avg_rating_by_year",
         "v_kpi_summary"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="folio-pipe-")
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "ckpt")
    pipeline.deliver_fixture(spark, SF, landing)
    report = pipeline.run_pipeline(spark, landing, ckpt, prefix="t1", buckets=4)
    return spark, landing, ckpt, report


def test_counts_and_exactly_once(built):
    spark, landing, ckpt, report = built
    lay = Layers(spark, SF)
    assert report.counts["ratings_all"] == lay.raw_ratings.count()
    assert report.counts["books"] == lay.books.count()
    assert report.counts["quarantine_books"] == lay.quarantine_books.count()
    assert report.counts["users"] == lay.users.count()
    assert {r.name: r.rows for r in report.ingested}["ratings"] == lay.raw_ratings.count()
    again = pipeline.run_bronze(spark, landing, ckpt, "t1_bronze")
    assert all(r.rows == 0 for r in again)


def test_split_write_never_turns_to_sorting(built, monkeypatch):
    """Spark sorts what is left of a task's rows once as many writers are open as it may have: there must be room for one more than the flag's values."""
    spark, write, seen = built[0], pipeline._write, {}

    def recorded(df, table, report, name, **more):
        if more.get("partition_by"):
            seen[name] = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        write(df, table, report, name, **more)

    monkeypatch.setattr(pipeline, "_write", recorded)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0")
    pipeline.run_silver(spark, "t1_bronze", "t1w_silver", buckets=2)
    flags = spark.table("t1w_silver.ratings").count() > 0, spark.table("t1w_silver.quarantine_ratings").count() > 0
    assert flags == (True, True) and seen["ratings_all"] > 2
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == before


def test_split_partitions_input(built):
    spark = built[0]
    lay = Layers(spark, SF)
    acc = spark.table("t1_silver.ratings").count()
    rej = spark.table("t1_silver.quarantine_ratings").count()
    assert acc + rej == lay.raw_ratings.count()
    assert acc == lay.ratings.count() and rej == lay.quarantine_ratings.count()


def test_catalogue_keys_unique(built):
    spark = built[0]
    books = spark.table("t1_silver.books")
    assert books.count() == books.select("isbn").distinct().count()


@pytest.mark.parametrize("view", VIEWS)
def test_sql_view_matches_dataframe(built, view):
    spark = built[0]
    lay = Layers(spark, SF)
    expected = getattr(lay, view)()
    got = spark.table(f"t1_gold.{view}").select(*expected.columns)
    assert _rows(got) == _rows(expected)


def test_views_over_tables_match_bridge(built):
    spark = built[0]
    from_tables = pipeline.silver_layers(spark, "t1_silver")
    lay = Layers(spark, SF)
    for name in ("ds_top_books", "ds_kpi", "ds_genres"):
        assert _rows(from_tables.dataset(name)) == _rows(lay.dataset(name))


def test_serving_sql_with_parameters(built):
    from folio.operators.serving import run_serving_sql

    spark = built[0]
    lay = Layers(spark, SF)
    got = run_serving_sql(spark, "ds_top_by_period", "t1_gold", year_min=1980, year_max=2004)
    assert _rows(got) == _rows(lay.dataset("ds_top_by_period", year_min=1980, year_max=2004))
    got = run_serving_sql(spark, "ds_top_by_genre", "t1_gold")
    assert _rows(got) == _rows(lay.dataset("ds_top_by_genre"))


def test_view_comments_present(built):
    spark = built[0]
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE t1_gold.v_books").collect()}
    assert "shrunk" in desc["weighted_rating"] and all(desc[c] for c in ("title", "readers_total", "image_url"))
    spark.sql("CREATE OR REPLACE VIEW t1_gold.v_top_books TBLPROPERTIES ('folio.gold_view' = 'v_top_books') AS SELECT 1 AS x")
    spark.sql("CREATE OR REPLACE VIEW t1_gold.own_view AS SELECT 1 AS x")
    pipeline.register_views(spark, "t1_silver", "t1_gold")
    assert not spark.catalog.tableExists("t1_gold.v_top_books")   # an earlier view of this library
    assert spark.catalog.tableExists("t1_gold.own_view")          # somebody else's


def test_enrichment_round_is_resumable(spark):
    from folio.operators import enrichment
    from folio.sources import bridge

    lay = Layers(spark, SF)
    out = os.path.join(tempfile.mkdtemp(prefix="folio-enr-"), "lookup")
    answers = bridge.lookup_answers(spark, SF)
    first = {r.target: (r.keys_total, r.keys_found) for r in
             enrichment.run_round(spark, lay.raw_ratings, lay.raw_books, answers, out).collect()}
    targets = enrichment.target_keys(lay.raw_ratings, lay.raw_books)
    assert sum(t for t, _ in first.values()) == targets.count()
    written = spark.read.option("recursiveFileLookup", "true").json(out)
    assert written.count() == targets.count()
    assert written.select("isbn").distinct().count() == targets.count()
    second = enrichment.run_round(spark, lay.raw_ratings, lay.raw_books, answers, out).collect()
    assert spark.read.option("recursiveFileLookup", "true").json(out).count() == targets.count()
    assert second == []


def test_bucket_count_follows_data_size(spark, built):
    report = built[3]
    assert report.counts["buckets"] == 4          # explicit in the fixture
    n = pipeline.choose_buckets(spark, "t1_bronze.books")
    assert n == spark.sparkContext.defaultParallelism   # tiny input: one bucket per core
    assert pipeline.choose_buckets(spark, "t1_bronze.books", target_bytes=1000) > n


def test_kpi_conservation(spark, built):
    """Ratings on primary books + recovered + orphaned = all interactions (tables and lazy path)."""
    for lay in (pipeline.silver_layers(spark, "t1_silver"), Layers(spark, SF)):
        kpi = lay.v_kpi_summary().collect()[0]
        primary_matches = (lay.ratings.join(lay.books.where("source = 'kaggle'").select("isbn"), "isbn").count())
        assert primary_matches + kpi.ratings_recovered + kpi.ratings_orphaned == kpi.interactions_total
        recovered_keys = lay.books.where("source = 'open_library'").select("isbn")
        assert recovered_keys.join(lay.books.where("source = 'kaggle'"), "isbn").count() == 0


def test_enrichment_feedback_loop_recovers_orphans(spark):
    from folio.sources import bridge

    root = tempfile.mkdtemp(prefix="folio-loop-")
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "ckpt")
    pipeline.deliver_fixture(spark, SF, landing, include_lookup=False)
    pipeline.run_pipeline(spark, landing, ckpt, prefix="loop", buckets=4)
    before = spark.table("loop_gold.v_kpi_summary").collect()[0]
    assert before.books_recovered == 0
    coverage, report = pipeline.enrichment_feedback(spark, landing, bridge.lookup_answers(spark, SF), ckpt,
                                                    prefix="loop", buckets=4)
    assert {r.target for r in coverage} == {"orphan", "catalog"}
    assert {r.name: r.rows for r in report.ingested}["open_library"] == sum(r.keys_total for r in coverage)
    after = spark.table("loop_gold.v_kpi_summary").collect()[0]
    assert after.books_recovered > 0 and after.ratings_recovered > 0
    assert after.ratings_orphaned == before.ratings_orphaned - after.ratings_recovered
    assert after.interactions_total == before.interactions_total


def test_failed_rebuild_keeps_previous_snapshot(spark, built, monkeypatch):
    from folio.operators import silver as silver_ops

    before_books = spark.table("t1_silver.books").count()
    before_kpi = spark.table("t1_gold.v_kpi_summary").collect()[0]
    view_sql = lambda: spark.sql("SHOW CREATE TABLE t1_silver.books").collect()[0][0]
    published = view_sql()

    def boom(*_a, **_k):
        raise RuntimeError("simulated failure half way through the rebuild")

    monkeypatch.setattr(silver_ops, "silver_users", boom)
    with pytest.raises(RuntimeError):
        pipeline.run_silver(spark, "t1_bronze", "t1_silver", buckets=4)
    monkeypatch.undo()
    assert view_sql() == published                        # stable names still point at the old run
    assert spark.table("t1_silver.books").count() == before_books
    assert spark.table("t1_gold.v_kpi_summary").collect()[0] == before_kpi

    published = re.search(r"books_([0-9a-f]{16})", view_sql()).group(1)
    runs = [pipeline.run_silver(spark, "t1_bronze", "t1_silver", buckets=4).counts["run_id"] for _ in range(2)]
    assert runs[-1] in view_sql()
    tables = [t.name for t in spark.catalog.listTables("t1_silver") if t.tableType != "VIEW"]
    books_versions = sorted(t for t in tables if t.startswith("books_"))
    # current + the previously published one; older versions and the failed run's leftovers are gone
    assert books_versions == sorted(f"books_{r}" for r in runs)
    assert f"books_{published}" not in books_versions
