"""Physical-plan properties that matter at scale, asserted on the executed plans."""

import os
import re
import tempfile

import pytest

from folio.operators import gold, silver
from folio.plans import pipeline, registry, registry_more, registry_stream, registry_tables  # noqa: F401 - the last three register queries
from folio.plans.model import Layers

SF = "/root/testdata/sf0.001"
# Ingestion queries write files first; their plans are file scans of what they wrote.
SKIP = {"ingest_csv_stream", "ingest_csv_ratings", "ingest_csv_users", "ingest_json_stream", "ingest_incremental",
        "rescue_malformed", "ingest_json_evolved", "ingest_json_drift", "ingest_csv_layouts", "ingest_many_batches", "bronze_lineage",
        "ingest_flat_globs", "ingest_replay"}


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SKIP))
def test_no_python_udf_in_any_query(spark, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|PythonUDF|InPandas|InArrow|PythonMapInArrow|FlatMapGroups|FlatMapCoGroups", plan)


def test_ratings_summary_aggregates_before_the_shuffle(spark):
    df = gold.rating_stats(Layers(spark, SF).ratings)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partial aggregate sits below the exchange on isbn: hot keys are combined map-side
    assert re.search(r"partial_count.*\n(.*\n)*?.*Exchange hashpartitioning\(isbn", plan) or \
        plan.index("partial_count") > plan.index("Exchange hashpartitioning(isbn")


def test_lookup_filters_pushed_and_columns_pruned(spark):
    lay = Layers(spark, SF)
    df = silver.recovered_books(lay.raw_lookup, silver.primary_books(lay.raw_books))
    plan = _plan(df)
    pushed = [ln for ln in plan.splitlines() if "part.parquet" in ln and re.search(r"PushedFilters: \[[^\]]*IsNotNull", ln)]
    assert pushed
    part_scans = [ln for ln in plan.splitlines() if "part.parquet" in ln and "ReadSchema" in ln]
    assert part_scans and all("p_retailprice" not in ln for ln in part_scans)


def test_top_k_is_take_ordered(spark):
    df = Layers(spark, SF).dataset("ds_top_books")
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="folio-plan-")
    landing = os.path.join(root, "landing")
    pipeline.deliver_fixture(spark, SF, landing)
    pipeline.run_pipeline(spark, landing, os.path.join(root, "ckpt"), prefix="tp", buckets=4)
    return "tp"


def test_bucketed_view_join_has_no_exchange_below_join(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.table(f"{tables}_gold.v_avg_rating_by_year")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    lines = final.splitlines()
    at = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    indent = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    subtree = []
    for ln in lines[at + 1:]:
        if len(ln) - len(ln.lstrip(" :+-")) <= indent:
            break
        subtree.append(ln)
    assert subtree and not any("Exchange" in ln for ln in subtree), "\n".join(subtree)
    assert sum("Bucketed: true" in ln for ln in subtree) == 2
    # one sorted file per bucket: the scans report their order, so no Sort before the join
    assert not any("Sort [isbn" in ln for ln in subtree), "\n".join(subtree)


def test_ratings_views_prune_the_split_partition(spark, tables):
    df = spark.table(f"{tables}_silver.quarantine_ratings")
    plan = _plan(df)
    assert "PartitionFilters: [isnotnull(_quarantined" in plan
