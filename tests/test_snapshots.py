"""Publication: one switch for all names, leases, crashes between steps, rivals."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from folio.plans import pipeline, snapshots
from folio.plans.snapshots import RUN_TABLES, STABLE_NAMES, Snapshots
from folio.sources import storage

SF = "/root/testdata/sf0.001"
PROBES = ["pub_silver.ratings", "pub_silver.books", "pub_gold.v_kpi_summary"]  # written, replaced and registered at different steps


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="folio-pub-")
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "ckpt")
    pipeline.deliver_fixture(spark, SF, landing, include_lookup=False)
    pipeline.run_pipeline(spark, landing, ckpt, prefix="pub", buckets=2)
    pipeline.deliver_fixture(spark, SF, landing)  # everything once more, and the lookup records: all figures change
    pipeline.run_bronze(spark, landing, ckpt, "pub_bronze")
    return spark


def _state(spark):
    return {p: spark.table(p).agg(F.count(F.lit(1)), F.min(F.struct("*").cast("string")), F.max(F.struct("*").cast("string"))).collect() for p in PROBES}


class Watched:
    """A session whose every changing statement is watched."""

    def __init__(self, spark, watch):
        self._spark, self._watch = spark, watch

    def __getattr__(self, name):
        return getattr(self._spark, name)

    def sql(self, text, *args, **kwargs):
        out = self._spark.sql(text, *args, **kwargs)
        if text.startswith(("CREATE", "DROP", "ALTER")):
            self._watch()
        return out


def test_a_reader_between_any_two_steps_sees_one_run(built):
    spark = built
    old, seen = _state(spark), []
    with Snapshots(spark, "pub_silver").open() as pinned:
        pinned_before = pinned.view("v_kpi_summary").collect()
        real = Snapshots.publish
        try:
            Snapshots.publish = lambda self, *a, **k: real(Snapshots(Watched(spark, lambda: seen.append(_state(spark))), self.db), *a, **k)
            report = pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2)
        finally:
            Snapshots.publish = real
        new = _state(spark)
        assert all(new[p] != old[p] for p in PROBES)
        assert len(seen) > len(STABLE_NAMES) + 6 and all(s in (old, new) for s in seen)
        flips = [s == new for s in seen]
        assert flips == sorted(flips)  # once, for all names together
        assert pinned.view("v_kpi_summary").collect() == pinned_before  # a pinned reader stays with its run
        assert Snapshots(spark, "pub_silver").published() == report.counts["run_id"] != pinned.run_id


def test_guards_leave_no_trace_in_plans(built):
    plan = built.table("pub_gold.v_avg_rating_by_year")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "scalar-subquery" not in plan and plan.count("Relation") == 2


def test_leases_keep_runs(built):
    spark, runs = built, Snapshots(built, "pub_silver")
    first = runs.published()
    tables = lambda run: [spark.catalog.tableExists(f"pub_silver.{t}_{run}") for t in RUN_TABLES]
    with runs.open() as pinned:
        later = [pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2).counts["run_id"] for _ in range(2)]
        assert pinned.run_id == first and all(tables(first)) and pinned.table("books").count() > 0
    pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2)
    assert not any(tables(first)) and not any(tables(later[0])) and all(tables(later[1]))


def test_expired_leases_and_locks_do_not_hold(built):
    spark, runs = built, Snapshots(built, "pub_silver")
    with runs.lease("f" * 16, seconds=-1):
        assert "f" * 16 not in runs.leased()
    storage.put_if_absent(spark, f"{runs.place}/publishing", "1.0")  # left by a publisher that died long ago
    run = pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2).counts["run_id"]
    assert runs.published() == run and storage.read_text(spark, f"{runs.place}/publishing") is None


def test_a_publication_that_dies_leaves_the_old_run_in_force(built, monkeypatch):
    spark, runs = built, Snapshots(built, "pub_silver")
    old, before = runs.published(), _state(spark)

    def dies(self, run_id):
        raise OSError("lost before the switch")

    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "_point", dies)
        with pytest.raises(OSError, match="switch"):
            pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2)
    assert runs.published() == old and _state(spark) == before
    again = pipeline.run_silver(spark, "pub_bronze", "pub_silver", buckets=2).counts["run_id"]
    assert runs.published() == again and _state(spark).keys() == before.keys()


def test_rivals_wait_for_each_other(built, monkeypatch):
    spark, runs = built, Snapshots(built, "pub_silver")
    monkeypatch.setattr(snapshots.time, "sleep", lambda s: None)
    with runs._alone(), pytest.raises(TimeoutError), runs._alone(patience=-1):
        pass
    assert spark.table("pub_silver.books").count() > 0


def test_no_run_yet(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS pub_none")
    with pytest.raises(LookupError), Snapshots(spark, "pub_none").open():
        pass
