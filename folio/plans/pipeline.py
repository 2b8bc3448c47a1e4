"""The materialised pipeline: landing files -> bronze (streams) -> silver tables -> gold views.

Storage layout decisions for scale
* Ratings are typed and validated in one pass and written once, partitioned by the
  ``_quarantined`` flag; ``ratings`` and ``quarantine_ratings`` are views over the two
  partitions (partition pruning), so the raw feed is scanned once, not twice. Concurrent
  output writers keep that write free of the per-task sort a partitioned write otherwise
  adds (checked in the event log: no Sort under WriteFiles, and no spill in that stage).
* ``rating_stats`` (one row per key: interactions, grades, grade sum) is written next to
  the catalogue, both bucketed and sorted on ``isbn`` with the same bucket count, so the
  join that every gold view starts with is a shuffle-free sort-merge join.
* Row counts come from ``Observation`` on the write itself, not from a second scan.
* Gold views are SQL views over those tables (no stored data), created idempotently with
  column comments; superseded views are dropped.
* Each silver run writes versioned tables; one statement publishes them all
  (``folio.plans.snapshots``), after every write has succeeded.
"""

from __future__ import annotations

import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from folio.functions import DEFAULT_M
from folio.operators import gold, silver
from folio.plans.model import Layers
from folio.plans.snapshots import STABLE_NAMES, Snapshot, Snapshots
from folio.session import scratch_path
from folio.sources import bridge, files, storage
from folio.streaming import ingest

BUCKET_BYTES = 256 << 20
SPLIT_WRITERS = 3  # one more than the values of the split's flag


def choose_buckets(spark: SparkSession, catalogue_table: str, target_bytes: int = BUCKET_BYTES) -> int:
    """Bucket count for the isbn-keyed tables (one count for all of them, so joins co-locate).

    About ``target_bytes`` of catalogue files per bucket, at least one bucket per core; beyond Spark's own limit
    (``spark.sql.sources.bucketing.maxBuckets``) buckets grow instead. The per-key rating summary has one row per
    key, so it is of the same order as the catalogue.
    """
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {catalogue_table}").where("col_name = 'Location'").collect()
    size = storage.folder_bytes(spark, rows[-1].data_type)
    cores = int(spark.conf.get("spark.default.parallelism", None) or spark.sparkContext.defaultParallelism)
    return min(max(cores, -(-size // target_bytes)), int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))


@dataclass
class RunReport:
    counts: dict[str, int] = field(default_factory=dict)
    ingested: list = field(default_factory=list)


def deliver_fixture(spark: SparkSession, sf_dir: str, landing: str, include_lookup: bool = True) -> None:
    """Write the bridged raw feeds as landing files (CSV feeds and, optionally, the
    JSON-lines lookup records of an earlier enrichment)."""
    for feed, fn in (("books", bridge.raw_books), ("ratings", bridge.raw_ratings), ("users", bridge.raw_users)):
        files.write_csv_feed(fn(spark, sf_dir), feed, os.path.join(landing, feed))
    if include_lookup:
        files.write_json_feed(bridge.raw_lookup_records(spark, sf_dir), os.path.join(landing, "open_library"))


def run_bronze(spark: SparkSession, landing: str, checkpoints: str, db: str, flat: bool = False) -> list:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    tables = {f: f"{db}.{f}" for f in ("books", "ratings", "users", "open_library")}
    return ingest.ingest_all(spark, landing, checkpoints, tables=tables, flat=flat)


def _write(df: DataFrame, table: str, report: RunReport, name: str, partition_by=None, bucket_by=None,
           buckets: int = 1, empty: bool = False) -> None:
    """Overwrite ``table``; the row count comes from an Observation on the write itself.
    ``empty`` marks a known-empty frame (the optimizer drops its metrics node).

    A bucketed frame is an aggregate by its bucket column, in a session with as many shuffle partitions as
    buckets (``_bucket_session``): the aggregate's exchange deals rows by the very hash of the bucket id, so each bucket lies whole in one
    task and becomes one file, without a second exchange."""
    obs = None if empty else Observation(name)
    observed = df if empty else df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)
    report.counts[name] = 0 if empty else int(obs.get.get("rows", 0))


def _bucket_session(spark: SparkSession, buckets: int) -> SparkSession:
    """A session like this one whose shuffles have ``buckets`` partitions."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    other.conf.set("spark.sql.shuffle.partitions", str(buckets))
    other.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(buckets))
    return other


def run_silver(spark: SparkSession, bronze_db: str, silver_db: str, buckets: int | None = None,
               report: RunReport | None = None, gold_db: str | None = None, m: int = DEFAULT_M) -> RunReport:
    """Full rebuild of silver from bronze (bronze is never modified).

    Every run writes a new version of each table (``<name>_<run id>``). Only after all writes have succeeded is the run
    published (``folio.plans.snapshots``): one catalogue statement switches every stable name, silver and gold, so readers
    see one complete run at any time, even if a rebuild fails half way.
    """
    report = report or RunReport()
    if buckets is None:
        buckets = choose_buckets(spark, f"{bronze_db}.books")
    report.counts["buckets"] = buckets
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {silver_db}")
    snapshots = Snapshots(spark, silver_db)
    # Time-ordered run id (milliseconds, hex) plus a random suffix: versions sort by age.
    run_id = f"{time.time_ns() // 1_000_000:012x}{uuid.uuid4().hex[:4]}"
    with snapshots.lease(run_id):  # a publication that ends meanwhile leaves this run's tables alone
        _write_run(spark, bronze_db, silver_db, run_id, buckets, report)
        snapshots.publish(run_id, gold_db, m)
    report.counts["run_id"] = run_id
    return report


def _write_run(spark: SparkSession, bronze_db: str, silver_db: str, run_id: str, buckets: int, report: RunReport) -> None:
    t = lambda name: f"{silver_db}.{name}_{run_id}"  # noqa: E731 - versioned physical table
    has_lookup = spark.catalog.tableExists(f"{bronze_db}.open_library")
    lookup = spark.table(f"{bronze_db}.open_library") if has_lookup else None
    raw_books = spark.table(f"{bronze_db}.books")
    raw_ratings = spark.table(f"{bronze_db}.ratings")
    by_bucket = _bucket_session(spark, buckets)
    keyed = lambda name: by_bucket.table(f"{bronze_db}.{name}")
    keyed_lookup = keyed("open_library") if has_lookup else None

    # The key summary reads the same three bronze columns the split reads, so computing it
    # from bronze in parallel costs the same scan as re-reading silver, without waiting.
    # Independent outputs are separate Spark jobs submitted from parallel threads, so small
    # tables do not wait behind the ratings write and the executors stay busy.
    jobs = [
        lambda: _write(silver.ratings_split(raw_ratings), t("ratings_all"), report, "ratings_all",
                       partition_by="_quarantined"),
        lambda: _write(gold.rating_stats(silver.silver_ratings(keyed("ratings"))), t("rating_stats"), report,
                       "rating_stats", bucket_by="isbn", buckets=buckets),
        lambda: _write(silver.quarantine_books(raw_books), t("quarantine_books"), report, "quarantine_books"),
        lambda: _write(silver.silver_books(keyed("books"), keyed_lookup), t("books"), report, "books",
                       bucket_by="isbn", buckets=buckets),
        lambda: _write(silver.silver_enrichment(keyed_lookup), t("book_enrichment"), report, "book_enrichment",
                       bucket_by="isbn", buckets=buckets, empty=lookup is None),
        lambda: _write(silver.silver_users(spark.table(f"{bronze_db}.users")), t("users"), report, "users"),
    ]
    # The split write has two partition values; with concurrent output writers each task
    # writes both files directly instead of first sorting all its rows by the flag. A task turns
    # to sorting what is left of its rows, and spills them, as soon as that many writers are open.
    key = "spark.sql.maxConcurrentOutputFileWriters"
    previous = spark.conf.get(key, "0")
    if int(previous) < SPLIT_WRITERS:
        spark.conf.set(key, str(SPLIT_WRITERS))
    try:
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            for fut in [pool.submit(j) for j in jobs]:
                fut.result()
    finally:
        spark.conf.set(key, previous)
    # The views' population means, once per rebuild from this run's tables (one row), so
    # view queries read C instead of joining the key summary with the catalogue again.
    _write(gold.priors(spark.table(t("rating_stats")), spark.table(t("books"))), t("priors"), report, "priors")


def silver_layers(spark: SparkSession, silver_db: str, m: int = DEFAULT_M, snapshot: Snapshot | None = None) -> Layers:
    """Gold/serving DataFrames over the materialised silver tables: the published run, or a pinned one."""
    table = snapshot.table if snapshot else lambda n: spark.table(f"{silver_db}.{n}")
    return Layers.from_tables(spark, {n: table(n) for n in STABLE_NAMES}, m=m)


def register_views(spark: SparkSession, silver_db: str, gold_db: str, m: int = DEFAULT_M) -> list[str]:
    """Idempotent gold DDL over the published run: namespace, drop superseded views, create or replace each view."""
    return Snapshots(spark, silver_db).register_gold(gold_db, m)


def enrichment_feedback(spark: SparkSession, landing: str, answers: DataFrame, checkpoints: str,
                        prefix: str = "books", m: int = DEFAULT_M, buckets: int | None = None):
    """The enrichment loop closed: one lookup round from the current bronze feeds, written
    into the lookup landing folder, then the pipeline again (the streams pick up only the
    new round; silver and gold are rebuilt). Returns (coverage rows, run report)."""
    from folio.operators import enrichment

    bronze_db = f"{prefix}_bronze"
    coverage = enrichment.run_round(spark, spark.table(f"{bronze_db}.ratings"), spark.table(f"{bronze_db}.books"),
                                    answers, os.path.join(landing, "open_library")).collect()
    return coverage, run_pipeline(spark, landing, checkpoints, prefix=prefix, m=m, buckets=buckets)


def run_pipeline(spark: SparkSession, landing: str, checkpoints: str | None = None, prefix: str = "books",
                 m: int = DEFAULT_M, buckets: int | None = None, flat: bool = False) -> RunReport:
    """Bronze -> silver -> gold, each stage reading only what the previous one wrote."""
    checkpoints = checkpoints or scratch_path(spark, "checkpoints", unique=False)
    bronze_db, silver_db, gold_db = f"{prefix}_bronze", f"{prefix}_silver", f"{prefix}_gold"
    report = RunReport()
    report.ingested = run_bronze(spark, landing, checkpoints, bronze_db, flat)
    run_silver(spark, bronze_db, silver_db, buckets=buckets, report=report, gold_db=gold_db, m=m)
    return report
