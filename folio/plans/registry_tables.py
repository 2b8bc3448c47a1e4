"""Registered queries, part four: the materialised pipeline itself.

The feeds are delivered as files, ingested, rebuilt into silver tables and published once per session and data folder;
each query then reads the published SQL views and tables, and has the same oracle as its lazy counterpart.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio import oracle as O
from folio.operators import serving
from folio.plans import pipeline, registry
from folio.plans.registry import register
from folio.plans.snapshots import Snapshots
from folio.session import scratch_path

GOLD = ["v_books", "v_authors", "v_books_by_genre", "v_authors_by_year_publisher", "v_avg_rating_by_year", "v_kpi_summary"]
_built: dict[tuple[str, str], tuple[str, dict]] = {}  # (application, data folder) -> prefix and counts of its pipeline


def published(s, d) -> tuple[str, dict]:
    """Prefix and counts of the pipeline over this folder, built at first use."""
    key = (s.sparkContext.applicationId, os.path.abspath(d))
    if key not in _built:
        prefix = "folio_run_" + uuid.uuid4().hex[:12]
        root = scratch_path(s, "pipeline", prefix)
        for layer in ("bronze", "silver", "gold"):
            s.sql(f"CREATE DATABASE {prefix}_{layer} LOCATION '{root}/{layer}'")
        landing = os.path.join(root, "landing")
        pipeline.deliver_fixture(s, d, landing)
        report = pipeline.run_pipeline(s, landing, os.path.join(root, "checkpoints"), prefix=prefix)
        _built[key] = prefix, {**report.counts, "bronze": {r.name: r.rows for r in report.ingested}}
    return _built[key]


def _view(name: str):
    return lambda s, d: s.table(f"{published(s, d)[0]}_gold.{name}")


for _name in GOLD:
    register(f"sql_{_name}", registry.ORACLE[_name])(_view(_name))


def _dataset(name: str):
    return lambda s, d: serving.run_serving_sql(s, name, f"{published(s, d)[0]}_gold")


for _name in ("ds_kpi", "ds_top_books", "ds_popular", "ds_top_authors", "ds_trend", "ds_genres"):
    register(f"{_name}_sql", registry.ORACLE[_name])(_dataset(_name))


def _pinned(s, d) -> DataFrame:
    """The key figures of a pinned run, read through its lease."""
    with Snapshots(s, f"{published(s, d)[0]}_silver").open() as run:
        return run.view("v_kpi_summary")


register("snapshot_kpi", registry.ORACLE["v_kpi_summary"])(_pinned)


def _display(s, d) -> DataFrame:
    """The most popular books of the published view, re-sorted for a bar chart."""
    return serving.for_display(_dataset("ds_popular")(s, d), "readers_total")


register("ds_popular_display", registry.ORACLE["ds_popular"])(_display)


def _silver_counts(s, d) -> DataFrame:
    """Rows of each published table as counted while it was written, as held, and with a processing time."""
    prefix, counts = published(s, d)
    parts = []
    for name, stable in (("ratings_all", ("ratings", "quarantine_ratings")), ("books", ("books",)), ("quarantine_books", ("quarantine_books",)),
                         ("book_enrichment", ("book_enrichment",)), ("users", ("users",))):
        held = [s.table(f"{prefix}_silver.{t}") for t in stable]
        timed = [F.count_if(F.col("_transformed_at").isNotNull()) if "_transformed_at" in h.columns else F.lit(0).cast("bigint") for h in held]
        rows = [h.agg(F.count(F.lit(1)).alias("rows_held"), t.alias("rows_timed")) for h, t in zip(held, timed, strict=True)]
        whole = rows[0]
        for more in rows[1:]:
            whole = whole.unionByName(more)
        parts.append(whole.agg(F.sum("rows_held").alias("rows_held"), F.sum("rows_timed").alias("rows_timed"))
                     .select(F.lit(name).alias("table_name"), F.lit(counts[name]).cast("bigint").alias("rows_counted"), "rows_held", "rows_timed"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_COUNT = "(SELECT CAST(COUNT(*) AS BIGINT) FROM {})"
_ALL_RATINGS = f"{_COUNT.format('s_ratings')} + {_COUNT.format('s_quarantine_ratings')}"
register("published_counts", O.with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {rows} AS rows_counted, {rows} AS rows_held, {timed} AS rows_timed" for name, rows, timed in (
        ("ratings_all", _ALL_RATINGS, _COUNT.format("s_ratings")), ("books", _COUNT.format("s_books"), _COUNT.format("s_books")),
        ("quarantine_books", _COUNT.format("s_quarantine_books"), "CAST(0 AS BIGINT)"),
        ("book_enrichment", _COUNT.format("s_enrichment"), _COUNT.format("s_enrichment")),
        ("users", _COUNT.format("s_users"), _COUNT.format("s_users"))))))(_silver_counts)
