"""Hot-key experiment: one key carries a third of all ratings.

Runs the gold ``v_books`` computation two ways over the same skewed ratings (derived from
the driver tables: every rating whose hash falls in one third is moved onto one key):

* ``pre-aggregated`` -- folio's plan: per-key summary (map-side partial aggregate), then
  the join with the catalogue, then the (title, author) aggregate;
* ``join-then-group`` -- the straightforward plan: ratings joined to the catalogue, then
  grouped.

Automatic broadcast is off, so the join is a sort-merge join as it would be with a large
catalogue. From the event log it reports, per plan, the largest number of shuffle records
any single task read, and the total. Writes docs/SKEW.md.

Usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from folio.operators import gold  # noqa: E402
from folio.plans.model import Layers  # noqa: E402
from folio.session import build_session  # noqa: E402


def _events(events_dir: str, app: str) -> list[dict]:
    import zstandard

    out = []
    for path in glob.glob(os.path.join(events_dir, "**"), recursive=True):
        if app not in path or "events_" not in path:
            continue
        with open(path, "rb") as fh:
            raw = fh.read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode() \
            if path.endswith(".zstd") else raw.decode()
        out += [json.loads(line) for line in io.StringIO(text) if line.strip()]
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="folio-skew-")
    events = os.path.join(scratch, "events")
    os.makedirs(events)
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": events,
        "spark.checkpoint.dir": os.path.join(scratch, "ck"),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "false",
        # keep all 16 reducers, so the per-task maximum shows skew rather than coalescing
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    lay = Layers(spark, sf)
    hot = F.when(F.pmod(F.xxhash64("user_id", "isbn", "rating"), F.lit(3)) == 0, F.lit("0000000011"))
    # Materialise the inputs first, so each measured plan contains only its own shuffles.
    spark.sparkContext.setJobGroup("setup", "setup")
    lay.ratings.withColumn("isbn", F.coalesce(hot, F.col("isbn"))).select("user_id", "isbn", "rating", "is_explicit") \
        .write.parquet(os.path.join(scratch, "ratings"))
    lay.books.drop("_ingested_at", "_transformed_at").write.parquet(os.path.join(scratch, "books"))
    ratings = spark.read.parquet(os.path.join(scratch, "ratings"))
    books = spark.read.parquet(os.path.join(scratch, "books"))

    runs = {}
    spark.sparkContext.setJobGroup("pre-aggregated", "pre-aggregated")
    gold.v_books(ratings, books).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("join-then-group", "join-then-group")
    naive = (ratings.join(books.select("isbn", "title", "author"), "isbn")
             .groupBy("title", "author").agg(F.count(F.lit(1)).alias("readers_total"),
                                             F.count_if("is_explicit").alias("ratings_cnt")))
    naive.write.format("noop").mode("overwrite").save()

    # De-duplication with a hot group of copies: the ratings rows act as copies keyed by isbn.
    from pyspark.sql import Window

    from folio.operators.silver import dedup_first

    copies = ratings.withColumn("_source_file", F.col("user_id").cast("string"))
    spark.sparkContext.setJobGroup("dedup: grouped min over a struct", "dedup-agg")
    dedup_first(copies, "isbn", ["_source_file"]).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("dedup: row_number window", "dedup-window")
    w = Window.partitionBy("isbn").orderBy("_source_file", "rating", "user_id")
    copies.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").write.format("noop").mode("overwrite").save()
    hot_rows = ratings.where(F.col("isbn") == "0000000011").count()
    total_rows = ratings.count()
    app = spark.sparkContext.applicationId
    spark.stop()

    group_of_job, group_of_stage = {}, {}
    for ev in _events(events, app):
        kind = ev.get("Event", "")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            for st in ev.get("Stage IDs", []):
                group_of_stage[st] = group
        if kind == "SparkListenerTaskEnd":
            group = group_of_stage.get(ev.get("Stage ID"))
            metrics = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            recs = metrics.get("Total Records Read", 0)
            if group and recs:
                stats = runs.setdefault(group, {"max": 0, "total": 0})
                stats["max"] = max(stats["max"], recs)
                stats["total"] += recs
                per_stage = stats.setdefault("stages", {}).setdefault(ev.get("Stage ID"), [0, 0, 0])
                per_stage[0] = max(per_stage[0], recs)
                per_stage[1] += recs
                per_stage[2] += 1
    lines = ["# Hot-key experiment", "",
             f"Generated by `scripts/skew_check.py` on `{os.path.basename(sf)}`: {total_rows} accepted ratings, "
             f"{hot_rows} of them ({100 * hot_rows / total_rows:.1f} %) moved onto one key, written to parquet first. "
             "Automatic broadcast, AQE skew splitting and partition coalescing are off, so the joins are plain "
             "sort-merge joins over 16 reducers; a balanced reducer would read about 1/16 of a stage's records.", "",
             "| plan | largest shuffle read by one task (records) | all shuffle records read |", "|---|---|---|"]
    for name in ("pre-aggregated", "join-then-group", "dedup: grouped min over a struct",
                 "dedup: row_number window"):
        st = runs.get(name, {"max": 0, "total": 0})
        lines.append(f"| {name} | {st['max']} | {st['total']} |")
    lines += ["", "With the per-key summary, the hot key arrives at its reducer as one partial row per map task. "
              "Joining first sends every rating of the hot key to a single task. For de-duplication both forms "
              "stay balanced: the grouped min keeps one partial row per key and map task, and Spark rewrites a "
              "`row_number() = 1` filter into a partial WindowGroupLimit below the shuffle, which does the same. "
              "folio uses the aggregate, which does not depend on that rewrite and orders by every column.", ""]
    if os.environ.get("SKEW_DEBUG"):
        for name, st in runs.items():
            print(name, {k: v for k, v in st.get("stages", {}).items()})
    path = os.path.join(ROOT, "docs", "SKEW.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    print("\n".join(lines))


if __name__ == "__main__":
    main()
