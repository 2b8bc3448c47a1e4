"""Registered queries, part three: landing files, streaming ingestion, rescue, run summary.

Each ingestion query delivers the bridged feed as files into a fresh folder under the
shared checkpoint folder, runs the ``availableNow`` stream(s) into a parquet sink and
returns the sink's business columns (file paths and times are run-specific).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio import oracle as O
from folio.plans.registry import layers, register
from folio.session import scratch_path
from folio.sources import files
from folio.streaming import ingest

_RUNTIME_COLS = ("_source_file", "_ingested_at", "_batch")


def _feed(s, d, feed: str) -> DataFrame:
    lay = layers(s, d)
    return {"books": lay.raw_books, "ratings": lay.raw_ratings, "users": lay.raw_users}[feed]


def ingest_csv_feed(s, d, feed: str) -> DataFrame:
    root = scratch_path(s, "ingest", feed)
    landing = os.path.join(root, "landing")
    files.write_csv_feed(_feed(s, d, feed), feed, os.path.join(landing, feed))
    out = os.path.join(root, "bronze", feed)
    ingest.ingest_csv(s, landing, feed, os.path.join(root, "_checkpoints"), path=out)
    return s.read.parquet(out).drop(*_RUNTIME_COLS)


_CSV_SQL = {feed: "SELECT " + ", ".join(f'"{c}"' for c in cols) + ", _rescued_data FROM b_" + feed
            for feed, cols in files.CSV_COLUMNS.items()}

register("ingest_csv_stream", O.with_ctes(_CSV_SQL["books"]))(lambda s, d: ingest_csv_feed(s, d, "books"))
register("ingest_csv_ratings", O.with_ctes(_CSV_SQL["ratings"]))(lambda s, d: ingest_csv_feed(s, d, "ratings"))
register("ingest_csv_users", O.with_ctes(_CSV_SQL["users"]))(lambda s, d: ingest_csv_feed(s, d, "users"))


def _flat_lookup(df: DataFrame, *more: str) -> DataFrame:
    authors = F.array_join(F.transform("authors", lambda a: F.concat(
        F.coalesce(a.getField("name"), F.lit("")), F.lit("|"), F.coalesce(a.getField("key"), F.lit("")))), ";")
    return df.select("isbn", "target", "found", "title", authors.alias("authors"),
                     F.array_join("subjects", "|").alias("subjects"), "number_of_pages", "publish_date",
                     files.RESCUE, *more)


def _ingest_json(s, d) -> DataFrame:
    root = scratch_path(s, "ingest", "open_library")
    landing = os.path.join(root, "landing")
    files.write_json_feed(layers(s, d).raw_lookup, os.path.join(landing, "open_library"))
    out = os.path.join(root, "bronze", "open_library")
    res = ingest.ingest_json(s, landing, os.path.join(root, "_checkpoints"), path=out)
    if res is None:
        raise RuntimeError("landing folder for the lookup feed is missing")
    return _flat_lookup(s.read.parquet(out))


register("ingest_json_stream", O.with_ctes(
    "SELECT isbn, target, found, title, "
    "array_to_string(list_transform(authors, lambda a: coalesce(a.name, '') || '|' || coalesce(a.key, '')), ';') AS authors, "
    "array_to_string(subjects, '|') AS subjects, number_of_pages, publish_date, _rescued_data FROM b_lookup"))(
    _ingest_json)


def _incremental(s, d) -> DataFrame:
    """Two deliveries, two availableNow runs: the second run must see only the new files."""
    raw = _feed(s, d, "books")
    first_delivery = raw.where(F.col("_source_file") == "landing/Books.csv")
    second_delivery = raw.where(F.col("_source_file") != "landing/Books.csv")
    root = scratch_path(s, "ingest", "incremental")
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "_checkpoints")
    out = os.path.join(root, "bronze", "books")
    files.write_csv_feed(first_delivery, "books", os.path.join(landing, "books"))
    run1 = ingest.ingest_csv(s, landing, "books", ckpt, path=out)
    files.write_csv_feed(second_delivery, "books", os.path.join(landing, "books"))
    run2 = ingest.ingest_csv(s, landing, "books", ckpt, path=out)
    expected_new = second_delivery.count()
    if run2.rows != expected_new:
        raise AssertionError(f"second run processed {run2.rows} rows, expected only the {expected_new} new ones")
    if run1.rows + run2.rows != raw.count():
        raise AssertionError("deliveries were not each ingested exactly once")
    return s.read.parquet(out).drop(*_RUNTIME_COLS)


register("ingest_incremental", O.with_ctes(_CSV_SQL["books"]))(_incremental)


# ------------------------------------------------------------------ evolving feeds
def _database(s) -> str:
    """A fresh database in the scratch folder."""
    place = scratch_path(s, "databases")
    name = "folio_" + os.path.basename(place)
    s.sql(f"CREATE DATABASE {name} LOCATION '{place}'")
    return name


_LOOKUP_FIELDS = [f.name for f in files.LOOKUP_SCHEMA.fields]


def _two_rounds(s, d, kind: str, changed: dict[str, F.Column]) -> tuple[DataFrame, str]:
    """Two lookup rounds, each ingested as it comes: orphan records as documented, catalogue records with changed or further keys."""
    root = scratch_path(s, "ingest", kind)
    landing, ckpt = os.path.join(root, "landing"), os.path.join(root, "_checkpoints")
    table = f"{_database(s)}.open_library"
    raw = layers(s, d).raw_lookup.select(*_LOOKUP_FIELDS)
    rounds = [raw.where("target = 'orphan'").select(*_LOOKUP_FIELDS),
              raw.where("target = 'catalog'").select(*[c for c in _LOOKUP_FIELDS if c not in changed], *[c.alias(n) for n, c in changed.items()])]
    for k, delivered in enumerate(rounds):
        delivered.write.json(os.path.join(landing, "open_library", f"round-{k}"))
        ingest.ingest_json(s, landing, ckpt, table=table)
    return s.table(table), ckpt


def _evolved(s, d) -> DataFrame:
    """The second round brings a key that the first did not know: the table gets the column."""
    table, _ = _two_rounds(s, d, "evolved", {"edition_count": (F.col("number_of_pages") / 10).cast("bigint")})
    return _flat_lookup(table, "edition_count")


_LOOKUP_SQL = ("SELECT isbn, target, found, title, "
               "array_to_string(list_transform(authors, lambda a: coalesce(a.name, '') || '|' || coalesce(a.key, '')), ';') AS authors, "
               "array_to_string(subjects, '|') AS subjects, {pages} AS number_of_pages, publish_date, {rescued} AS _rescued_data{more} FROM b_lookup")
register("ingest_json_evolved", O.with_ctes(_LOOKUP_SQL.format(
    pages="number_of_pages", rescued="_rescued_data", more=", CASE WHEN target = 'catalog' THEN number_of_pages // 10 END AS edition_count")))(_evolved)


def _drifted(s, d) -> DataFrame:
    """The second round brings page counts as text: the column stays, the values stay rescued, the log tells."""
    table, ckpt = _two_rounds(s, d, "drift", {"number_of_pages": F.concat(F.col("number_of_pages").cast("string"), F.lit(" p."))})
    told = ingest.json_registry(s, ckpt).drift().where("column = 'number_of_pages'").agg(
        F.concat_ws(" ", F.min("kind"), F.min("stored"), F.min("observed"), F.min("widened")).alias("told"))
    return table.select("isbn", "target", "number_of_pages", F.get_json_object(files.RESCUE, "$.number_of_pages").alias("rescued_pages"),
                        told.scalar().alias("told"))


register("ingest_json_drift", O.with_ctes(
    "SELECT isbn, target, CASE WHEN target = 'orphan' THEN number_of_pages END AS number_of_pages, "
    "CASE WHEN target = 'catalog' THEN CAST(number_of_pages AS VARCHAR) || ' p.' END AS rescued_pages, "
    "'type bigint string string' AS told FROM b_lookup"))(_drifted)


def _layouts(s, d) -> DataFrame:
    """Users in three header layouts side by side, one of them with a column that the feed does not know."""
    root = scratch_path(s, "ingest", "layouts")
    landing, ckpt, out = (os.path.join(root, x) for x in ("landing", "_checkpoints", "bronze"))
    raw = _feed(s, d, "users").withColumn("Region-Note", F.concat(F.lit("note "), F.col("`User-ID`")))
    layouts = [["User-ID", "Age", "Location"], ["Location", "User-ID", "Age"], ["User-ID", "Location", "Age", "Region-Note"]]
    for k, names in enumerate(layouts):
        rows = raw.where(F.col("`User-ID`").cast("long") % 3 == k).select(*[F.col(f"`{c}`") for c in names])
        rows.write.mode("append").options(**files.CSV_WRITE).csv(os.path.join(landing, "users"))
        if k != 1:  # the second and the third layout come in one delivery
            ingest.ingest_csv(s, landing, "users", ckpt, path=out)
    return s.read.parquet(out).drop(*_RUNTIME_COLS)


register("ingest_csv_layouts", O.with_ctes(
    'SELECT "User-ID", "Age", "Location", CASE WHEN CAST("User-ID" AS BIGINT) % 3 = 2 '
    "THEN '{\"Region-Note\":\"note ' || \"User-ID\" || '\"}' END AS _rescued_data FROM b_users"))(_layouts)


def _many_batches(s, d) -> DataFrame:
    """Ratings in many small micro-batches over two runs: the ledger's rows against the sink's."""
    root = scratch_path(s, "ingest", "batches")
    landing, ckpt, out = (os.path.join(root, x) for x in ("landing", "_checkpoints", "bronze"))
    raw = _feed(s, d, "ratings")
    counted = 0
    for source in ("landing/Ratings.csv", "landing/Ratings_2.csv"):
        files.write_csv_feed(raw.where(F.col("_source_file") == source), "ratings", os.path.join(landing, "ratings"))
        counted += ingest.ingest_csv(s, landing, "ratings", ckpt, path=out, max_files=2).rows
    held = s.read.parquet(out)
    return held.groupBy("Book-Rating").agg(F.count(F.lit(1)).alias("rows")).withColumn("rows_counted", F.lit(counted).cast("bigint"))


register("ingest_many_batches", O.with_ctes(
    'SELECT "Book-Rating", COUNT(*) AS rows, (SELECT COUNT(*) FROM b_ratings) AS rows_counted FROM b_ratings GROUP BY "Book-Rating"'))(_many_batches)


def _flat(s, d) -> DataFrame:
    """Ratings by their glob straight from the landing folder, beside another feed's delivery and without a lookup folder."""
    root = scratch_path(s, "ingest", "flat")
    landing, ckpt, out = (os.path.join(root, x) for x in ("landing", "_checkpoints", "bronze"))
    raw = _feed(s, d, "ratings")
    for k, source in enumerate(("landing/Ratings.csv", "landing/Ratings_2.csv")):
        files.write_csv_feed(raw.where(F.col("_source_file") == source), "ratings", os.path.join(landing, f"Ratings_{k}.csv"))
    files.write_csv_feed(_feed(s, d, "users"), "users", os.path.join(landing, "Users_0.csv"))
    ingest.ingest_csv(s, landing, "ratings", ckpt, path=out, flat=True)
    if ingest.ingest_json(s, landing, ckpt, path=os.path.join(root, "lookup")) is not None:
        raise AssertionError("there is no lookup folder to read")
    return s.read.parquet(out).drop(*_RUNTIME_COLS)


register("ingest_flat_globs", O.with_ctes(_CSV_SQL["ratings"]))(_flat)


def _replayed(s, d) -> DataFrame:
    """Everything ingested, then again into a new table by a new checkpoint: the second table."""
    root = scratch_path(s, "ingest", "replay")
    landing = os.path.join(root, "landing")
    files.write_csv_feed(_feed(s, d, "users"), "users", os.path.join(landing, "users"))
    for run in ("first", "second"):
        ingest.ingest_csv(s, landing, "users", os.path.join(root, run, "_checkpoints"), path=os.path.join(root, run, "users"))
    return s.read.parquet(os.path.join(root, "second", "users")).drop(*_RUNTIME_COLS)


register("ingest_replay", O.with_ctes(_CSV_SQL["users"]))(_replayed)


def _lineage(s, d) -> DataFrame:
    """All four feeds ingested at the same time: rows with their own feed's landing file and an ingestion time."""
    root = scratch_path(s, "ingest", "lineage")
    landing = os.path.join(root, "landing")
    lay = layers(s, d)
    for feed, frame in (("books", lay.raw_books), ("ratings", lay.raw_ratings), ("users", lay.raw_users)):
        files.write_csv_feed(frame, feed, os.path.join(landing, feed))
    files.write_json_feed(lay.raw_lookup, os.path.join(landing, "open_library"))
    sinks = {f: os.path.join(root, "bronze", f) for f in ("books", "ratings", "users", "open_library")}
    results = {r.name: r.rows for r in ingest.ingest_all(s, landing, os.path.join(root, "_checkpoints"), paths=sinks)}
    parts = [s.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_source_file").contains(f"/landing/{feed}/")).alias("rows_with_file"),
        F.count_if(F.col("_ingested_at") <= F.current_timestamp()).alias("rows_with_time")).select(
            F.lit(feed).alias("feed"), "rows", "rows_with_file", "rows_with_time", F.lit(results[feed]).cast("bigint").alias("rows_counted"))
        for feed, path in sinks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


register("bronze_lineage", O.with_ctes(" UNION ALL ".join(
    f"SELECT '{feed}' AS feed, n AS rows, n AS rows_with_file, n AS rows_with_time, n AS rows_counted FROM (SELECT COUNT(*) AS n FROM b_{table})"
    for feed, table in (("books", "books"), ("ratings", "ratings"), ("users", "users"), ("open_library", "lookup")))))(_lineage)


def _malformed_line(cols) -> F.Column:
    year = F.col("`Year-Of-Publication`")
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in cols])
    return F.when(year.like("Brand#%"), F.concat(line, F.lit(",EXTRA"))).otherwise(line)


def _rescue(s, d) -> DataFrame:
    """Rows with one field too many keep their raw line in the rescue column."""
    cols = files.CSV_COLUMNS["books"]
    path = scratch_path(s, "rescue", "books")
    _feed(s, d, "books").select(_malformed_line(cols).alias("value")).write.text(path)
    return files.read_csv_feed(s, path, "books", header=False).drop(*_RUNTIME_COLS)


_LINE_SQL = " || ',' || ".join(f'coalesce("{c}", \'\')' for c in files.CSV_COLUMNS["books"])
register("rescue_malformed", O.with_ctes(
    "SELECT " + ", ".join(f'"{c}"' for c in files.CSV_COLUMNS["books"])
    + f", CASE WHEN \"Year-Of-Publication\" LIKE 'Brand#%' THEN {_LINE_SQL} || ',EXTRA' END AS _rescued_data"
    " FROM b_books"))(_rescue)


# ------------------------------------------------------------------ run summary
_SUMMARY = [("ratings", "s_ratings"), ("quarantine_ratings", "s_quarantine_ratings"), ("books", "s_books"),
            ("quarantine_books", "s_quarantine_books"), ("book_enrichment", "s_enrichment"), ("users", "s_users")]


def _summary(s, d) -> DataFrame:
    lay = layers(s, d)
    frames = {"ratings": lay.ratings, "quarantine_ratings": lay.quarantine_ratings, "books": lay.books,
              "quarantine_books": lay.quarantine_books, "book_enrichment": lay.enrichment, "users": lay.users}
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


register("run_summary", O.with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS rows FROM {cte}" for name, cte in _SUMMARY)))(
    _summary)
