"""Enrichment loop: which keys to look up, what is still to do, request batches, shaping
the lookup answers into records, and coverage.

The reference runs this as a single-machine script over in-memory counters. Here every
step is a DataFrame job: key counts are a grouped aggregate (partial aggregation makes
a hot key cheap), membership is a join on the key, resume is an anti join, batches come
from a lazy distributed numbering, and answers are parsed with ``from_json`` and
consumes answer documents instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import author_key_from_url, normalize_key, valid_key
from folio.operators.ordering import radix_row_number

# Fixed values of the lookup loop.
TOP_CATALOG = 2000      # most-rated catalogue keys looked up for enrichment
BATCH_SIZE = 50         # keys per lookup request
SUBJECT_LIMIT = 25      # subjects kept per record
KEY_PREFIX = "ISBN:"    # request/answer key prefix

ANSWER_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]))),
    T.StructField("subjects", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    T.StructField("number_of_pages", T.LongType()),
    T.StructField("publish_date", T.StringType()),
])


def _c(name: str):
    return F.col(f"`{name}`")


def target_keys(raw_ratings: DataFrame, raw_books: DataFrame, top_catalog: int = TOP_CATALOG) -> DataFrame:
    """Orphan keys of valid format, plus the ``top_catalog`` most-rated catalogue keys
    (the limit is taken before the format filter, as in the reference)."""
    rated = raw_ratings.where(_c("_rescued_data").isNull()).select(   # rows of the expected width
        normalize_key(_c("ISBN")).alias("isbn"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("listed"))
    listed = raw_books.where(_c("ISBN").isNotNull()).select(
        normalize_key(_c("ISBN")).alias("isbn"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("listed"))
    # One shuffle serves both branches; the format flag is an aggregate, so neither branch's filter moves below it.
    keys = (rated.unionByName(listed).groupBy("isbn")
            .agg(F.sum("n").alias("n"), F.max("listed").alias("listed"), F.max(valid_key("isbn")).alias("valid"))
            .where("n > 0"))
    orphans = keys.where(~F.col("listed") & F.col("valid")).select("isbn", F.lit("orphan").alias("target"), "n")
    top = keys.where("listed").orderBy(F.col("n").desc(), F.col("isbn").asc()).limit(top_catalog)
    catalog_targets = top.where("valid").select("isbn", F.lit("catalog").alias("target"), "n")
    return orphans.unionByName(catalog_targets)


def done_keys(lines: DataFrame, column: str = "value") -> DataFrame:
    """Keys already recorded, from JSON lines of earlier output; unparsable lines are ignored."""
    parsed = F.from_json(F.col(column), "isbn STRING")
    return (lines.select(parsed.getField("isbn").alias("isbn")).where(F.col("isbn").isNotNull())
            .select(normalize_key("isbn").alias("isbn")).distinct())


def remaining_targets(targets: DataFrame, done: DataFrame) -> DataFrame:
    """Resume: targets minus keys already looked up (found or not)."""
    return targets.join(done, "isbn", "left_anti")


def numbered_targets(targets: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Targets in lookup order with their place (``rn``, from 1) and request batch (``batch_id``, from 0).

    Orphans come first, then the more often rated, then the smaller key. A lazy plan: no job runs here.
    """
    rank = F.struct(F.when(F.col("target") == "orphan", 0).otherwise(1).alias("late"), (-F.col("n")).alias("less"))
    numbered = radix_row_number(targets, rank, "isbn")
    return numbered.withColumn("batch_id", F.floor((F.col("rn") - 1) / batch_size).cast("long"))


def request_batches(targets: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Pack targets, in target order, into batches of ``batch_size`` with the request string."""
    batched = numbered_targets(targets, batch_size)
    grouped = batched.groupBy("batch_id").agg(   # each group holds at most batch_size keys
        F.count(F.lit(1)).alias("n_keys"),
        F.array_sort(F.collect_list(F.struct("rn", "isbn"))).alias("_keys"))
    return grouped.select(
        "batch_id", "n_keys",
        F.array_join(F.transform("_keys", lambda k: F.concat(F.lit(KEY_PREFIX), k.getField("isbn"))), ",")
        .alias("bibkeys"))


def _answered(body: str):
    """An answer document as a map of its keys to their raw JSON; NULL where the document is broken."""
    return F.from_json(F.col(body), "map<string,string>")


def answered_requests(requests: DataFrame, answers: DataFrame, body: str = "body") -> DataFrame:
    """Requests whose batch has a readable answer; the others stay open for a later round.

    Needs ``batch_id`` on both sides. Answers without that column are one complete harvest, so every request counts as
    answered, but only if each of them can be read: a broken one may hold any key, and the round fails on it.
    """
    if "batch_id" not in answers.columns:
        broken = answers.where(_answered(body).isNull()).agg(F.count(F.lit(1))).scalar()
        refuse = F.raise_error(F.lit("an answer without batch_id can't be read; its keys are unknown"))
        return requests.where(F.when(broken > 0, refuse.cast("boolean")).otherwise(F.lit(True)))
    return requests.join(answers.where(_answered(body).isNotNull()).select("batch_id"), "batch_id", "left_semi")


def shape_records(requests: DataFrame, answers: DataFrame, body: str = "body") -> DataFrame:
    """Answer documents (one JSON object per request, keyed ``ISBN:<key>``) -> one record
    per requested key; a key without an answer, or with an empty one, gives ``found = false``."""
    entries = answers.select(F.explode(_answered(body)).alias("k", "raw"))
    found = entries.where(F.col("k").startswith(KEY_PREFIX)).select(
        F.substring(F.col("k"), len(KEY_PREFIX) + 1, 1 << 30).alias("isbn"),
        (F.col("raw").startswith("{") & (F.col("raw") != "{}")).alias("_has"),
        F.from_json(F.col("raw"), ANSWER_SCHEMA).alias("data"))
    d, has = F.col("data"), F.coalesce("_has", F.lit(False))
    authors = F.transform(F.coalesce(d.getField("authors"), F.array()),
                          lambda a: F.struct(a.getField("name").alias("name"),
                                             author_key_from_url(a.getField("url")).alias("key")))
    subjects = F.slice(F.transform(F.coalesce(d.getField("subjects"), F.array()), lambda s: s.getField("name")),
                       1, SUBJECT_LIMIT)
    return requests.select("isbn", "target").join(found, "isbn", "left").select(
        "isbn", "target", has.alias("found"),
        F.when(has, d.getField("title")).alias("title"),
        F.when(has, authors).alias("authors"),
        F.when(has, subjects).alias("subjects"),
        F.when(has, d.getField("number_of_pages")).alias("number_of_pages"),
        F.when(has, d.getField("publish_date")).alias("publish_date"))


def coverage(records: DataFrame) -> DataFrame:
    """Found share per target tag."""
    return records.groupBy("target").agg(
        F.count(F.lit(1)).alias("keys_total"),
        F.count_if(F.col("found")).alias("keys_found"),
    ).withColumn("found_pct", F.round(F.lit(100) * F.col("keys_found") / F.col("keys_total"), 1))


def run_round(spark, raw_ratings: DataFrame, raw_books: DataFrame, answers: DataFrame, output_path: str,
              top_catalog: int = TOP_CATALOG, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One resumable round of the lookup loop as Spark jobs.

    targets -> minus keys already under ``output_path`` (tolerant JSON-lines read of all
    earlier rounds) -> request batches -> records shaped from ``answers`` -> appended as
    JSON lines in a new round folder (found or not, so a rerun skips them) -> coverage of
    this round. Batches whose answer is missing or broken are not recorded and are asked for
    again (``answered_requests``). A rerun with no new targets appends an empty round.
    """
    import os
    import uuid

    from folio.sources import files, storage  # local import keeps operators free of I/O at import time

    targets = target_keys(raw_ratings, raw_books, top_catalog)
    earlier = spark.read.option("recursiveFileLookup", "true").text(output_path) \
        if storage.path_exists(spark, output_path) else None
    remaining = targets if earlier is None else remaining_targets(targets, done_keys(earlier))
    requests = answered_requests(numbered_targets(remaining, batch_size), answers)
    round_path = os.path.join(output_path, f"round-{uuid.uuid4().hex[:12]}")
    files.write_json_feed(shape_records(requests, answers), round_path)
    return coverage(files.read_json_tolerant(spark, round_path))
