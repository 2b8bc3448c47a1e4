"""Driver tables -> raw feeds in the shape the pipeline ingests.

The test data carries no book data, so the four feeds (books, ratings, users and the
secondary lookup records) are a deterministic re-shaping of the TPC-H-like tables. The
rules are arithmetic on keys (``%``, ``lpad``, ``CASE``), so they run fully distributed,
grow with the input and are re-stated as SQL in ``folio.oracle`` for the DuckDB check.

Every row of every input is used: each line item becomes a rating, each customer a user,
and each part lands in the primary catalogue, in the secondary source or in neither (the
orphans that stay orphaned). Modulo conditions assign those roles and inject the dirty
variants; they never drop rows to save work.

What each rule exercises:

* ratings: ``User-ID`` from the order's customer; the key gets case/space noise on even
  line numbers, a bad first character for every 13th part (an orphan that fails the key
  format), an all-space key and a non-numeric user now and then (quarantine); quantity
  becomes the grade, 0 = implicit, 11 = out of range.
* books: one primary row per part with ``p % 10 <> 0``; a normalisation duplicate when
  ``p % 50 = 1``, an exact raw duplicate when ``p % 199 = 3``; spelling variants of the
  author, mojibake in titles, years that are invalid, zero, padded, missing or shifted text.
* lookup records: orphan parts (``p % 10 = 0`` and not ``p % 30 = 0``), stale orphan
  targets that the primary source already has (``p % 100 = 15``) and catalogue targets
  (``p % 3 = 1``); found unless ``p % 7 = 0``.
* users: ages as decimal text with junk, locations with 1-4 parts, placeholders and junk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources.tables import read_table

# Fixed fixture values (also stated in folio.oracle).
INGESTED_AT = "2024-05-01 00:00:00"
MOJIBAKE_ONCE = " caf\u00c3\u00a9"              # ' café' read once as Latin-1
MOJIBAKE_TWICE = " caf\u00c3\u0083\u00c2\u00a9"  # ' café' read twice as Latin-1
CLEAN_SUFFIX = " caf\u00e9"
IMAGE_PREFIX = "http://images.example/"
AUTHOR_URL_PREFIX = "https://catalog.example/authors/"


def book_key(pk: Column) -> Column:
    """Ten-character key: nine zero-padded digits and a check character (digit or X)."""
    check = F.when(pk % 11 == 10, F.lit("X")).otherwise((pk % 11).cast("string"))
    return F.concat(F.lpad(pk.cast("string"), 9, "0"), check)


def _ingested() -> Column:
    return F.lit(INGESTED_AT).cast("timestamp")


def _author_raw(p: Column, p_size: Column, p_type: Column) -> Column:
    initial = F.substring(F.lit("ABC"), (p_size % 3 + 1).cast("int"), 1)
    sep = (F.when(p % 4 == 0, ". ").when(p % 4 == 1, ".").when(p % 4 == 2, " .").otherwise(" "))
    return (F.when(p % 53 == 0, F.lit(None).cast("string"))
            .when(p % 17 == 0, F.concat(F.lit("O'"), p_type))
            .otherwise(F.concat(initial, sep, p_type)))


def _book_title(p: Column, p_name: Column) -> Column:
    suffix = (F.when(p % 12 == 1, MOJIBAKE_ONCE).when(p % 12 == 5, MOJIBAKE_TWICE)
              .when(p % 12 == 7, CLEAN_SUFFIX).otherwise(""))
    return F.concat(p_name, suffix)


def _year_raw(p: Column, p_size: Column, p_brand: Column) -> Column:
    year = (F.lit(1957) + p_size).cast("string")
    return (F.when(p % 97 == 0, p_brand)
            .when(p % 89 == 0, F.lit(None).cast("string"))
            .when(p % 31 == 0, F.lit("0"))
            .when(p % 37 == 0, F.concat(F.lit(" "), year, F.lit(" ")))
            .otherwise(year))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings feed: one interaction per line item; user = the order's customer."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    key = book_key(pk)
    isbn = (F.when((ok % 503 == 0) & (ln == 2), F.lit("  "))
            .when(pk % 13 == 0, F.concat(F.lit("Z"), F.substring(key, 2, 9)))
            .when(ln % 2 == 0, F.concat(F.lit(" "), F.lower(key), F.lit(" ")))
            .otherwise(key))
    user = F.when((ok % 499 == 0) & (ln == 3), F.lit("unknown")).otherwise(F.col("o_custkey").cast("string"))
    q = F.col("l_quantity").cast("int")
    grade = (F.when(q <= 31, 0).when(q <= 41, q - 31).when(q == 50, 11).otherwise(q - 40)).cast("string")
    src = F.when(ok % 4 == 3, "landing/Ratings_2.csv").otherwise("landing/Ratings.csv")
    return j.select(
        user.alias("User-ID"), isbn.alias("ISBN"), grade.alias("Book-Rating"),
        F.lit(None).cast("string").alias("_rescued_data"),
        src.alias("_source_file"), _ingested().alias("_ingested_at"),
    )


def raw_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary catalogue feed, including normalisation and exact duplicates."""
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    p = F.col("p_partkey")
    primary = part.where(p % 10 != 0)
    copies = (primary.withColumn("_copy", F.lit(0))
              .unionByName(primary.where(p % 50 == 1).withColumn("_copy", F.lit(1)))
              .unionByName(primary.where(p % 199 == 3).withColumn("_copy", F.lit(2))))
    cp = F.col("_copy")
    key = book_key(p)
    isbn = F.when(cp == 1, F.concat(F.lit(" "), F.lower(key), F.lit(" "))).otherwise(key)
    image = F.concat(F.lit(IMAGE_PREFIX), p.cast("string"),
                     F.when(cp == 1, "-b").otherwise(""), F.lit(".jpg"))
    src = F.when(cp == 1, "landing/Books_2.csv").when(cp == 2, "landing/Books_3.csv").otherwise("landing/Books.csv")
    return copies.select(
        isbn.alias("ISBN"),
        _book_title(p, F.col("p_name")).alias("Book-Title"),
        _author_raw(p, F.col("p_size"), F.col("p_type")).alias("Book-Author"),
        _year_raw(p, F.col("p_size"), F.col("p_brand")).alias("Year-Of-Publication"),
        F.col("p_brand").alias("Publisher"),
        image.alias("Image-URL-L"),
        F.lit(None).cast("string").alias("_rescued_data"),
        src.alias("_source_file"), _ingested().alias("_ingested_at"),
    )


AUTHOR_TYPE = T.StructType([T.StructField("name", T.StringType()), T.StructField("key", T.StringType())])


def _lookup_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(part, target, file) pairs for which a lookup record exists."""
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    p = F.col("p_partkey")
    orphans = part.where(((p % 10 == 0) & (p % 30 != 0)) | (p % 100 == 15)) \
        .withColumn("target", F.lit("orphan")).withColumn("_file", F.lit("landing/open_library/part-0.jsonl"))
    catalog = part.where((p % 10 != 0) & (p % 3 == 1)) \
        .withColumn("target", F.lit("catalog")).withColumn("_file", F.lit("landing/open_library/part-1.jsonl"))
    return orphans.unionByName(catalog)


def lookup_payload(p: Column, p_name: Column, p_brand: Column, p_type: Column, p_size: Column) -> dict:
    """Columns of a found lookup record (also used to fabricate lookup responses)."""
    title = (F.when(p % 11 == 0, F.lit(None).cast("string"))
             .when(p % 8 == 0, F.concat(p_name, F.lit(MOJIBAKE_ONCE))).otherwise(p_name))
    author = F.struct(_author_raw(p, p_size, p_type).alias("name"),
                      F.concat(F.lit("OL"), p.cast("string"), F.lit("A")).alias("key"))
    authors = F.when(p % 9 == 1, F.array().cast(T.ArrayType(AUTHOR_TYPE))).otherwise(F.array(author))
    first = F.when(p % 6 == 1, F.concat(F.lit("Fiction, "), p_name)).otherwise(F.concat(p_name, F.lit(", general")))
    subjects = F.when(p % 5 == 2, F.array().cast(T.ArrayType(T.StringType()))).otherwise(
        F.array(first, F.concat(p_type, F.lit(", "), p_brand),
                F.when(p % 4 == 0, p_type).otherwise(F.lit("etc."))))
    pages = F.when(p % 9 != 0, (p_size * 10).cast("bigint"))
    published = F.when(p % 9 == 4, F.lit("unknown")).otherwise(
        F.concat(F.lit("March "), (F.lit(1950) + p_size % 50).cast("string")))
    return {"title": title, "authors": authors, "subjects": subjects,
            "number_of_pages": pages, "publish_date": published}


def raw_lookup_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary source: one JSON-shaped record per looked-up key (found or not)."""
    base = _lookup_base(spark, sf_dir)
    p = F.col("p_partkey")
    found = p % 7 != 0
    key = book_key(p)
    isbn = F.when(p % 20 == 10, F.lower(key)).otherwise(key)
    payload = lookup_payload(p, F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size"))
    return base.select(
        isbn.alias("isbn"), F.col("target"), found.alias("found"),
        *[F.when(found, c).alias(name) for name, c in payload.items()],
        F.lit(None).cast("string").alias("_rescued_data"),
        F.col("_file").alias("_source_file"), _ingested().alias("_ingested_at"),
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users feed: customer + nation + region re-shaped into age and free-text location."""
    cu = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    na = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    rg = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    # nation and region are tiny dimensions; Spark's size-checked automatic broadcast picks
    # them up from their measured size, no hint needed.
    j = cu.join(na, cu.c_nationkey == na.n_nationkey).join(rg, F.col("n_regionkey") == rg.r_regionkey)
    c = F.col("c_custkey")
    seg, nat, reg = F.col("c_mktsegment"), F.col("n_name"), F.col("r_name")
    lseg, lnat, lreg = F.lower(seg), F.lower(nat), F.lower(reg)
    age = (F.when(c % 11 == 0, F.lit("abc"))
           .when(c % 13 == 0, F.lit(None).cast("string"))
           .otherwise(F.concat(F.floor(F.abs(F.col("c_acctbal")) / 80).cast("bigint").cast("string"), F.lit(".0"))))
    k = c % 8
    loc = (F.when(c % 29 == 0, F.lit(None).cast("string"))
           .when(k == 0, lnat)
           .when(k == 1, F.concat(lseg, F.lit(", n/a")))
           .when(k == 2, F.concat(lseg, F.lit(", ,")))
           .when(k == 3, F.concat_ws(", ", F.lit("herne bay"), lseg, lnat, lreg))
           .when(k == 4, F.lit("n/a, n/a, n/a"))
           .when(k == 5, F.concat(lseg, F.lit(', \\n/a"')))
           .when(k == 6, F.concat(F.lit('"'), F.concat_ws(", ", seg, nat, reg), F.lit(")")))
           .otherwise(F.concat_ws(", ", lseg, lnat, lreg)))
    return j.select(
        c.cast("string").alias("User-ID"), age.alias("Age"), loc.alias("Location"),
        F.lit(None).cast("string").alias("_rescued_data"),
        F.lit("landing/Users.csv").alias("_source_file"), _ingested().alias("_ingested_at"),
    )


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys sent to the lookup service (found or not), with the part attributes that
    stand in for the service's answer."""
    base = _lookup_base(spark, sf_dir)
    p = F.col("p_partkey")
    key = book_key(p)
    return base.select(F.when(p % 20 == 10, F.lower(key)).otherwise(key).alias("isbn"),
                       "target", "p_partkey", "p_name", "p_brand", "p_type", "p_size")


def lookup_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer documents of the lookup service: one JSON object per group of keys, keyed
    ``ISBN:<key>``, holding only found keys (absent keys mean "not found").

    Keys are grouped by their first eight characters (at most ten keys per group), so
    every ``collect_list`` is bounded.
    """
    req = lookup_requests(spark, sf_dir).drop("target").distinct()
    p = F.col("p_partkey")
    found = req.where(p % 7 != 0)
    payload = lookup_payload(p, F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size"))
    ol = F.concat(F.lit("OL"), p.cast("string"))
    url = (F.when(p % 3 == 0, F.concat(F.lit(AUTHOR_URL_PREFIX), ol, F.lit("A/")))
           .when(p % 3 == 1, F.concat(F.lit(AUTHOR_URL_PREFIX), ol, F.lit("A/Some_Name")))
           .otherwise(F.concat(F.lit("https://catalog.example/people/"), ol, F.lit("A"))))
    first = F.struct(_author_raw(p, F.col("p_size"), F.col("p_type")).alias("name"), url.alias("url"))
    second = F.struct(F.concat(F.lit("Second "), F.col("p_type")).alias("name"),
                      F.concat(F.lit(AUTHOR_URL_PREFIX), ol, F.lit("B")).alias("url"))
    authors = (F.when(p % 9 == 1, F.array().cast("array<struct<name:string,url:string>>"))
               .when(p % 5 == 0, F.array(first, second)).otherwise(F.array(first)))
    subjects = F.transform(F.sequence(F.lit(1), (F.lit(2) + p % 30).cast("int")),
                           lambda i: F.struct(F.concat(F.col("p_type"), F.lit(" "), i.cast("string")).alias("name")))
    value = F.struct(payload["title"].alias("title"), authors.alias("authors"), subjects.alias("subjects"),
                     payload["number_of_pages"].alias("number_of_pages"),
                     payload["publish_date"].alias("publish_date"))
    entry = F.struct(F.concat(F.lit("ISBN:"), F.col("isbn")).alias("key"), value.alias("value"))
    grouped = found.groupBy(F.substring("isbn", 1, 8).alias("grp")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("m"))
    return grouped.select("grp", F.to_json("m").alias("body"))


def lookup_output_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier lookup output as JSON lines, plus a truncated copy of every not-found line
    (a write cut short), which a tolerant reader must skip."""
    rec = raw_lookup_records(spark, sf_dir)
    fields = ["isbn", "target", "found", "title", "authors", "subjects", "number_of_pages", "publish_date"]
    good = rec.select(F.to_json(F.struct(*fields)).alias("value"))
    broken = rec.where(~F.col("found")).select(F.concat(F.lit('{"isbn": "'), F.col("isbn")).alias("value"))
    return good.unionByName(broken)
