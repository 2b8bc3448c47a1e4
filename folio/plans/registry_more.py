"""Registered queries, part two: profiles, per-rule checks, enrichment and analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio import oracle as O
from folio.functions import (
    clean_age,
    clean_year,
    fix_mojibake,
    normalize_author,
    parse_location,
    publish_year,
)
from folio.operators import analysis, enrichment, profiling
from folio.plans.registry import layers, register
from folio.sources import bridge
from folio.sources.tables import read_table

SI, R = O.SI, O.ROUND
PUBLISH_YEAR_TEXT = "regexp_extract(publish_date, '(\\d{4})', 1)"

# ------------------------------------------------------------------ profiles
register("prof_rating_distribution", O.with_ctes(
    f'SELECT "Book-Rating" AS rating, CAST(COUNT(*) AS BIGINT) AS cnt, '
    f'{R("100 * COUNT(*) / (SELECT COUNT(*) FROM b_ratings)", 2)} AS pct FROM b_ratings GROUP BY "Book-Rating"'))(
    lambda s, d: profiling.rating_distribution(layers(s, d).raw_ratings))

register("prof_orphans", O.with_ctes(
    'SELECT CAST(COUNT(*) AS BIGINT) AS orphan_ratings FROM b_ratings r WHERE NOT EXISTS '
    '(SELECT 1 FROM b_books b WHERE upper(trim(r."ISBN")) = upper(trim(b."ISBN")))'))(
    lambda s, d: profiling.orphan_ratings(layers(s, d).raw_ratings, layers(s, d).raw_books))

_Y = '"Year-Of-Publication"'
register("prof_year_range", O.with_ctes(
    f"SELECT MIN({SI(_Y)}) AS min_year, MAX({SI(_Y)}) AS max_year, "
    f"COUNT(*) FILTER (WHERE {_Y} = '0') AS year_zero, "
    f"COUNT(*) FILTER (WHERE {SI(_Y)} > YEAR(CURRENT_DATE)) AS future, "
    f"COUNT(*) FILTER (WHERE {SI(_Y)} IS NULL) AS non_numeric FROM b_books"))(
    lambda s, d: profiling.year_range(layers(s, d).raw_books))

register("prof_shifted_rows", O.with_ctes(
    f'SELECT "ISBN", "Book-Title", "Book-Author", {_Y}, "Publisher", "Image-URL-L", _rescued_data, _source_file '
    f"FROM b_books WHERE {SI(_Y)} IS NULL"))(
    lambda s, d: profiling.shifted_rows(layers(s, d).raw_books).drop("_ingested_at"))

register("prof_duplicate_keys", O.with_ctes(
    'SELECT "ISBN", CAST(COUNT(*) AS BIGINT) AS cnt FROM b_books GROUP BY "ISBN" HAVING COUNT(*) > 1'))(
    lambda s, d: profiling.duplicate_keys(layers(s, d).raw_books))

# The reference looks for '%rowling%'; the fixture's multi-spelling author is PROMO.
register("prof_author_variants", O.with_ctes(
    'SELECT "Book-Author", CAST(COUNT(*) AS BIGINT) AS cnt FROM b_books '
    "WHERE \"Book-Author\" ILIKE '%promo%' GROUP BY \"Book-Author\""))(
    lambda s, d: profiling.author_variants(layers(s, d).raw_books, "%promo%"))


def _age_sql(expr: str) -> str:
    return (f"SELECT MIN({expr}) AS min_age, MAX({expr}) AS max_age, "
            f"COUNT(*) FILTER (WHERE {expr} IS NULL) AS null_or_nonnumeric, "
            f"COUNT(*) FILTER (WHERE {expr} < 5 OR {expr} > 110) AS out_of_range FROM b_users")


register("prof_age_range", O.with_ctes(_age_sql(SI('"Age"'))))(
    lambda s, d: profiling.age_range(layers(s, d).raw_users))
register("prof_age_range_fixed", O.with_ctes(_age_sql('CAST(trunc(TRY_CAST("Age" AS DOUBLE)) AS INTEGER)')))(
    lambda s, d: profiling.age_range_fixed(layers(s, d).raw_users))
register("prof_location_parts", O.with_ctes(
    'SELECT CAST(len(string_split("Location", \',\')) AS INTEGER) AS parts, CAST(COUNT(*) AS BIGINT) AS cnt '
    "FROM b_users GROUP BY 1"))(
    lambda s, d: profiling.location_parts(layers(s, d).raw_users))

# ------------------------------------------------------------------ rules, one query per rule
# Mojibake round trip over whole documents: read UTF-8 bytes as Latin-1, then repair.


def _mojibake(s, d):
    docs = read_table(s, d, "documents", ["doc_id", "text"])
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", fix_mojibake(garbled).alias("text"), (garbled != F.col("text")).alias("changed"))


register("fix_mojibake", "SELECT doc_id, text, regexp_matches(text, '[^\\x00-\\x7F]') AS changed FROM documents")(
    _mojibake)

register("normalize_author", O.with_ctes(
    'SELECT DISTINCT "Book-Author" AS raw_author, _author_clean AS author FROM b_books'))(
    lambda s, d: layers(s, d).raw_books.select(
        F.col("`Book-Author`").alias("raw_author"), normalize_author(F.col("`Book-Author`")).alias("author"))
    .distinct())

register("clean_year", O.with_ctes(
    f"SELECT DISTINCT {_Y} AS raw_year, {O.YEAR_CLEAN(_Y)} AS year_of_publication FROM b_books"))(
    lambda s, d: layers(s, d).raw_books.select(
        F.col("`Year-Of-Publication`").alias("raw_year"),
        clean_year(F.col("`Year-Of-Publication`")).alias("year_of_publication"))
    .distinct())

_AGE = '"Age"'
register("clean_age", O.with_ctes(f"SELECT DISTINCT {_AGE} AS raw_age, {O.AGE_CLEAN(_AGE)} AS age FROM b_users"))(
    lambda s, d: layers(s, d).raw_users.select(F.col("Age").alias("raw_age"), clean_age("Age").alias("age")).distinct())

register("parse_location", O.with_ctes(
    'SELECT DISTINCT "Location" AS raw_location, city, state, country FROM s_users_loc'))(
    lambda s, d: layers(s, d).raw_users.select(F.col("Location").alias("raw_location"),
                                               parse_location("Location").alias("loc"))
    .select("raw_location", "loc.city", "loc.state", "loc.country").distinct())

register("publish_year", O.with_ctes(
    "SELECT DISTINCT publish_date AS raw_date, "
    f"{O.YEAR_CLEAN(PUBLISH_YEAR_TEXT)} AS year_of_publication FROM b_lookup"))(
    lambda s, d: layers(s, d).raw_lookup.select(F.col("publish_date").alias("raw_date"),
                                                publish_year("publish_date").alias("year_of_publication")).distinct())

# ------------------------------------------------------------------ enrichment loop


def _targets(s, d):
    lay = layers(s, d)
    return enrichment.target_keys(lay.raw_ratings, lay.raw_books)


def _remaining(s, d):
    return enrichment.remaining_targets(_targets(s, d), enrichment.done_keys(bridge.lookup_output_lines(s, d)))


register("enrich_targets", O.with_ctes("SELECT isbn, target, n FROM e_targets", O.ENRICH_CTES))(_targets)
register("enrich_resume", O.with_ctes("SELECT isbn, target, n FROM e_remaining", O.ENRICH_CTES))(_remaining)
register("enrich_batches", O.with_ctes(
    "SELECT (rn - 1) // 50 AS batch_id, COUNT(*) AS n_keys, string_agg('ISBN:' || isbn, ',' ORDER BY rn) AS bibkeys "
    "FROM e_numbered GROUP BY 1", O.ENRICH_CTES))(
    lambda s, d: enrichment.request_batches(_remaining(s, d)))



def _tolerant_targets(s, d):
    """Ratings of which some lines did not fit their header: those count for no key."""
    lay = layers(s, d)
    broken = lay.raw_ratings.withColumn("_rescued_data", F.when(F.col("Book-Rating") == "7", F.concat_ws(",", "User-ID", "ISBN", "Book-Rating")))
    return enrichment.target_keys(broken, lay.raw_books)


register("enrich_targets_tolerant", O.with_ctes(
    "SELECT isbn, target, n FROM e_targets", O.ENRICH_CTES.replace("WHERE _rescued_data IS NULL", "WHERE \"Book-Rating\" <> '7'")))(_tolerant_targets)

_SHAPE_SQL = f"""
SELECT CASE WHEN p % 20 = 10 THEN lower(k) ELSE k END AS isbn, target, (p % 7 <> 0) AS found,
  CASE WHEN p % 7 <> 0 THEN (CASE WHEN p % 11 = 0 THEN NULL WHEN p % 8 = 0 THEN p_name || {O._q(bridge.MOJIBAKE_ONCE)}
       ELSE p_name END) END AS title,
  CASE WHEN p % 7 <> 0 AND p % 9 <> 1 THEN ({O.AUTHOR_RAW}) END AS first_author,
  CASE WHEN p % 7 <> 0 AND p % 9 <> 1 THEN (CASE WHEN p % 3 = 2 THEN 'https:' ELSE 'OL' || CAST(p AS VARCHAR) || 'A' END)
       END AS first_author_key,
  CASE WHEN p % 7 <> 0 THEN (CASE WHEN p % 9 = 1 THEN 0 WHEN p % 5 = 0 THEN 2 ELSE 1 END) END AS n_authors,
  CASE WHEN p % 7 <> 0 THEN array_to_string(list_transform(range(1, least(2 + p % 30, 25) + 1),
       lambda i: p_type || ' ' || CAST(i AS VARCHAR)), '|') END AS subjects,
  CASE WHEN p % 7 <> 0 AND p % 9 <> 0 THEN CAST(p_size * 10 AS BIGINT) END AS number_of_pages,
  CASE WHEN p % 7 <> 0 THEN (CASE WHEN p % 9 = 4 THEN 'unknown' ELSE 'March ' || CAST(1950 + p_size % 50 AS VARCHAR) END)
       END AS publish_date
FROM b_lookup_base"""


def _shape(s, d):
    rec = enrichment.shape_records(bridge.lookup_requests(s, d), bridge.lookup_answers(s, d))
    found = F.col("found")
    return rec.select(
        "isbn", "target", "found", "title",
        F.get("authors", 0).getField("name").alias("first_author"),
        F.get("authors", 0).getField("key").alias("first_author_key"),
        F.when(found, F.size("authors")).alias("n_authors"),
        F.array_join("subjects", "|").alias("subjects"), "number_of_pages", "publish_date")


register("enrich_shape", O.with_ctes(_SHAPE_SQL))(_shape)

register("enrich_coverage", O.with_ctes(
    "SELECT target, COUNT(*) AS keys_total, COUNT(*) FILTER (WHERE found) AS keys_found, "
    f"{R('100 * COUNT(*) FILTER (WHERE found) / COUNT(*)', 1)} AS found_pct FROM b_lookup GROUP BY target"))(
    lambda s, d: enrichment.coverage(layers(s, d).raw_lookup))

# ------------------------------------------------------------------ analyses
register("support_quantiles", O.with_ctes(
    f"SELECT COUNT(*) AS rated_books, {R('quantile_cont(ratings_cnt, 0.5)', 3)} AS median_ratings, "
    f"{R('quantile_cont(ratings_cnt, 0.99)', 3)} AS p99_ratings FROM v_books WHERE ratings_cnt > 0"))(
    lambda s, d: analysis.support_quantiles(layers(s, d).v_books()))

_MS = (10, 25, 50)
register("m_sensitivity", O.with_ctes(
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT {m} AS m, title, author, ratings_cnt, weighted_rating, CAST(ROW_NUMBER() OVER ("
        f"ORDER BY weighted_rating DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST) AS INTEGER) AS rank "
        f"FROM v_books_m{m}) WHERE rank <= 10" for m in _MS),
    ",".join(O.v_books_for(m) for m in _MS)))(
    lambda s, d: analysis.m_sensitivity(layers(s, d).ratings, layers(s, d).books, _MS, stats=layers(s, d).stats))

register("top_user_share", O.with_ctes(
    "SELECT CAST(t.n_users AS BIGINT) AS users, t.k AS top_users, CAST(t.n_ratings AS BIGINT) AS ratings, "
    "CAST(SUM(r.cnt) AS BIGINT) AS top_users_ratings, "
    f"{R('100 * (SUM(r.cnt) / t.n_ratings)', 1)} AS top_share_pct "
    "FROM (SELECT cnt, ROW_NUMBER() OVER (ORDER BY cnt DESC) AS rn FROM tu_users) r, tu_tot t "
    "WHERE r.rn <= t.k GROUP BY t.n_users, t.k, t.n_ratings",
    "tu_users AS (SELECT user_id, COUNT(*) AS cnt FROM s_ratings GROUP BY user_id), "
    "tu_tot AS (SELECT COUNT(*) AS n_users, SUM(cnt) AS n_ratings, CAST((COUNT(*) + 99) // 100 AS BIGINT) AS k FROM tu_users)"))(
    lambda s, d: analysis.top_user_share(layers(s, d).ratings))

register("multi_edition_groups", O.with_ctes(
    "SELECT COUNT(*) AS books, COUNT(*) FILTER (WHERE editions > 1) AS multi_edition_groups FROM v_books"))(
    lambda s, d: analysis.multi_edition_groups(layers(s, d).v_books()))

def _value_quantiles(s, d):
    """Quantiles of columns with nearly as many values as rows."""
    parts = [analysis.exact_quantiles(read_table(s, d, table, [col]), col, (0.5, 0.99)).select(F.lit(col).alias("measure"), F.col("groups").alias("n"), "q_p5", "q_p99")
             for table, col in (("lineitem", "l_extendedprice"), ("orders", "o_totalprice"), ("customer", "c_acctbal"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


register("value_quantiles", " UNION ALL ".join(
    f"SELECT '{col}' AS measure, COUNT({col}) AS n, {R(f'quantile_cont(CAST({col} AS DOUBLE), 0.5)', 3)} AS q_p5, "
    f"{R(f'quantile_cont(CAST({col} AS DOUBLE), 0.99)', 3)} AS q_p99 FROM {table}"
    for table, col in (("lineitem", "l_extendedprice"), ("orders", "o_totalprice"), ("customer", "c_acctbal"))))(_value_quantiles)


register("orphan_recovery", O.with_ctes(
    "SELECT before AS orphans_before, after AS orphans_after, unrec AS unrecoverable_format, "
    f"{R('100 * ((before - after) / before)', 1)} AS rescued_pct FROM ("
    "SELECT COUNT(*) FILTER (WHERE b.isbn IS NULL OR b.source = 'open_library') AS before, "
    "COUNT(*) FILTER (WHERE b.isbn IS NULL) AS after, "
    f"COUNT(*) FILTER (WHERE b.isbn IS NULL AND NOT {O.KEY_OK.format(x='r.isbn')}) AS unrec "
    "FROM s_ratings r LEFT JOIN s_books b ON r.isbn = b.isbn)"))(
    lambda s, d: analysis.orphan_recovery(layers(s, d).ratings, layers(s, d).catalogue_keys, stats=layers(s, d).stats))

register("user_integrity", O.with_ctes(
    "SELECT total AS ratings_total, missing AS ratings_without_user, "
    f"{R('100 * (1 - missing / total)', 2)} AS integrity_pct FROM ("
    "SELECT CAST(COUNT(*) AS BIGINT) AS total, CAST(COUNT(*) FILTER (WHERE NOT EXISTS ("
    "SELECT 1 FROM s_users u WHERE u.user_id = r.user_id)) AS BIGINT) AS missing FROM s_ratings r)"))(
    lambda s, d: analysis.user_integrity(layers(s, d).ratings, layers(s, d).users))

register("attribute_null_rates", O.with_ctes(
    "SELECT total AS users_total, nulled AS age_nulled, "
    f"{R('100 * (nulled / total)', 1)} AS age_null_pct, missing AS country_missing FROM ("
    "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE age IS NULL) AS nulled, "
    "COUNT(*) FILTER (WHERE country IS NULL) AS missing FROM s_users)"))(
    lambda s, d: analysis.attribute_null_rates(layers(s, d).users))


def _round(s, d):
    """A whole lookup round into a fresh folder under the shared checkpoint folder."""
    from folio.session import scratch_path

    lay = layers(s, d)
    out = scratch_path(s, "enrichment", "lookup")
    return enrichment.run_round(s, lay.raw_ratings, lay.raw_books, bridge.lookup_answers(s, d), out)


register("enrich_round", O.with_ctes(
    "SELECT t.target, COUNT(*) AS keys_total, COUNT(*) FILTER (WHERE a.isbn IS NOT NULL) AS keys_found, "
    f"{R('100 * COUNT(*) FILTER (WHERE a.isbn IS NOT NULL) / COUNT(*)', 1)} AS found_pct "
    "FROM e_targets t LEFT JOIN (SELECT DISTINCT CASE WHEN p % 20 = 10 THEN lower(k) ELSE k END AS isbn "
    "FROM b_lookup_base WHERE p % 7 <> 0) a ON t.isbn = a.isbn GROUP BY t.target", O.ENRICH_CTES))(_round)
