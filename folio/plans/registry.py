"""Registered queries: name -> Spark builder ``(spark, sf_dir) -> DataFrame`` and the
DuckDB oracle SQL for the same result (or none for operators that SQL cannot express).

Spark outputs drop processing-time columns (``_ingested_at``, ``_transformed_at``),
which are non-deterministic, and show arrays as text so both engines hash alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio import oracle as O
from folio.plans.model import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    return Layers(spark, sf_dir)


_SILVER_BOOK_COLS = "isbn, title, author, year_of_publication, publisher, image_url, _source_file, source"

# ------------------------------------------------------------------ silver
register("silver_ratings", O.with_ctes("SELECT user_id, isbn, rating, is_explicit, _source_file FROM s_ratings"))(
    lambda s, d: layers(s, d).ratings.select("user_id", "isbn", "rating", "is_explicit", "_source_file"))

register("quarantine_ratings", O.with_ctes("SELECT user_id, isbn, rating, _source_file, reason FROM s_quarantine_ratings"))(
    lambda s, d: layers(s, d).quarantine_ratings.select("user_id", "isbn", "rating", "_source_file", "reason"))

register("silver_books", O.with_ctes(f"SELECT {_SILVER_BOOK_COLS} FROM s_books"))(
    lambda s, d: layers(s, d).books.select(*[c.strip() for c in _SILVER_BOOK_COLS.split(",")]))

register("quarantine_books", O.with_ctes(
    'SELECT "ISBN", "Book-Title", "Book-Author", "Year-Of-Publication", "Publisher", "Image-URL-L", '
    '_rescued_data, _source_file, reason FROM s_quarantine_books'))(
    lambda s, d: layers(s, d).quarantine_books.drop("_ingested_at"))

register("silver_enrichment", O.with_ctes(
    "SELECT isbn, target, author_key, array_to_string(subjects, '|') AS subjects, pages FROM s_enrichment"))(
    lambda s, d: layers(s, d).enrichment.select(
        "isbn", "target", "author_key", F.array_join("subjects", "|").alias("subjects"), "pages"))

register("silver_users", O.with_ctes("SELECT user_id, age, city, state, country, _source_file FROM s_users"))(
    lambda s, d: layers(s, d).users.select("user_id", "age", "city", "state", "country", "_source_file"))

# ------------------------------------------------------------------ gold
register("v_books", O.with_ctes("SELECT * FROM v_books"))(lambda s, d: layers(s, d).v_books())
register("v_authors", O.with_ctes("SELECT * FROM v_authors"))(lambda s, d: layers(s, d).v_authors())
register("v_books_by_genre", O.with_ctes("SELECT * FROM v_books_by_genre"))(
    lambda s, d: layers(s, d).v_books_by_genre())
register("v_books_by_genre_distinct", O.with_ctes("SELECT * FROM v_books_by_genre_distinct"))(
    lambda s, d: layers(s, d).v_books_by_genre(distinct_tokens=True))
register("v_authors_by_year_publisher", O.with_ctes("SELECT * FROM v_authors_by_year_publisher"))(
    lambda s, d: layers(s, d).v_authors_by_year_publisher())
register("v_avg_rating_by_year", O.with_ctes("SELECT * FROM v_avg_rating_by_year"))(
    lambda s, d: layers(s, d).v_avg_rating_by_year())
register("v_kpi_summary", O.with_ctes("SELECT * FROM v_kpi_summary"))(lambda s, d: layers(s, d).v_kpi_summary())

# ------------------------------------------------------------------ serving
_TOP = "ORDER BY weighted_rating DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10"
_DS_SQL = {
    "ds_kpi": "SELECT * FROM v_kpi_summary",
    "ds_top_books": f"SELECT title, author, ratings_cnt, avg_rating, weighted_rating FROM v_books {_TOP}",
    "ds_popular": "SELECT title, author, readers_total, ratings_cnt, avg_rating FROM v_books "
                  "ORDER BY readers_total DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_top_authors": "SELECT author, ratings_cnt, avg_rating, weighted_rating FROM v_authors WHERE ratings_cnt >= 25 "
                      "ORDER BY weighted_rating DESC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_trend": "SELECT year_of_publication, avg_rating, ratings_cnt FROM v_avg_rating_by_year "
                "WHERE ratings_cnt >= 50 AND year_of_publication BETWEEN 1950 AND 2004 ORDER BY year_of_publication",
    "ds_top_by_period": "SELECT title, author, year_of_publication, ratings_cnt, weighted_rating FROM v_books "
                        f"WHERE year_of_publication BETWEEN 1990 AND 2004 {_TOP}",
    "ds_genres": "SELECT genre, CAST(SUM(ratings_cnt) AS BIGINT) AS cnt FROM v_books_by_genre GROUP BY genre "
                 "ORDER BY cnt DESC NULLS LAST, genre ASC NULLS LAST LIMIT 100",
    "ds_top_by_genre": "SELECT genre, title, author, ratings_cnt, weighted_rating FROM v_books_by_genre "
                       f"WHERE genre = 'Fiction' {_TOP}",
}
_DS_SQL["ds_year_bounds"] = ("SELECT MIN(year_of_publication) AS min_year, MAX(year_of_publication) AS max_year "
                             f"FROM ({_DS_SQL['ds_trend']}) t")
_DS_SQL["ds_genre_options"] = f"SELECT DISTINCT genre FROM ({_DS_SQL['ds_genres']}) t"

for _name, _sql in _DS_SQL.items():
    register(_name, O.with_ctes(_sql))((lambda n: lambda s, d: layers(s, d).dataset(n))(_name))


# ------------------------------------------------------------------ serving through SQL with bound parameters
def _serving_sql(name: str, **args):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from folio.operators.serving import run_serving_sql

        lay = layers(spark, sf_dir)
        # Views registered session-wide; spark.sql analyses eagerly, so the returned frame is
        # bound to these definitions even if they are replaced later.
        lay.v_books().createOrReplaceGlobalTempView("v_books")
        lay.v_books_by_genre().createOrReplaceGlobalTempView("v_books_by_genre")
        return run_serving_sql(spark, name, "global_temp", **args)
    return run


register("ds_top_by_period_sql", O.with_ctes(_DS_SQL["ds_top_by_period"].replace("1990", "1980")))(
    _serving_sql("ds_top_by_period", year_min=1980, year_max=2004))
register("ds_top_by_genre_sql", O.with_ctes(_DS_SQL["ds_top_by_genre"].replace("'Fiction'", "'Small'")))(
    _serving_sql("ds_top_by_genre", genre="Small"))
