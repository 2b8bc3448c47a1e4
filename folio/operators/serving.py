"""Serving datasets: the dashboard queries over the gold views, with their parameters.

Ordering, limits and parameters belong here, not in the views. Parameters are applied
before the limit. Every top-k orders by its metric and then by the grain columns, so the
row at rank k is well defined; ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject,
a per-partition top-k merged on the driver side of the plan (k rows, bounded).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Dashboard thresholds and parameter defaults.
TOP_N = 10
GENRE_TOP_N = 100
AUTHOR_MIN_RATINGS = 25
TREND_MIN_RATINGS = 50
TREND_YEARS = (1950, 2004)
DEFAULT_YEAR_RANGE = (1990, 2004)
DEFAULT_GENRE = "Fiction"


def _desc(c: str):
    return F.col(c).desc_nulls_last()


def _asc(c: str):
    return F.col(c).asc_nulls_last()


def ds_kpi(kpi: DataFrame) -> DataFrame:
    """DS-1: the KPI row as is."""
    return kpi.select("*")


def ds_top_books(books_view: DataFrame, n: int = TOP_N) -> DataFrame:
    """DS-2: top books by weighted rating (no support threshold)."""
    return (books_view.select("title", "author", "ratings_cnt", "avg_rating", "weighted_rating")
            .orderBy(_desc("weighted_rating"), _asc("title"), _asc("author")).limit(n))


def ds_popular(books_view: DataFrame, n: int = TOP_N) -> DataFrame:
    """DS-3: most read books (all interactions, implicit included)."""
    return (books_view.select("title", "author", "readers_total", "ratings_cnt", "avg_rating")
            .orderBy(_desc("readers_total"), _asc("title"), _asc("author")).limit(n))


def ds_top_authors(authors_view: DataFrame, n: int = TOP_N, min_ratings: int = AUTHOR_MIN_RATINGS) -> DataFrame:
    """DS-4: top authors by weighted rating among those with enough grades."""
    return (authors_view.where(F.col("ratings_cnt") >= min_ratings)
            .select("author", "ratings_cnt", "avg_rating", "weighted_rating")
            .orderBy(_desc("weighted_rating"), _asc("author")).limit(n))


def ds_trend(year_view: DataFrame, min_ratings: int = TREND_MIN_RATINGS, years: tuple = TREND_YEARS) -> DataFrame:
    """DS-5: mean grade per publication year, well-supported years of the trend window."""
    return (year_view.where((F.col("ratings_cnt") >= min_ratings)
                            & F.col("year_of_publication").between(*years))
            .select("year_of_publication", "avg_rating", "ratings_cnt")
            .orderBy(_asc("year_of_publication")))


def ds_top_by_period(books_view: DataFrame, year_min: int = DEFAULT_YEAR_RANGE[0],
                     year_max: int = DEFAULT_YEAR_RANGE[1], n: int = TOP_N) -> DataFrame:
    """DS-6: top books published within a year range (parameters applied before the limit)."""
    return (books_view.where(F.col("year_of_publication").between(year_min, year_max))
            .select("title", "author", "year_of_publication", "ratings_cnt", "weighted_rating")
            .orderBy(_desc("weighted_rating"), _asc("title"), _asc("author")).limit(n))


def ds_genres(genre_view: DataFrame, n: int = GENRE_TOP_N) -> DataFrame:
    """DS-7: genres by total grades (the genre picker's options, top 100)."""
    return (genre_view.groupBy("genre").agg(F.sum("ratings_cnt").alias("cnt"))
            .orderBy(_desc("cnt"), _asc("genre")).limit(n))


def ds_top_by_genre(genre_view: DataFrame, genre: str = DEFAULT_GENRE, n: int = TOP_N) -> DataFrame:
    """DS-8: top books within one genre."""
    return (genre_view.where(F.col("genre") == F.lit(genre))
            .select("genre", "title", "author", "ratings_cnt", "weighted_rating")
            .orderBy(_desc("weighted_rating"), _asc("title"), _asc("author")).limit(n))


def for_display(top: DataFrame, column: str) -> DataFrame:
    """Re-sort an already limited top list ascending for a bar chart (same rows)."""
    return top.orderBy(F.col(column).asc_nulls_first())


def ds_year_bounds(trend: DataFrame) -> DataFrame:
    """DS-9: bounds of the year-range control, over the trend dataset."""
    return trend.agg(F.min("year_of_publication").alias("min_year"),
                     F.max("year_of_publication").alias("max_year"))


def ds_genre_options(genres: DataFrame) -> DataFrame:
    """DS-10: distinct genres of the genre dataset."""
    return genres.select("genre").distinct()


# The same datasets as SQL text over registered views, with named parameter markers
# bound through ``spark.sql(sql, args=...)`` (parameters are values, never spliced text).
SERVING_SQL = {
    "ds_kpi": "SELECT * FROM {db}.v_kpi_summary",
    "ds_top_books": "SELECT title, author, ratings_cnt, avg_rating, weighted_rating FROM {db}.v_books "
                    "ORDER BY weighted_rating DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_popular": "SELECT title, author, readers_total, ratings_cnt, avg_rating FROM {db}.v_books "
                  "ORDER BY readers_total DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_top_authors": "SELECT author, ratings_cnt, avg_rating, weighted_rating FROM {db}.v_authors "
                      "WHERE ratings_cnt >= 25 ORDER BY weighted_rating DESC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_trend": "SELECT year_of_publication, avg_rating, ratings_cnt FROM {db}.v_avg_rating_by_year "
                "WHERE ratings_cnt >= 50 AND year_of_publication BETWEEN 1950 AND 2004 ORDER BY year_of_publication",
    "ds_top_by_period": "SELECT title, author, year_of_publication, ratings_cnt, weighted_rating FROM {db}.v_books "
                        "WHERE year_of_publication BETWEEN :year_min AND :year_max "
                        "ORDER BY weighted_rating DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10",
    "ds_genres": "SELECT genre, SUM(ratings_cnt) AS cnt FROM {db}.v_books_by_genre GROUP BY genre "
                 "ORDER BY cnt DESC NULLS LAST, genre ASC NULLS LAST LIMIT 100",
    "ds_top_by_genre": "SELECT genre, title, author, ratings_cnt, weighted_rating FROM {db}.v_books_by_genre "
                       "WHERE genre = :genre "
                       "ORDER BY weighted_rating DESC NULLS LAST, title ASC NULLS LAST, author ASC NULLS LAST LIMIT 10",
}

SERVING_DEFAULT_ARGS = {
    "ds_top_by_period": {"year_min": DEFAULT_YEAR_RANGE[0], "year_max": DEFAULT_YEAR_RANGE[1]},
    "ds_top_by_genre": {"genre": DEFAULT_GENRE},
}


def run_serving_sql(spark: SparkSession, name: str, db: str, **args) -> DataFrame:
    """Run one dataset against registered views with bound parameters."""
    params = dict(SERVING_DEFAULT_ARGS.get(name, {}))
    params.update(args)
    sql = SERVING_SQL[name].format(db=db)
    return spark.sql(sql, args=params) if params else spark.sql(sql)
