"""Data-profiling questions over the raw (bronze) feeds.

Each answer is an aggregate; none brings rows to the driver. Where the reference uses a
window over an aggregate for a share of the total, the total is a scalar subquery over
the grouped rows (one value, one scan), so no single-partition window is needed however
many groups there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import normalize_key, parse_age

# Fixed values of the profiling questions.
AGE_PROFILE_BOUNDS = (5, 110)
DEFAULT_AUTHOR_PATTERN = "%rowling%"


def _c(name: str):
    return F.col(f"`{name}`")


def rating_distribution(raw_ratings: DataFrame) -> DataFrame:
    """Raw grade value -> count and percent of all rows."""
    counts = raw_ratings.groupBy(_c("Book-Rating").alias("rating")).agg(F.count(F.lit(1)).alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()  # over the same grouped rows, whose exchange is used twice
    return (counts.select("rating", "cnt", F.round(F.lit(100) * F.col("cnt") / total, 2).alias("pct"))
            .orderBy(F.col("rating").try_cast("int").asc_nulls_first(), F.col("rating").asc_nulls_first()))


def orphan_ratings(raw_ratings: DataFrame, raw_books: DataFrame) -> DataFrame:
    """Ratings whose normalised key has no primary catalogue row (counted per key first)."""
    per_key = raw_ratings.groupBy(normalize_key(_c("ISBN")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    keys = raw_books.select(normalize_key(_c("ISBN")).alias("k"))
    return (per_key.join(keys, "k", "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_ratings")))


def year_range(raw_books: DataFrame, as_of_year=None) -> DataFrame:
    """Min/max year, zeros, future years and non-numeric (NULL counts as non-numeric)."""
    y = _c("Year-Of-Publication").try_cast("int")
    now = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return raw_books.agg(
        F.min(y).alias("min_year"), F.max(y).alias("max_year"),
        F.count_if(_c("Year-Of-Publication") == "0").alias("year_zero"),
        F.count_if(y > now).alias("future"),
        F.count_if(y.isNull()).alias("non_numeric"))


def shifted_rows(raw_books: DataFrame) -> DataFrame:
    """Catalogue rows whose year is not an integer (NULL years included)."""
    return raw_books.where(_c("Year-Of-Publication").try_cast("int").isNull())


def duplicate_keys(raw_books: DataFrame) -> DataFrame:
    """Raw keys occurring more than once (no normalisation)."""
    return (raw_books.groupBy(_c("ISBN").alias("ISBN")).agg(F.count(F.lit(1)).alias("cnt"))
            .where(F.col("cnt") > 1).orderBy(F.col("cnt").desc(), F.col("ISBN").asc_nulls_last()))


def author_variants(raw_books: DataFrame, pattern: str = DEFAULT_AUTHOR_PATTERN) -> DataFrame:
    """Spellings matching a case-insensitive LIKE pattern, with their counts."""
    a = _c("Book-Author")
    return (raw_books.where(a.ilike(pattern)).groupBy(a.alias("Book-Author"))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.col("cnt").desc(), F.col("Book-Author").asc_nulls_last()))


def _age_profile(age) -> list:
    lo, hi = AGE_PROFILE_BOUNDS
    return [F.min(age).alias("min_age"), F.max(age).alias("max_age"),
            F.count_if(age.isNull()).alias("null_or_nonnumeric"),
            F.count_if((age < lo) | (age > hi)).alias("out_of_range")]


def age_range(raw_users: DataFrame) -> DataFrame:
    """Literal reproduction: TRY_CAST(Age AS INT) is NULL for decimal text such as '25.0'."""
    return raw_users.agg(*_age_profile(_c("Age").try_cast("int")))


def age_range_fixed(raw_users: DataFrame) -> DataFrame:
    """Same profile with the age parsed as a number first, then truncated."""
    return raw_users.agg(*_age_profile(parse_age(_c("Age"))))


def location_parts(raw_users: DataFrame) -> DataFrame:
    """Histogram of the number of comma-separated parts (trailing empties count)."""
    loc = _c("Location")
    parts = F.when(loc.isNotNull(), F.size(F.split(loc, ",", -1)))
    return (raw_users.groupBy(parts.alias("parts")).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.col("parts").asc_nulls_first()))


def key_detail(raw_books: DataFrame, isbn: str) -> DataFrame:
    """All raw catalogue rows of one key, as delivered (to inspect a duplicate found above)."""
    return raw_books.where(_c("ISBN") == F.lit(isbn))
