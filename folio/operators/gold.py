"""Gold: one view per grain, centred on the Bayesian weighted rating.

Every view joins ratings with the catalogue on ``isbn`` and then aggregates to a grain
that is a function of the catalogue row (book, author, genre, year, ...). All aggregates
used are decomposable (counts, sums, min, max), so the ratings are first summarised per
key (``rating_stats``), with a map-side partial aggregate, and only that summary -- one
row per key -- meets the catalogue. Consequences at scale:

* the join input shrinks from "all interactions" to "distinct keys";
* a hot key (one book holding a third of all ratings) is collapsed on every mapper before
  the shuffle instead of landing in one join task;
* ``COUNT(DISTINCT isbn)`` becomes a plain count of summary rows (keys are unique in the
  catalogue), so no distinct-aggregation expand is needed;
* the population mean C is ``sum / count`` over the joined summary: exact, because the
  grades are integers; it is a global partial aggregate over the join input, not a
  second grouping, and the join's exchanges are reused (or absent when bucketed).

C is a one-row aggregate attached as a scalar subquery (evaluated once, inlined as a value),
never joined. The catalogue side is never force-broadcast: AQE and
``autoBroadcastJoinThreshold`` decide from measured sizes, with sort-merge join beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.functions import DEFAULT_M, genre_label, is_genre_token, ratio, weighted_rating


def rating_stats(ratings: DataFrame) -> DataFrame:
    """Per key: all interactions, explicit grades and their sum (one row per ``isbn``)."""
    return ratings.groupBy("isbn").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col("is_explicit")).alias("n_explicit"),
        F.sum(F.when(F.col("is_explicit"), F.col("rating"))).alias("sum_explicit"),
    )


def _prior(frame: DataFrame, n: str, s: str) -> DataFrame:
    """One-row frame holding C = sum of grades / number of grades."""
    return frame.agg(ratio(F.sum(s), F.sum(n)).alias("_c"))


def _with_prior(frame: DataFrame, prior: DataFrame) -> DataFrame:
    """Attach C as a scalar subquery: computed once, inlined as a value (no join)."""
    return frame.withColumn("_c", prior.scalar())


def priors(stats: DataFrame, books: DataFrame) -> DataFrame:
    """One row with the population means C of the views, from one pass over the join:
    ``c_books`` (explicit grades of catalogued books: v_books, v_books_by_genre) and
    ``c_authors`` (explicit grades of books with an author: v_authors)."""
    joined = stats.join(books.select("isbn", "author"), "isbn")
    authored = F.col("author").isNotNull()
    return joined.agg(
        ratio(F.sum("sum_explicit"), F.sum("n_explicit")).alias("c_books"),
        ratio(F.sum(F.when(authored, F.col("sum_explicit"))), F.sum(F.when(authored, F.col("n_explicit"))))
        .alias("c_authors"))


def v_books(ratings: DataFrame, books: DataFrame, m: int = DEFAULT_M, stats: DataFrame | None = None,
            prior: DataFrame | None = None) -> DataFrame:
    """Grain (title, author): editions merged on text identity, year = MIN over editions.
    ``prior``: a one-row frame holding C (e.g. from the ``priors`` table); computed if absent."""
    stats = rating_stats(ratings) if stats is None else stats
    joined = stats.join(books.select("isbn", "title", "author", "year_of_publication", "image_url"), "isbn")
    per_book = joined.groupBy("title", "author").agg(
        F.min("year_of_publication").alias("year_of_publication"),
        F.count(F.lit(1)).alias("editions"),
        F.sum("n_all").alias("readers_total"),
        F.sum("n_explicit").alias("ratings_cnt"),
        F.sum("sum_explicit").alias("_sum"),
        F.max("image_url").alias("image_url"),
    )
    avg = ratio("_sum", "ratings_cnt")
    # C straight from the joined key summary: a global partial aggregate, no regrouping.
    prior = prior if prior is not None else _prior(joined, "n_explicit", "sum_explicit")
    return _with_prior(per_book, prior).select(
        "title", "author", "year_of_publication", "editions", "readers_total", "ratings_cnt",
        F.round(avg, 2).alias("avg_rating"),
        weighted_rating("ratings_cnt", avg, "_c", m).alias("weighted_rating"),
        "image_url",
    )


def _explicit_stats(ratings: DataFrame, stats: DataFrame | None) -> DataFrame:
    stats = rating_stats(ratings) if stats is None else stats
    return stats.where(F.col("n_explicit") > 0)


def v_authors(ratings: DataFrame, books: DataFrame, m: int = DEFAULT_M, stats: DataFrame | None = None,
              prior: DataFrame | None = None) -> DataFrame:
    """Grain author (NULL authors excluded); C over explicit grades of authored books."""
    joined = _explicit_stats(ratings, stats).join(
        books.where(F.col("author").isNotNull()).select("isbn", "author"), "isbn")
    per_author = joined.groupBy("author").agg(
        F.sum("n_explicit").alias("ratings_cnt"), F.sum("sum_explicit").alias("_sum"))
    avg = ratio("_sum", "ratings_cnt")
    prior = prior if prior is not None else _prior(joined, "n_explicit", "sum_explicit")
    return _with_prior(per_author, prior).select(
        "author", "ratings_cnt", F.round(avg, 2).alias("avg_rating"),
        weighted_rating("ratings_cnt", avg, "_c", m).alias("weighted_rating"))


def genre_tokens(subjects_col: str = "subjects", distinct: bool = False):
    """Subject headings -> genre labels: split on ',', drop blanks and stop words.

    Without ``distinct`` a label occurring in two headings of a book is kept twice, which
    counts each of its ratings twice for that genre (the reference's semantics).
    """
    tokens = F.flatten(F.transform(F.col(subjects_col), lambda s: F.split(s, ",", -1)))
    labels = F.transform(F.filter(tokens, is_genre_token), genre_label)
    return F.array_distinct(labels) if distinct else labels


def v_books_by_genre(ratings: DataFrame, books: DataFrame, enrichment: DataFrame, m: int = DEFAULT_M,
                     distinct_tokens: bool = False, stats: DataFrame | None = None,
                     prior: DataFrame | None = None) -> DataFrame:
    """Grain (genre, title, author). C covers all explicit grades of catalogued books."""
    explicit = _explicit_stats(ratings, stats).join(books.select("isbn", "title", "author"), "isbn")
    prior = prior if prior is not None else _prior(explicit, "n_explicit", "sum_explicit")
    tagged = (explicit.join(enrichment.select("isbn", "subjects"), "isbn")
              .select("title", "author", "n_explicit", "sum_explicit",
                      F.explode(genre_tokens(distinct=distinct_tokens)).alias("genre")))
    per = tagged.groupBy("genre", "title", "author").agg(
        F.sum("n_explicit").alias("ratings_cnt"), F.sum("sum_explicit").alias("_sum"))
    avg = ratio("_sum", "ratings_cnt")
    return _with_prior(per, prior).select(
        "genre", "title", "author", "ratings_cnt", F.round(avg, 2).alias("avg_rating"),
        weighted_rating("ratings_cnt", avg, "_c", m).alias("weighted_rating"))


def v_authors_by_year_publisher(ratings: DataFrame, books: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Grain (author, year, publisher): explicit grades and their mean; NULL authors excluded."""
    joined = _explicit_stats(ratings, stats).join(
        books.where(F.col("author").isNotNull()).select("isbn", "author", "year_of_publication", "publisher"),
        "isbn")
    return joined.groupBy("author", "year_of_publication", "publisher").agg(
        F.sum("n_explicit").alias("ratings_cnt"),
        F.round(ratio(F.sum("sum_explicit"), F.sum("n_explicit")), 2).alias("avg_rating"))


def v_avg_rating_by_year(ratings: DataFrame, books: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Grain publication year: rated editions, explicit grades and their mean."""
    joined = _explicit_stats(ratings, stats).join(
        books.where(F.col("year_of_publication").isNotNull()).select("isbn", "year_of_publication"), "isbn")
    return joined.groupBy("year_of_publication").agg(
        F.count(F.lit(1)).alias("books_cnt"),          # distinct keys with >= 1 grade
        F.sum("n_explicit").alias("ratings_cnt"),
        F.round(ratio(F.sum("sum_explicit"), F.sum("n_explicit")), 2).alias("avg_rating"))


def v_kpi_summary(ratings: DataFrame, books: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row. Ratings are matched to the catalogue with a left join over the key summary."""
    stats = rating_stats(ratings) if stats is None else stats
    cat = books.select("isbn", "source").withColumn("_has_book", F.lit(True))
    r = stats.join(cat, "isbn", "left")
    has_book = F.coalesce(F.col("_has_book"), F.lit(False))
    interactions = r.agg(
        F.sum("n_all").alias("interactions_total"),
        F.sum("n_explicit").alias("ratings_explicit"),
        F.sum("sum_explicit").alias("_sum"),
        F.sum(F.when(has_book & (F.col("source") == "open_library"), F.col("n_all")).otherwise(0))
        .alias("ratings_recovered"),
        F.sum(F.when(~has_book, F.col("n_all")).otherwise(0)).alias("ratings_orphaned"),
    )
    # Catalogue counts as one scalar subquery (a struct), like the reference's SELECT-list subqueries.
    catalog = books.agg(F.struct(F.count(F.lit(1)).alias("n"),
                                 F.count_if(F.col("source") == "open_library").alias("recovered"))).scalar()
    return interactions.select(
        catalog.getField("n").alias("books_in_catalog"), catalog.getField("recovered").alias("books_recovered"),
        "interactions_total", "ratings_explicit",
        F.round(F.lit(100) * (F.lit(1) - ratio("ratings_explicit", "interactions_total")), 1).alias("implicit_pct"),
        F.round(ratio("_sum", "ratings_explicit"), 2).alias("avg_rating_explicit"),
        "ratings_recovered", "ratings_orphaned")
