"""Analyses whose results the reference publishes without code.

Scale notes
* Exact quantiles are found by distributed selection, whatever the column;
  ``percentile`` would hold every value in one aggregation buffer.
* The top-1 % share is computed from a histogram (count -> number of users), which has
  at most as many rows as there are distinct counts, below sqrt(2 * ratings),
  so the one ordered window it needs is bounded no matter how many users exist.
* The m-sensitivity top lists are three bounded top-k's; ranks are numbered on those
  at most 3 * k rows only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions import ratio, valid_key
from folio.operators import gold
from folio.session import ensure_checkpoint_dir

# Fixed values of the analyses.
SENSITIVITY_M = (10, 25, 50)
TOP_USER_PERCENT = 1
SUPPORT_QUANTILES = (0.5, 0.99)
SELECT_ACCURACY = 10_000   # of the sketch that narrows a bracket
SELECT_ENOUGH = 50_000     # rows of a bracket that are sorted at once


def exact_quantiles(values: DataFrame, col: str, probs=SUPPORT_QUANTILES, accuracy: int = SELECT_ACCURACY, enough: int = SELECT_ENOUGH) -> DataFrame:
    """Continuous quantiles (linear interpolation, as ``quantile_cont``) of any numeric column; NULLs don't count.

    Distributed selection. Every wanted rank has a bracket of values that holds it, at first all of them. A pass over the
    values counts those below and inside each bracket, so the brackets are exact, and sketches where the rank
    lies in it, with an error of ``1 / accuracy``; the next bracket is the sketch's two bounds. Each pass narrows a bracket
    about ``accuracy / 4`` times, until it holds one value or at most ``enough`` rows, which are sorted. If a bound turns out wrong the
    bracket beside it is taken. Only counts and bounds reach the driver, never an unbounded group a task.
    """
    rows = values.select(F.col(f"`{col}`").alias("v")).where("v IS NOT NULL")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    spark = values.sparkSession
    names = [str(p).replace("0.", "p").replace(".", "_") for p in probs]
    schema = "groups long, " + ", ".join(f"q_{t} double" for t in names)
    if not n:
        return spark.createDataFrame([(0, *[None] * len(names))], schema)
    places = {p: p * (n - 1) for p in probs}
    found: dict[int, float] = {}
    # rank -> (least value, greatest value, open to the left, open to the right): the bracket that holds it
    brackets = {r: (low, high, False, False) for place in places.values() for r in (math.floor(place), math.ceil(place))}
    inside: dict[int, tuple[int, int]] = {r: (0, n) for r in brackets}  # values before the bracket, values in it
    while brackets:
        small = [r for r in brackets if inside[r][1] <= enough and brackets[r][0] != brackets[r][1]]
        for r in small:
            held = rows.where(_in_bracket(brackets[r])).orderBy("v").collect()  # at most ``enough`` rows
            found[r] = held[r - inside[r][0]].v
        for r in [r for r in brackets if brackets[r][0] == brackets[r][1]]:
            found[r] = brackets[r][0]
        brackets = {r: b for r, b in brackets.items() if r not in found}
        if not brackets:
            break
        guesses = [F.percentile_approx(F.when(_in_bracket(b), F.col("v")), [min(1.0, max(0.0, (r - inside[r][0]) / inside[r][1] + d * 2 / accuracy)) for d in (-1, 1)], accuracy).alias(f"g{r}")
                   for r, b in brackets.items()]
        guess = rows.agg(*guesses).first()
        counts = []
        for r, b in brackets.items():
            a, z = guess[f"g{r}"]
            counts += [F.count_if(_in_bracket(b) & (F.col("v") < F.lit(a))).alias(f"b{r}"), F.count_if(_in_bracket(b) & F.col("v").between(a, z)).alias(f"i{r}"),
                       F.count_if(_in_bracket(b) & (F.col("v") == F.lit(a))).alias(f"e{r}")]
        counted = rows.agg(*counts).first()
        for r, b in list(brackets.items()):
            a, z = guess[f"g{r}"]
            start, size = inside[r]
            below, within = counted[f"b{r}"], counted[f"i{r}"]
            if r < start + below:
                brackets[r], inside[r] = (b[0], a, b[2], True), (start, below)
            elif r >= start + below + within:
                brackets[r], inside[r] = (z, b[1], True, b[3]), (start + below + within, size - below - within)
            elif a != z and r < start + below + counted[f"e{r}"]:
                brackets[r], inside[r] = (a, a, False, False), (start + below, counted[f"e{r}"])
            elif a != z:  # past the rows of the lower bound, so even a bracket of two crowded values gets narrower
                brackets[r], inside[r] = (a, z, True, False), (start + below + counted[f"e{r}"], within - counted[f"e{r}"])
            else:
                brackets[r], inside[r] = (a, z, False, False), (start + below, within)
    out = []
    for p in probs:
        lo, hi = found[math.floor(places[p])], found[math.ceil(places[p])]
        out.append(float(lo) + (float(hi) - float(lo)) * (places[p] - math.floor(places[p])))
    return spark.createDataFrame([(n, *out)], schema).select("groups", *[F.round(f"q_{t}", 3).alias(f"q_{t}") for t in names])


def _in_bracket(bracket: tuple):
    """Values of a bracket; NaN is the greatest value, as in Spark's order."""
    low, high, left_open, right_open = bracket
    v = F.col("v")
    return (v > F.lit(low) if left_open else v >= F.lit(low)) & (v < F.lit(high) if right_open else v <= F.lit(high))


def support_quantiles(books_view: DataFrame) -> DataFrame:
    """Median and p99 of explicit grades per rated book (title x author).

    The counts are written once: each pass of the selection reads them, and none joins and groups the ratings again.
    """
    rated = books_view.where(F.col("ratings_cnt") > 0).select(F.col("ratings_cnt").cast("double").alias("v"))
    ensure_checkpoint_dir(rated.sparkSession)
    rated = rated.checkpoint(eager=True)
    q = exact_quantiles(rated, "v")
    return q.select(F.col("groups").alias("rated_books"), F.col("q_p5").alias("median_ratings"),
                    F.col("q_p99").alias("p99_ratings"))


def m_sensitivity(ratings: DataFrame, books: DataFrame, ms=SENSITIVITY_M, k: int = 10,
                  stats: DataFrame | None = None, prior: DataFrame | None = None) -> DataFrame:
    """Top-k books under several shrinkage values m; one bounded top-k per m."""
    tops = []
    for m in ms:
        view = gold.v_books(ratings, books, m, stats=stats, prior=prior)
        top = (view.orderBy(F.col("weighted_rating").desc_nulls_last(), F.col("title").asc_nulls_last(),
                            F.col("author").asc_nulls_last()).limit(k)
               .select(F.lit(m).alias("m"), "title", "author", "ratings_cnt", "weighted_rating"))
        tops.append(top)
    union = tops[0]
    for t in tops[1:]:
        union = union.unionByName(t)
    rank = Window.partitionBy("m").orderBy(F.col("weighted_rating").desc_nulls_last(),
                                           F.col("title").asc_nulls_last(), F.col("author").asc_nulls_last())
    return union.withColumn("rank", F.row_number().over(rank))   # at most len(ms) * k rows


def top_user_share(ratings: DataFrame, percent: int = TOP_USER_PERCENT) -> DataFrame:
    """Share of all interactions made by the top ``percent`` % of users (k = ceil(users * percent / 100),
    in integer arithmetic so no rounding of 0.01 can move k)."""
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"))
    hist = per_user.groupBy("cnt").agg(F.count(F.lit(1)).alias("users"))
    totals = hist.agg(F.struct(F.sum("users").alias("n_users"),
                               F.sum(F.col("cnt") * F.col("users")).alias("n_ratings"))).scalar()
    upto = Window.orderBy(F.col("cnt").desc()).rowsBetween(Window.unboundedPreceding, 0)   # bounded histogram
    cum = (hist.withColumn("_cum", F.sum("users").over(upto))
           .withColumn("n_users", totals.getField("n_users")).withColumn("n_ratings", totals.getField("n_ratings"))
           .withColumn("k", F.expr(f"(n_users * {int(percent)} + 99) div 100")))
    take = F.greatest(F.lit(0), F.least(F.col("users"), F.col("k") - (F.col("_cum") - F.col("users"))))
    agg = cum.agg(F.first("n_users").alias("users"), F.first("k").alias("top_users"),
                  F.first("n_ratings").alias("ratings"), F.sum(take * F.col("cnt")).alias("top_users_ratings"))
    return agg.withColumn("top_share_pct",
                          F.round(F.lit(100) * ratio("top_users_ratings", "ratings"), 1))


def multi_edition_groups(books_view: DataFrame) -> DataFrame:
    """Books (title x author) and how many of them merge more than one edition."""
    return books_view.agg(F.count(F.lit(1)).alias("books"),
                          F.count_if(F.col("editions") > 1).alias("multi_edition_groups"))


def orphan_recovery(ratings: DataFrame, books: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Orphans before (not in the primary catalogue) and after the secondary source, and
    how many remaining orphans cannot be looked up because of their key format."""
    stats = gold.rating_stats(ratings) if stats is None else stats
    r = stats.join(books.select("isbn", "source"), "isbn", "left")
    src = F.col("source")
    agg = r.agg(
        F.sum(F.when(src.isNull() | (src == "open_library"), F.col("n_all")).otherwise(0)).alias("orphans_before"),
        F.sum(F.when(src.isNull(), F.col("n_all")).otherwise(0)).alias("orphans_after"),
        F.sum(F.when(src.isNull() & ~valid_key("isbn"), F.col("n_all")).otherwise(0)).alias("unrecoverable_format"))
    return agg.withColumn("rescued_pct", F.round(
        F.lit(100) * ratio(F.col("orphans_before") - F.col("orphans_after"), F.col("orphans_before")), 1))


def user_integrity(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Ratings whose user is missing from the users table (counted per user first)."""
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    known = users.select("user_id").distinct()
    missing = per_user.join(known, "user_id", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    total = per_user.agg(F.sum("n").alias("ratings_total")).withColumn("missing", missing)
    return total.select(
        "ratings_total", F.col("missing").alias("ratings_without_user"),
        F.round(F.lit(100) * (F.lit(1) - ratio("missing", "ratings_total")), 2).alias("integrity_pct"))


def attribute_null_rates(users: DataFrame) -> DataFrame:
    """Users, nulled ages (count and percent) and missing countries."""
    agg = users.agg(F.count(F.lit(1)).alias("users_total"),
                    F.count_if(F.col("age").isNull()).alias("age_nulled"),
                    F.count_if(F.col("country").isNull()).alias("country_missing"))
    return agg.select("users_total", "age_nulled",
                      F.round(F.lit(100) * ratio("age_nulled", "users_total"), 1).alias("age_null_pct"),
                      "country_missing")
