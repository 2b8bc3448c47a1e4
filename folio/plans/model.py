"""The pipeline as one lazily built set of DataFrames over a data folder.

``Layers(spark, sf_dir)`` derives the raw feeds from the driver tables (bronze shape),
then silver and gold exactly as the materialised pipeline does, but without writing
anything: each attribute is a DataFrame whose plan Catalyst optimises end to end
(filters pushed to the parquet scans, columns pruned). ``Layers.from_tables`` does the
same over already written bronze/silver tables, which is the production path.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import DEFAULT_M
from folio.operators import gold, serving, silver
from folio.sources import bridge


class Layers:
    """Raw feeds, silver frames and gold/serving builders of one data set."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, m: int = DEFAULT_M,
                 raw: dict[str, DataFrame] | None = None, clean: dict[str, DataFrame] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.m = m
        self._raw = raw or {}
        self._clean = clean or {}

    @classmethod
    def from_tables(cls, spark: SparkSession, clean: dict[str, DataFrame], m: int = DEFAULT_M) -> "Layers":
        """Layers over materialised silver tables (gold and serving read them)."""
        return cls(spark, None, m=m, clean=clean)

    def with_raw(self, raw: dict[str, DataFrame], sf_dir: str | None = None) -> "Layers":
        """The same silver/gold frames, with raw feeds (e.g. bronze tables) for profiling."""
        return Layers(self.spark, sf_dir or self.sf_dir, m=self.m, raw=raw, clean=self._clean)

    def _pick(self, name: str, build) -> DataFrame:
        return self._clean[name] if name in self._clean else build()

    # ---------------------------------------------------------------- bronze
    def _raw_feed(self, name: str, fn) -> DataFrame:
        if name in self._raw:
            return self._raw[name]
        return fn(self.spark, self.sf_dir)

    @cached_property
    def raw_ratings(self) -> DataFrame:
        return self._raw_feed("ratings", bridge.raw_ratings)

    @cached_property
    def raw_books(self) -> DataFrame:
        return self._raw_feed("books", bridge.raw_books)

    @cached_property
    def raw_lookup(self) -> DataFrame:
        return self._raw_feed("open_library", bridge.raw_lookup_records)

    @cached_property
    def raw_users(self) -> DataFrame:
        return self._raw_feed("users", bridge.raw_users)

    # ---------------------------------------------------------------- silver
    @cached_property
    def ratings(self) -> DataFrame:
        return self._pick("ratings", lambda: silver.silver_ratings(self.raw_ratings))

    @cached_property
    def quarantine_ratings(self) -> DataFrame:
        return self._pick("quarantine_ratings", lambda: silver.quarantine_ratings(self.raw_ratings))

    @cached_property
    def books(self) -> DataFrame:
        return self._pick("books", lambda: silver.silver_books(self.raw_books, self.raw_lookup))

    @cached_property
    def catalogue_keys(self) -> DataFrame:
        """(isbn, source) of the catalogue, for what needs no more than that."""
        if "books" in self._clean:
            return self._clean["books"].select("isbn", "source")
        return silver.catalogue_keys(self.raw_books, self.raw_lookup)

    @cached_property
    def quarantine_books(self) -> DataFrame:
        return self._pick("quarantine_books", lambda: silver.quarantine_books(self.raw_books))

    @cached_property
    def enrichment(self) -> DataFrame:
        return self._pick("book_enrichment", lambda: silver.silver_enrichment(self.raw_lookup))

    @cached_property
    def users(self) -> DataFrame:
        return self._pick("users", lambda: silver.silver_users(self.raw_users))

    # ---------------------------------------------------------------- gold
    @cached_property
    def stats(self) -> DataFrame:
        return self._pick("rating_stats", lambda: gold.rating_stats(self.ratings))

    def prior(self, column: str) -> DataFrame | None:
        """C from the materialised ``priors`` table when it exists (tables), else None."""
        if "priors" not in self._clean:
            return None
        return self._clean["priors"].select(F.col(column).alias("_c"))

    def v_books(self, m: int | None = None) -> DataFrame:
        return gold.v_books(self.ratings, self.books, m or self.m, stats=self.stats, prior=self.prior("c_books"))

    def v_authors(self, m: int | None = None) -> DataFrame:
        return gold.v_authors(self.ratings, self.books, m or self.m, stats=self.stats,
                              prior=self.prior("c_authors"))

    def v_books_by_genre(self, m: int | None = None, distinct_tokens: bool = False) -> DataFrame:
        return gold.v_books_by_genre(self.ratings, self.books, self.enrichment, m or self.m,
                                     distinct_tokens=distinct_tokens, stats=self.stats,
                                     prior=self.prior("c_books"))

    def v_authors_by_year_publisher(self) -> DataFrame:
        return gold.v_authors_by_year_publisher(self.ratings, self.books, stats=self.stats)

    def v_avg_rating_by_year(self) -> DataFrame:
        return gold.v_avg_rating_by_year(self.ratings, self.books, stats=self.stats)

    def v_kpi_summary(self) -> DataFrame:
        return gold.v_kpi_summary(self.ratings, self.catalogue_keys, stats=self.stats)

    # ---------------------------------------------------------------- serving
    def dataset(self, name: str, **args) -> DataFrame:
        if name == "ds_kpi":
            return serving.ds_kpi(self.v_kpi_summary())
        if name in ("ds_top_books", "ds_popular", "ds_top_by_period"):
            return getattr(serving, name)(self.v_books(), **args)
        if name == "ds_top_authors":
            return serving.ds_top_authors(self.v_authors(), **args)
        if name == "ds_trend":
            return serving.ds_trend(self.v_avg_rating_by_year(), **args)
        if name in ("ds_genres", "ds_top_by_genre"):
            return getattr(serving, name)(self.v_books_by_genre(), **args)
        if name == "ds_year_bounds":
            return serving.ds_year_bounds(self.dataset("ds_trend"))
        if name == "ds_genre_options":
            return serving.ds_genre_options(self.dataset("ds_genres"))
        raise KeyError(name)
