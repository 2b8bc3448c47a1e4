"""The gold views as SQL over one run's silver tables.

They compute what ``folio.operators.gold`` computes, from the materialised key summary ``rating_stats`` (bucketed with the
catalogue on ``isbn``) and the one-row ``priors`` table of the same run. ``try_divide`` keeps an empty population from raising
under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from folio.functions.text import GENRE_STOP_WORDS

MARK = "folio.gold_view"  # property of the views that this library made; such views under other names are superseded


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class GoldView:
    """A view: what a row is, what each column holds, and the query."""

    name: str
    grain: str
    columns: dict[str, str]
    body: str

    def ddl(self, gold_db: str, body: str | None = None) -> str:
        told = ", ".join(f"{c} COMMENT {_text(t)}" for c, t in self.columns.items())
        return (f"CREATE OR REPLACE VIEW {gold_db}.{self.name} ({told}) COMMENT {_text(self.grain)} "
                f"TBLPROPERTIES ('{MARK}' = '{self.name}') AS {body or self.body}")


def _shrunk(m: int, prior: str) -> str:
    """Mean of n grades with sum s, pulled towards the prior by m imaginary grades."""
    return f"ROUND((n / (n + {m})) * try_divide(s, n) + ({m} / (n + {m})) * {prior}, 3)"


def gold_views(table: Callable[[str], str], m: int = 25) -> dict[str, GoldView]:
    """The six views; ``table`` gives the full name of a silver table."""
    stats, books, enrichment, priors = (table(t) for t in ("rating_stats", "books", "book_enrichment", "priors"))
    rated = f"{stats} k JOIN {books} b ON k.isbn = b.isbn"
    graded = f"{rated} WHERE k.n_explicit > 0"
    mean = "ROUND(try_divide(s, n), 2)"
    stop = ", ".join(_text(w) for w in GENRE_STOP_WORDS)
    shrunk = f"mean shrunk towards the overall mean by {m} grades"
    views = [
        GoldView("v_books", "One row for each pair of title and author that was rated; its editions count together.", {
            "title": "Repaired title", "author": "Author in normal form, a text and not an identifier",
            "year_of_publication": "Earliest valid year among the rated editions, if any", "editions": "How many rated keys share title and author",
            "readers_total": "Interactions of any kind; orders by popularity", "ratings_cnt": "Grades above zero",
            "avg_rating": "Mean of those grades, empty without any", "weighted_rating": f"Orders by quality: {shrunk}", "image_url": "Picture of one edition"},
            f"SELECT title, author, year_of_publication, editions, readers_total, n AS ratings_cnt, {mean} AS avg_rating, "
            f"{_shrunk(m, f'(SELECT c_books FROM {priors})')} AS weighted_rating, image_url FROM ("
            "SELECT b.title, b.author, MIN(b.year_of_publication) AS year_of_publication, COUNT(*) AS editions, SUM(k.n_all) AS readers_total, "
            f"SUM(k.n_explicit) AS n, SUM(k.sum_explicit) AS s, MAX(b.image_url) AS image_url FROM {rated} GROUP BY b.title, b.author)"),
        GoldView("v_authors", "One row for each author with at least one grade.", {
            "author": "Author in normal form", "ratings_cnt": "Grades above zero on any book of the author",
            "avg_rating": "Mean of those grades", "weighted_rating": f"Orders by quality: {shrunk}; steadier with 25 grades or more"},
            f"SELECT author, n AS ratings_cnt, {mean} AS avg_rating, {_shrunk(m, f'(SELECT c_authors FROM {priors})')} AS weighted_rating FROM ("
            f"SELECT b.author, SUM(k.n_explicit) AS n, SUM(k.sum_explicit) AS s FROM {graded} AND b.author IS NOT NULL GROUP BY b.author)"),
        # subject headings are cut at commas into genre labels, by one generator for each enriched key
        GoldView("v_books_by_genre", "One row for each genre label of a graded book; only looked-up books have labels.", {
            "genre": "Label from the book's subject headings; general words are left out", "title": "Repaired title", "author": "Author in normal form",
            "ratings_cnt": "Grades above zero, counted for every time the label occurs", "avg_rating": "Mean of those grades",
            "weighted_rating": f"Orders within a genre: {shrunk}"},
            f"SELECT genre, title, author, n AS ratings_cnt, {mean} AS avg_rating, {_shrunk(m, f'(SELECT c_books FROM {priors})')} AS weighted_rating FROM ("
            "SELECT genre, title, author, SUM(n_explicit) AS n, SUM(sum_explicit) AS s FROM ("
            "SELECT g.title, g.author, g.n_explicit, g.sum_explicit, explode(transform(filter(flatten(transform(l.subjects, h -> split(h, ',', -1))), "
            f"w -> trim(w) <> '' AND lower(trim(w)) NOT IN ({stop})), w -> initcap(trim(w)))) AS genre "
            f"FROM (SELECT k.isbn, k.n_explicit, k.sum_explicit, b.title, b.author FROM {graded}) g JOIN {enrichment} l ON g.isbn = l.isbn) "
            "GROUP BY genre, title, author)"),
        GoldView("v_authors_by_year_publisher", "One row for each author, year and publisher that got a grade.", {
            "author": "Author in normal form", "year_of_publication": "Valid year of the editions, or empty", "publisher": "Publisher after repair",
            "ratings_cnt": "Grades above zero", "avg_rating": "Mean of those grades; a few grades say little"},
            f"SELECT author, year_of_publication, publisher, n AS ratings_cnt, {mean} AS avg_rating FROM ("
            f"SELECT b.author, b.year_of_publication, b.publisher, SUM(k.n_explicit) AS n, SUM(k.sum_explicit) AS s FROM {graded} AND b.author IS NOT NULL "
            "GROUP BY b.author, b.year_of_publication, b.publisher)"),
        GoldView("v_avg_rating_by_year", "One row for each valid year with a grade; of old years only lasting books are read.", {
            "year_of_publication": "Valid year of the editions", "books_cnt": "Keys of that year with a grade", "ratings_cnt": "Grades above zero on them",
            "avg_rating": "Mean over the grades, so a much-graded book weighs more"},
            f"SELECT year_of_publication, books_cnt, n AS ratings_cnt, {mean} AS avg_rating FROM ("
            f"SELECT b.year_of_publication, COUNT(*) AS books_cnt, SUM(k.n_explicit) AS n, SUM(k.sum_explicit) AS s FROM {graded} "
            "AND b.year_of_publication IS NOT NULL GROUP BY b.year_of_publication)"),
        GoldView("v_kpi_summary", "One row for everything.", {
            "books_in_catalog": "Keys in the catalogue, of either source", "books_recovered": "Of these, keys that only the lookup source knows",
            "interactions_total": "Accepted rows of the ratings feed", "ratings_explicit": "Of these, grades above zero",
            "implicit_pct": "Percentage of the others", "avg_rating_explicit": "Mean grade, whether or not the key is in the catalogue",
            "ratings_recovered": "Interactions with keys of the lookup source", "ratings_orphaned": "Interactions with keys of no source"},
            f"SELECT (SELECT COUNT(*) FROM {books}) AS books_in_catalog, (SELECT COUNT_IF(source = 'open_library') FROM {books}) AS books_recovered, "
            "every AS interactions_total, n AS ratings_explicit, ROUND(100 * (1 - try_divide(n, every)), 1) AS implicit_pct, "
            f"{mean} AS avg_rating_explicit, recovered AS ratings_recovered, orphaned AS ratings_orphaned FROM ("
            "SELECT SUM(k.n_all) AS every, SUM(k.n_explicit) AS n, SUM(k.sum_explicit) AS s, "
            "SUM(IF(b.source = 'open_library', k.n_all, 0)) AS recovered, SUM(IF(b.isbn IS NULL, k.n_all, 0)) AS orphaned "
            f"FROM {stats} k LEFT JOIN {books} b ON k.isbn = b.isbn)"),
    ]
    return {v.name: v for v in views}
