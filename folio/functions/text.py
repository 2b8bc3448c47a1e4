"""Cleaning rules as native column expressions.

Every function maps ``Column -> Column`` without any Python UDF. A value that a rule
needs more than once is bound by ``let``, so each step stands once in the plan and runs
once a row however the rules are nested.
comments note where Java and Python regex/number parsing differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's rules.
# ---------------------------------------------------------------------------
YEAR_MIN, YEAR_MAX = 1450, 2004          # valid publication years, inclusive
AGE_MIN, AGE_MAX = 5, 100                # valid ages, inclusive
LOCATION_PLACEHOLDERS = ["", "n/a", "-", "unknown"]   # a location part meaning "not filled in"
LOCATION_JUNK = r'[\\")(]'               # characters deleted from a location part: \ " ) (
KEY_FORMAT = r"\A[0-9X]{10}\z"           # lookup key: ten characters, each a digit or X
GENRE_STOP_WORDS = ["general", "etc", "etc."]   # subject tokens that are not genres
PUBLISH_YEAR_PATTERN = r"(\d{4})"        # first run of four digits in a free-text date
# Author spelling rules, applied in this order (Java regex; (?U) = Unicode classes like Python's re):
AUTHOR_DOTS = (r"(?U)\s*\.\s*", ". ")   # any spacing around a dot becomes ". "
AUTHOR_LONE_INITIAL = (r"(?<![\p{L}\p{N}_])([A-Za-z])(?![\p{L}\p{N}_])(?![.'])", "$1.")   # lone letter gets a dot
AUTHOR_SPACES = (r"(?U)\s+", " ")        # whitespace runs collapse to one space

_WS_EDGES = r"(?U)^\s+|\s+$"             # Unicode whitespace at either end (Python str.strip)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: a one-element array, transformed.

    The optimiser copies an expression to each place that uses it; a lambda's variable is not copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_key(c) -> Column:
    """Key identity: UPPER(TRIM(x)); TRIM removes spaces only, like the reference."""
    return F.upper(F.trim(_col(c)))


def strip_ws(c) -> Column:
    """Remove Unicode whitespace at both ends (Spark's trim removes spaces only)."""
    return F.regexp_replace(_col(c), _WS_EDGES, "")


def _repair_once(c: Column) -> Column:
    # Only text made of code points <= U+00FF can be re-encoded as Latin-1; the guard sits
    # inside the argument because encode raises on unmappable input under ANSI. The bytes
    # are then read as UTF-8 and kept only if valid (try_validate_utf8 gives NULL if not).
    # Text without U+0080-U+00FF is ASCII or can't be re-encoded: nothing to repair.
    broken = c.rlike(r"\A[\x00-\xFF]*+\z") & c.rlike(r"[\x80-\xFF]")
    return F.coalesce(F.try_validate_utf8(F.encode(F.when(broken, c), "ISO-8859-1").cast("string")), c)


def fix_mojibake(c) -> Column:
    """Undo UTF-8 text that was read as Latin-1, at most twice; otherwise unchanged."""
    return let(let(_col(c), _repair_once), _repair_once)


_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"   # Python's "cased" characters


def title_case(c) -> Column:
    """Python ``str.title``: a cased character after a cased one is lower-cased, any other
    cased character upper-cased.

    ``initcap`` only breaks on white space (``O'brien``), so the text is split into runs of
    cased and uncased characters and each cased run is re-cased.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), 1)
    cased = F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)),
                                                 F.lower(F.substring(w, 2, 1 << 30))))
    return F.array_join(cased, "")


def normalize_author(c) -> Column:
    """Unify author spellings: dots and spaces around initials, lone initials, case."""
    name = fix_mojibake(_col(c))
    name = F.regexp_replace(name, *AUTHOR_DOTS)
    # A lone ASCII letter gets a dot unless a dot or apostrophe follows (Unicode word edges).
    name = F.regexp_replace(name, *AUTHOR_LONE_INITIAL)
    name = F.trim(F.regexp_replace(name, *AUTHOR_SPACES))
    return let(title_case(name), lambda t: F.nullif(t, F.lit("")))


def clean_year(c) -> Column:
    """Integer year in [1450, 2004], else NULL. Overflow and non-integers give NULL."""
    year = let(strip_ws(_col(c)), lambda t: F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int")))
    return let(year, lambda y: F.when(y.between(YEAR_MIN, YEAR_MAX), y))


_FLOAT_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _age_number(c) -> Column:
    return let(strip_ws(_col(c)), lambda t: F.when(t.rlike(_FLOAT_TEXT), t.try_cast("double")))


def parse_age(c) -> Column:
    """Parse as a float and truncate toward zero, without the bounds of ``clean_age``."""
    return _age_number(c).try_cast("int")


def clean_age(c) -> Column:
    """Parse as a float, truncate toward zero, keep [5, 100], else NULL."""
    # trunc(num) in [5, 100]  <=>  5 <= num < 101 ; NaN and infinities fall outside.
    return let(_age_number(c), lambda num: F.when((num >= AGE_MIN) & (num < AGE_MAX + 1), num.cast("int")))


def clean_location_part(c) -> Column:
    """One location part: junk characters removed, trimmed, lower case; placeholders -> NULL."""
    cleaned = F.lower(strip_ws(F.regexp_replace(_col(c), LOCATION_JUNK, "")))
    return let(cleaned, lambda part: F.when(~part.isin(LOCATION_PLACEHOLDERS), part))


def parse_location(c) -> Column:
    """Free text ``city, state, country`` read from the right into a struct.

    One part is a city; of two the last is the country; of more the last two are state and country, and what stands
    before them is the city, missing parts left out.
    """
    def from_parts(parts: Column) -> Column:
        n = F.size(parts)
        several = let(F.array_join(F.slice(parts, 1, F.greatest(n - 2, F.lit(1))), ", "), lambda t: F.nullif(t, F.lit("")))
        return F.struct(F.when(n <= 2, F.get(parts, 0)).otherwise(several).alias("city"),
                        F.when(n >= 3, F.get(parts, n - 2)).alias("state"),
                        F.when(n >= 2, F.get(parts, n - 1)).alias("country"))

    # NULL text has the one part NULL
    return let(F.transform(F.coalesce(F.split(_col(c), ",", -1), F.array(F.lit(None).cast("string"))), clean_location_part), from_parts)


def publish_year(c) -> Column:
    """First run of four digits in a free-text date, then the year rule."""
    return clean_year(F.regexp_extract(_col(c), PUBLISH_YEAR_PATTERN, 1))


def valid_key(c) -> Column:
    """Lookup-key format: exactly ten ASCII digits or X."""
    return _col(c).rlike(KEY_FORMAT)


def author_key_from_url(c) -> Column:
    """Author id: drop trailing '/', take the text after the last '/authors/', first segment."""
    u = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "/+$", "")
    return let(F.substring_index(F.substring_index(u, "/authors/", -1), "/", 1), lambda k: F.nullif(k, F.lit("")))


def genre_label(c) -> Column:
    """Genre label of a subject token: INITCAP(TRIM(t)) (white-space word boundaries)."""
    return F.initcap(F.trim(_col(c)))


def is_genre_token(c) -> Column:
    """A subject token that names a genre: not blank and not a stop word."""
    return ~F.lower(F.trim(_col(c))).isin(["", *GENRE_STOP_WORDS])
