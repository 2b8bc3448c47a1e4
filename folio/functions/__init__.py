"""Column-level functions (native expressions, no Python UDFs)."""

from folio.functions.metrics import DEFAULT_M, ratio, weighted_rating
from folio.functions.text import (
    author_key_from_url,
    clean_age,
    parse_age,
    clean_location_part,
    clean_year,
    fix_mojibake,
    genre_label,
    is_genre_token,
    normalize_author,
    normalize_key,
    parse_location,
    publish_year,
    strip_ws,
    title_case,
    valid_key,
)

__all__ = [
    "DEFAULT_M", "ratio", "weighted_rating", "author_key_from_url", "clean_age", "parse_age",
    "clean_location_part", "clean_year", "fix_mojibake", "genre_label", "is_genre_token",
    "normalize_author", "normalize_key", "parse_location", "publish_year", "strip_ws",
    "title_case", "valid_key",
]
