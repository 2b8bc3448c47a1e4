"""The cleaning rules as Spark expressions: boundaries taken from the rules' own limits, and properties over spelled variants."""

import itertools
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.functions import (
    author_key_from_url,
    clean_age,
    clean_year,
    fix_mojibake,
    normalize_author,
    parse_location,
    publish_year,
    title_case,
    valid_key,
)
from folio.functions.text import AGE_MAX, AGE_MIN, LOCATION_PLACEHOLDERS, YEAR_MAX, YEAR_MIN

NO_NUMBERS = [None, "", " ", "unknown", "1e", "12 34", "--7", "0x7d0", "\u0661\u0669\u0669\u0660", "9" * 30, "."]


def _apply(spark, cases, fn):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("raw", T.StringType())])
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(cases)], schema)
    rows = df.select("i", fn(F.col("raw")).alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def _misread(text: str, times: int) -> str:
    for _ in range(times):
        text = text.encode().decode("latin-1")
    return text


def test_text_misread_once_or_twice_is_restored(spark):
    words = ["\u00e9t\u00e9", "\u00dcbung macht den Meister", "ni\u00f1o \u00e0 la carte", "\u00a9 1999", "stra\u00dfe"]
    cases = [(_misread(w, n), w) for w in words for n in (0, 1, 2)]
    cases += [(w, w) for w in ("all ascii: 100 %", "", "\u4e66\u540d", "\u00e9 beside \u4e66", "\u0153uvre", "half \u00c3", "\u00a3 5")]
    cases += [(_misread(words[0], 3), _misread(words[0], 1)), (None, None)]  # at most two steps back
    assert _apply(spark, cases, fix_mojibake) == [e for _, e in cases]


def test_years_within_the_limits(spark):
    years = [*range(YEAR_MIN - 3, YEAR_MIN + 4), 1800, *range(YEAR_MAX - 3, YEAR_MAX + 4), 0, -1900]
    forms = [str, lambda y: f"\t{y} ", lambda y: f"{y:06d}", lambda y: f"\u00a0{y}\n"]
    cases = [(f(y), y if YEAR_MIN <= y <= YEAR_MAX else None) for y, f in itertools.product(years, forms)]
    cases += [("+1950", 1950)] + [(t, None) for t in [*NO_NUMBERS, "1950.0", "MCML", "c1950"]]
    assert _apply(spark, cases, clean_year) == [e for _, e in cases]


def test_ages_are_cut_to_whole_years_within_the_limits(spark):
    ages = [-AGE_MIN, 0, *range(AGE_MIN - 2, AGE_MIN + 3), 47, *range(AGE_MAX - 2, AGE_MAX + 3), 10 ** 6]
    forms = [(str, 0), (lambda a: f" {a}.0", 0), (lambda a: f"{a}.75\t", .75), (lambda a: f"{a}e0", 0)]
    cases = [(f(a), int(a + more) if AGE_MIN <= int(a + more) <= AGE_MAX and a >= 0 else None) for a, (f, more) in itertools.product(ages, forms)]
    cases += [(t, None) for t in [*NO_NUMBERS, "NaN", "Infinity", "old"]]
    assert _apply(spark, cases, clean_age) == [e for _, e in cases]


def _location(text):
    """City, state and country by the rule's own words."""
    if text is None:
        return None, None, None
    parts = ["".join(ch for ch in p if ch not in '\\")(').strip().lower() for p in text.split(",")]
    parts = [None if p in LOCATION_PLACEHOLDERS else p for p in parts]
    if len(parts) == 1:
        return parts[0], None, None
    if len(parts) == 2:
        return parts[0], None, parts[1]
    return ", ".join(p for p in parts[:-2] if p) or None, parts[-2], parts[-1]


def test_locations_are_read_from_the_right(spark):
    rng = random.Random(21)
    vocabulary = ["Lyon", " rh\u00f4ne ", "FRANCE", "", " ", "N/A", "-", "unknown", '(old) "town"', "a\\b", "\u00a0", "st. john's"]
    texts = [None, *vocabulary] + [",".join(rng.choice(vocabulary) for _ in range(rng.randrange(2, 7))) for _ in range(300)]
    got = [tuple(r) for r in _apply(spark, [(t, None) for t in texts], parse_location)]
    assert got == [_location(t) for t in texts]


def test_spellings_of_an_author_become_one(spark):
    names = {"E. T. A. Hoffmann": ("E", "T", "A", "Hoffmann"), "P. Mc'Neil": ("P", "Mc'Neil"), "\u00c9. Zola-Dupr\u00e9": None}
    cases = []
    for wanted, parts in names.items():
        if parts is None:
            continue
        initials, last = parts[:-1], parts[-1]
        for dot, gap, case in itertools.product([".", " .", ". ", "  .  "], ["", " ", "   "], [str.title, str.upper, str.lower]):
            cases.append((case("".join(i + dot + gap for i in initials) + " " + last), wanted))
        cases.append((" ".join([*initials, last]), wanted))
        cases.append((f"{last} {' '.join(initials)}", f"{last} {' '.join(i + '.' for i in initials)}"))
    cases += [(_misread("Andr\u00e9 Gide", n), "Andr\u00e9 Gide") for n in (0, 1, 2)]
    cases += [(None, None), ("", None), (" \t ", None), ("Plato", "Plato")]
    assert _apply(spark, cases, normalize_author) == [e for _, e in cases]


def test_a_clean_author_stays_as_it_is(spark):
    rng = random.Random(22)
    parts = ["a", "B.", "o'neil", "de la", "STRA\u00dfE", "x.y", "\u0416\u0443\u043a", "3rd", " ", "-", "mary-ann"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(200)]
    once = _apply(spark, [(t, None) for t in texts], normalize_author)
    assert _apply(spark, [(t, None) for t in once], normalize_author) == once


def test_title_case_after_any_non_letter(spark):
    cases = [("o'brien", None), ("saint-exup\u00e9ry", None), ("3rd ave", None), ("", None)]
    assert _apply(spark, cases, title_case) == ["O'Brien", "Saint-Exup\u00e9ry", "3Rd Ave", ""]


def test_mojibake_double_encoding(spark):
    twice = "caf\u00c3\u0083\u00c2\u00a9"
    assert _apply(spark, [(twice, None)], fix_mojibake) == ["caf\u00e9"]


def test_lone_letter_after_apostrophe(spark):
    assert _apply(spark, [("D'Arcy's", None)], normalize_author) == ["D'Arcy'S."]


def test_publish_year_and_key_rules(spark):
    assert _apply(spark, [("May 1999", None), ("unknown", None), ("c1400", None)], publish_year) == [1999, None, None]
    assert _apply(spark, [("000000001X", None), ("B000000001", None), ("00000001X", None)], valid_key) == [True, False, False]


def test_author_key_from_url(spark):
    cases = [("https://x.org/authors/OL1A/Name", None), ("https://x.org/authors/OL2A/", None),
             ("https://x.org/people/p", None), (None, None), ("", None)]
    assert _apply(spark, cases, author_key_from_url) == ["OL1A", "OL2A", "https:", None, None]


def test_age_overflow_and_exotic_text(spark):
    cases = [("1e20", None), ("25d", None), ("nan", None), ("0x1p3", None), (" 7.9 ", None), ("-6", None)]
    assert _apply(spark, cases, clean_age) == [None, None, None, None, 7, None]


def test_year_overflow(spark):
    assert _apply(spark, [("99999999999", None), ("+1998", None), ("1998.0", None)], clean_year) == [None, 1998, None]


def test_mojibake_utf8_edge_cases(spark):
    cases = [
        ("\u00ed\u00a0\u0080", "\u00ed\u00a0\u0080"),                    # ED A0 80: encoded surrogate, kept
        ("\u00c0\u00af", "\u00c0\u00af"),                                # C0 AF: overlong '/', kept
        ("\u00f0\u009f\u0098\u0080", "\U0001F600"),                      # 4-byte character read as Latin-1
        ("\u00e2\u0082\u00ac 5", "\u20ac 5"),                            # euro sign read as Latin-1
        ("\u0080\u0081 plain", "\u0080\u0081 plain"),                    # lone C1 controls, kept
        ("\u00f4\u0090\u0080\u0080", "\u00f4\u0090\u0080\u0080"),        # beyond U+10FFFF, kept
        ("na\u00efve caf\u00e9", "na\u00efve caf\u00e9"),                 # correct Latin-1 text, kept
    ]
    assert _apply(spark, cases, fix_mojibake) == [e for _, e in cases]


def test_title_case_uncased_letters(spark):
    # modifier letter h is cased (Other_Lowercase); the CJK ideograph is an uncased letter
    cases = [("aʰb", None), ("中xy", None), ("x中y", None)]
    assert _apply(spark, cases, title_case) == ["Aʰb", "中Xy", "X中Y"]
