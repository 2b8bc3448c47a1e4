"""Periodic runs against a plain definition."""

import os
import random
import sys

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm.periodic import bands, find_runs, periodic_runs
from folio.llm.queries import planted_loops

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_runs(words, least=6, copies=4):
    """(start, length, period) of all maximal stretches with smallest period q."""
    n, found = len(words), []
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, copies * q):
                found.append((i, j - i + q, q))
            i = max(j, i) + 1
    return sorted((s, m, q) for s, m, q in found if not any(p < q and a <= s and a + b >= s + m for a, b, p in found))


def plain(rows, least=6, copies=4):
    out = []
    for i, text in rows:
        words = brute.WORDS.findall(text or "")
        runs = plain_runs(words, least, copies)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        out.append((i, len(words), runs, " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def in_order(rows):
    return sorted(rows, key=repr)


def got_from(df):
    return in_order((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in df.collect())


def hashes(words):
    return np.array([hash((w, "x")) & (2**63 - 1) for w in words], np.uint64)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 12), st.integers(0, 4)), max_size=6), st.sampled_from([(6, 4), (2, 2), (9, 3), (30, 4)]))
def test_runs_of_repeated_blocks(blocks, rule):
    words = [w for block, times, rest in blocks for w in block * times + block[:rest]]
    got = find_runs(hashes(words), np.array([0, len(words)]), *rule)
    assert [tuple(r[1:]) for r in got.tolist()] == plain_runs(words, *rule)


def test_every_lag_stands_in_one_band_no_wider_than_its_grams():
    for rule in ((6, 4), (2, 2), (100, 3), (7, 5)):
        lags = []
        for lo, hi, k in bands(5000, *rule):
            assert hi <= k == min(max(rule[0], rule[1] * q) - q for q in range(lo, hi + 1))
            lags += range(lo, hi + 1)
        assert lags == list(range(1, 5000 // rule[1] + 1))


def corpus():
    rng = random.Random(4)
    text = lambda n, some=500: " ".join(f"w{rng.randrange(some)}é" for _ in range(n))
    loop = text(40)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "a a a a a"), (5, "a  a\na\ta a a"), (6, "b a a a a a a c"), (7, "a b " * 3), (8, "a b " * 4 + "a"),
            (9, f"{text(30)} {(loop + ' ') * 4}{text(20)}"), (10, f"{(loop + ' ') * 9}"), (11, " ".join([loop] * 3)), (12, "x " * 6000), (13, text(4000, 3)),
            (14, ("a a a a a a b " * 5) + text(10)), (15, text(900) + " " + "no break " * 700), (None, "q " * 9), (16, (text(700) + " ") * 5), (17, "z" * 90_000)]
    return rows + rows[9:12]


def test_definition(spark):
    docs = spark.createDataFrame([(i, t, None, "s", 1) for i, t in corpus()], SCHEMA).selectExpr("*", "1 as runs", "2 as period", "3 as n_words", "'k' as kept_text").repartition(3)
    assert got_from(periodic_runs(spark, docs)) == in_order(plain(corpus()))


def test_rows_of_one_chunk_stay_apart(spark):
    rows = [(k, "a a a") for k in range(50)] + [(k, "a b a b a b c") for k in range(50, 90)]
    assert all(not r.runs for r in periodic_runs(spark, spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect())


def test_empty_table(spark):
    assert periodic_runs(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("rule", [(6, 1), (1, 4)])
def test_wrong_rules_are_refused(spark, rule):
    with pytest.raises(ValueError):
        periodic_runs(spark, spark.createDataFrame([], "doc_id long, text string"), least=rule[0], copies=rule[1])


def test_planted_loops(spark):
    import zlib

    rows = [(i, " ".join(f"w{k}" for k in range(i % 90))) for i in range(300)] + [(None, "a b"), (301, None)]
    got = {r.doc_id: r.text for r in planted_loops(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    changed = 0
    for i, text in rows:
        words = (text or "").split()
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            changed += 1
        assert (got[i] or "").split() == words
    assert changed > 10
