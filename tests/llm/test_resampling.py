"""Importance resampling against a plain definition, and CRC-32 of spans against zlib."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folio.llm.resampling import PositionCrc, importance_resample

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def features(text, longest):
    w = WORDS.findall((text or "").encode().lower())  # bytes.lower() touches A-Z alone
    return [b" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)], len(w)


def plain(rows, target, buckets=10_000, longest=1, percent=10, least=20):
    """doc_id, n_features, weight, score, rank of (doc_id, text) rows."""
    own = [(i, *features(t, longest)) for i, t in rows]
    goal = [features(t, longest)[0] for t in target]
    s, t = (Counter(zlib.crc32(f) % buckets for fs in many for f in fs) for many in ([f for _, f, _ in own], goal))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, fs, n in own:
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in (zlib.crc32(f) % buckets for f in fs)]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawn = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(drawn[:len(drawn) * percent // 100]):
        r[4] = rank + 1
    return [tuple(r[:5]) for r in out]


def known(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("reach", [1, 4, 64])
def test_crc_of_spans(reach):
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 9000, dtype=np.uint8)
    starts = np.concatenate(([0, 5, 0, 100, 7, 9000], rng.integers(0, 9000, 300)))
    ends = np.minimum(9000, starts + np.concatenate(([0, 1, 9000, 64, 65, 0], rng.integers(0, 400, 300))))
    assert PositionCrc(reach)(data, starts, ends).tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]


def test_wrong_reach_is_refused():
    with pytest.raises(ValueError):
        PositionCrc(48)


def corpus():
    rng = np.random.default_rng(8)
    words = [f"{chr(97 + k % 26)}{k}é" for k in range(90)] + ["Über", "ÉTÉ", "x" * 300, "Y2K"]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(1, 60))))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, "--- !!"), (203, "a-b_c\td"), (204, "z" * 200_000 + " " + "q " * 30), (205, " ".join(words * 40)), (None, rows[5][1] * 3)]
    return rows, [rows[k][1] for k in range(0, 30, 3)] + [None, "", "unseen words 12"]


@pytest.mark.parametrize("longest, percent", [(1, 10), (2, 37), (3, 100), (1, 0)])
def test_definition(spark, longest, percent):
    rows, target = corpus()
    docs = table(spark, rows).selectExpr("*", "1 as bucket", "2 as rank", "3 as row", "'s' as score", "4 as weight").repartition(3)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance_resample(spark, docs, goal, longest=longest, percent=percent).drop("n_words").collect()
    assert known(got) == known(plain(rows, target, longest=longest, percent=percent))


def test_repeated_rows_and_ties(spark):
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(7, text)] * 30 + [(8, text)] * 10 + [(9, "short")]
    got = importance_resample(spark, table(spark, rows).repartition(4), table(spark, [(0, text)]), percent=50).collect()
    ranks = sorted(r.rank for r in got if r.rank)
    assert ranks == list(range(1, 21)) and len(got) == 41
    best = max({r.doc_id: r.score for r in got if r.n_words >= 20}.items(), key=lambda p: p[1])[0]
    assert sum(r.doc_id == best for r in got if r.rank) == min(20, 30 if best == 7 else 10)


def test_empty_tables(spark):
    none = table(spark, [])
    assert importance_resample(spark, none, none).count() == 0
    assert known(importance_resample(spark, table(spark, [(1, "a b " * 20)]), none, percent=100).drop("n_words").collect()) == known(plain([(1, "a b " * 20)], [], percent=100))
