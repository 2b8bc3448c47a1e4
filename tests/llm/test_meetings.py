"""Operator 3: crowds of texts that resemble each other without being linked make no rows of meetings, and no link is lost."""

from __future__ import annotations

import os
import random
import sys

from pyspark.sql import functions as F

from folio.llm import jaccard_join
from folio.llm.jaccard_join import grouped_prefix_join

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402


def _crowd(rng: random.Random, docs: int, changed: int) -> list[tuple]:
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(docs):
        words = list(base)
        for at in rng.sample(range(300), changed):
            words[at] = f"e{rng.randrange(10**9)}"
        rows.append((k, " ".join(words)))
        if k % 10 == 0:  # one linked copy
            words[rng.randrange(300)] = f"f{k}"
            rows.append((1000 + k, " ".join(words)))
    return rows


def test_a_crowd_makes_no_rows(spark, monkeypatch):
    rows, met, meets = _crowd(random.Random(5), 80, 8), [], jaccard_join._meets

    def counted(minor, groups, percent):
        found = meets(minor, groups, percent)
        met.append(found.agg(F.coalesce(F.sum("met"), F.lit(0))).first()[0])
        return found

    monkeypatch.setattr(jaccard_join, "_meets", counted)
    got = grouped_prefix_join(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute.jaccard_components(rows))
    assert len(met) == 1 and met[0] < 2 * len(rows)


def test_groups_of_several_classes_are_not_judged_by_one(spark, monkeypatch):
    """All sets of one size in one group: each bucket holds groups of many classes, whose members differ in their sketches."""
    mapper = jaccard_join._signature_mapper

    def one_group(*args):
        emit = mapper(*args)

        def same(batches):
            for batch in emit(batches):
                at = batch.schema.get_field_index("grp")
                yield batch.set_column(at, "grp", batch.column("n"))

        return same

    monkeypatch.setattr(jaccard_join, "_signature_mapper", one_group)
    rows = _crowd(random.Random(7), 30, 4)
    got = grouped_prefix_join(spark, spark.createDataFrame(rows, "doc_id long, text string"), pivots=1)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute.jaccard_components(rows))


def test_sketches_of_any_width_lose_no_link(spark):
    rng, rows = random.Random(9), []
    for _ in range(60):
        one = {rng.getrandbits(64) for _ in range(rng.randrange(1, 400))}
        two = {x for x in one if rng.random() > .04} | {rng.getrandbits(64) for _ in range(rng.randrange(len(one) // 20 + 1))}
        words = 1 << rng.randrange(7)
        rows.append((len(one), len(two), len(one ^ two), _bits(one, words), _bits(two, words << rng.randrange(2))))
    pairs = spark.createDataFrame(rows, "n1 long, n2 long, apart long, s1 array<long>, s2 array<long>")
    folded = [jaccard_join._folded_to(F.col(s), 4) for s in ("s1", "s2")]
    flags = [jaccard_join._may_link(F.col("n1"), F.col("n2"), *s, 90) for s in ((F.col("s1"), F.col("s2")), folded)]
    got = pairs.select("n1", "n2", "apart", *[f.alias(f"f{k}") for k, f in enumerate(flags)]).collect()
    linked = [r for r in got if 190 * ((r.n1 + r.n2 - r.apart) // 2) >= 90 * (r.n1 + r.n2)]
    assert linked and all(r.f0 and r.f1 for r in linked) and not all(r.f0 for r in got)
    for _, _, _, s, _ in rows:
        want = [0] * min(4, len(s))
        for k, word in enumerate(s):
            want[k % len(want)] ^= word
        assert [tuple(want)] == [tuple(r[0]) for r in spark.createDataFrame([(s,)], "s array<long>").select(jaccard_join._folded_to(F.col("s"), 4)).collect()]
        if len(s) > 8:
            break


def _bits(values: set[int], words: int) -> list[int]:
    out = [0] * words
    for v in values:
        at = v % (64 * words)
        out[at // 64] ^= 1 << at % 64
    return [w - 2**64 if w >= 2**63 else w for w in out]
