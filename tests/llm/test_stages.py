"""Stages of the corpus pipeline against plain definitions."""

import os
import random
import sys

import corpus_pipeline

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], SCHEMA).repartition(3)


def near_kept(rows, size=5, percent=80):
    """Ids that stay: the smallest of each group of texts linked by their word shingles."""
    sets = [brute.shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for k in range(len(rows)):
        for j in range(k):
            both = len(sets[k] & sets[j])
            if both and 100 * both >= percent * len(sets[k] | sets[j]):
                old, new = group[k], group[j]
                group = [new if g == old else g for g in group]
    return {min(rows[j][0] for j in range(len(rows)) if group[j] == g) for g in group}


def test_near_duplicates_by_five_words(spark):
    rng = random.Random(11)
    word = iter(f"v{k}" for k in range(10**6))
    rows = [(1, None), (2, ""), (3, "four words only here"), (4, "Four words ONLY here")]
    for n in range(40, 64, 2):  # one word changed in the middle; linked from about 49 words on
        words = [next(word) for _ in range(n)]
        rows += [(100 + 2 * n, " ".join(words)), (101 + 2 * n, " ".join(words[:n // 2] + ["changed"] + words[n // 2 + 1:]))]
    base = [next(word) for _ in range(120)]
    for k in range(6):  # a chain: each has one more word changed than the one before
        base[15 + 18 * k] = f"other{k}"
        rows.append((500 + k, " ".join(base)))
    rng.shuffle(rows)
    got = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()}
    assert got == near_kept(rows)
    assert got != near_kept(rows, 3, 90)


def test_near_duplicates_keep_one_row_of_each_group(spark):
    words = [f"u{k}" for k in range(80)]
    text, near, other, alone = " ".join(words), " ".join([*words[:40], "changed", *words[41:]]), " ".join(words[::-1]), "v " * 9
    rows = [(1, text), (1, text), (1, near), (2, near), (None, near), (None, text),  # one group
            (None, other), (None, other), (7, "of its own " + alone), (7, "of its own " + alone), (8, None), (8, None), (None, ""), (9, " ")]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()]
    assert len(got) == 7 and sum(i == 1 for i, _ in got) == 1 and (None, other) in got
    assert sorted(str(r) for r in got if r[0] != 1) == sorted(str(r) for r in [(None, other), (7, "of its own " + alone), (8, None), (8, None), (None, ""), (9, " ")])


def test_clashing_columns_and_empty_tables(spark):
    words = " ".join(f"k{k}" for k in range(70))
    docs = table(spark, [(1, words), (2, words), (3, None), (None, words), (4, "short")]).selectExpr(
        "*", "1 as __crc", "2 as __row", "3 as __c", "'t' as kept_text", "5 as crc", "6 as id", "7 as d", "8 as judged_id", "9 as `a.b`", "10 as row", "11 as `group`")
    for stage in (corpus_pipeline.lines, corpus_pipeline.near_duplicates, corpus_pipeline.decontamination, corpus_pipeline.quality):
        got = stage(spark, docs, "/root/testdata/sf0.001")
        assert got.columns == docs.columns and stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
        assert {r.doc_id for r in got.collect()} <= {1, 2, 3, 4, None}
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3, 4]


def test_rows_of_files_need_no_copy(spark, tmp_path, monkeypatch):
    words = " ".join(f"k{k}" for k in range(70))
    table(spark, [(1, words), (1, words), (None, words), (None, ""), (None, ""), (7, "x y")]).write.parquet(str(tmp_path / "docs"))
    names, keep = [], corpus_pipeline.written
    monkeypatch.setattr(corpus_pipeline, "written", lambda s, df, name: (names.append(name), keep(s, df, name))[1])
    got = corpus_pipeline.near_duplicates(spark, spark.read.parquet(str(tmp_path / "docs")), "").collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id) == [(1, words), (7, "x y")] and sum(r.text == "" for r in got) == 2 and len(got) == 4
    assert names == ["stage-near"]


def test_links_of_edited_copies(spark):
    """Groups of copies with more and more words changed, so that many pairs lie on both sides of the border and in different components."""
    from folio.llm.jaccard_join import grouped_prefix_join

    rng = random.Random(31)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(60 + 25 * g)]
        for k in range(45):
            words = [f"e{rng.randrange(10**6)}" if rng.random() < .002 * k else w for w in base]
            cut = rng.randrange(0, 1 + len(words) // 8)
            rows.append((100 * g + k, " ".join(words[cut:])))
    sets = [brute.shingles(t, 2) for _, t in rows]
    for percent in (80, 90):
        group = list(range(len(rows)))
        for k in range(len(rows)):
            for j in range(k):
                both = len(sets[k] & sets[j])
                if 100 * both >= percent * len(sets[k] | sets[j]):
                    group = [group[j] if x == group[k] else x for x in group]
        want = {i: min(rows[j][0] for j in range(len(rows)) if group[j] == g) for (i, _), g in zip(rows, group, strict=True)}
        got = {r.doc_id: r.component_id for r in grouped_prefix_join(spark, spark.createDataFrame(rows, "doc_id long, text string"), size=2, percent=percent).collect()}
        assert got == want and len(set(want.values())) > 10
