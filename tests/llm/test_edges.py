"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import os
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from folio.llm import jaccard_join, repeats, suffix_dedup
from folio.llm.ann import multiprobe_search
from folio.llm.decontaminate import template_leaks
from folio.llm.html_extract import Page, consensus_extraction
from folio.llm.jaccard_join import grouped_prefix_join
from folio.llm.line_dedup import CuckooFilter, LineIndex, line_dedup
from folio.llm.packing import WordIds, best_fit_decreasing, best_fit_packing, lower_bound, tokenizer_path
from folio.llm.quality import co_trained_quality
from folio.llm.storage import small_batches
from folio.llm.substring_dedup import relative_lz_dedup
from folio.llm.suffix_dedup import adjacent_common_prefixes, suffix_array_dedup, two_stage_sort
from folio.llm.toxicity import compression_toxicity

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"w{k}é" for k in range(60)] + ["The", "of", "5", "km"]


def corpus():
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    shared, line = text(70), "A line that is common enough to be dropped, " + text(4)
    out = [(0, None), (1, ""), (2, "  \n\t "), (3, "one"), (4, "One"), (5, "two words"), (None, shared)]
    out += [(10 + k, f"{text(20)} {shared}\n{line if k % 2 else '  ' + line.upper() + ' '}\n{text(30)}") for k in range(9)]
    out += [(30 + k, out[9][1]) for k in range(3)] + [(33, out[9][1]), (33, out[9][1]), (33, text(40) + " " + shared)]
    base = [rng.choice(WORDS) for _ in range(120)]
    for k in range(8):
        words = list(base)
        words[10 * k + 3] = f"changed{k}"
        out.append((50 + k, " ".join(words)))
    out += [(70, "ab " * 900), (71, "z" * 1500), (72, text(9000)), (73, "İÉ " * 300 + shared)]
    return out


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", f"s{k % 3}", len(t) if t else None) for k, (i, t) in enumerate(corpus())]
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as anchor", "'x' as crc", "array(1) as hits", "2 as block", "3 as a", "'q' as blob").repartition(3)


def some(rows, *columns):
    return sorted((tuple(getattr(r, c) for c in columns) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_substring(spark, table):
    got = relative_lz_dedup(spark, table, with_text=True).collect()
    assert some(got, "doc_id", "n_words", "n_removed", "kept_sha256") == order(brute.substring_dedup(corpus()))
    assert all(brute.sha(r.kept_text) == r.kept_sha256 for r in got)
    assert all(f.end - f.start >= 1 and f.source < r.doc_id for r in got for f in r.factors)


@pytest.mark.parametrize("limit", [2000, 2])
def test_suffix(spark, table, limit):
    got = suffix_array_dedup(spark, table, group_limit=limit).collect()
    assert some(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == order(brute.suffix_dedup(corpus()))


def test_jaccard_counts_meetings_by_plain_columns(spark):
    """Meetings of groups of two components, whichever of them is the main one of a bucket; no struct is compared or hashed in the join's loop."""
    rng = random.Random(3)
    rows = [(rng.randrange(40), 100 + g, 30, rng.randrange(3), g % 4) for g in range(24) for _ in range(6)]  # token, grp, n, pos, comp
    rows = sorted({(t, g): (t, g, n, p, c) for t, g, n, p, c in rows}.values())
    main = {t: max(c for u, *_, c in rows if u == t) if t % 2 else min(c for u, *_, c in rows if u == t) for t, *_ in rows}
    minor = spark.createDataFrame([(t, main[t], g, n, p, c) for t, g, n, p, c in rows if c != main[t]], "token long, main long, g1 long, n1 long, p1 int, c1 long")
    groups = spark.createDataFrame([(*r, 1) for r in rows], "token long, grp long, n long, pos int, comp long, k long")
    for percent in (50, 90):
        expected: dict = {}
        for t, g, n, p, c in rows:
            for u, h, m, q, d in rows:
                if t == u and c < d and _meeting_counts(n, m, p, q, percent):
                    expected[c, g, n, d, h, m] = expected.get((c, g, n, d, h, m), 0) + 1
        found = jaccard_join._meets(minor, groups, percent)
        assert {kind for _, kind in found.dtypes} == {"bigint"}
        assert {tuple(r)[:6]: r.met for r in found.collect()} == expected and expected


def _meeting_counts(n, m, p, q, percent):
    rest = lambda n: -(-percent * n // 100) - 1
    shared = max(1, -(-percent * (n + m) // (100 + percent)) - max(rest(n), rest(m)))
    late = -(-shared // 2)
    most = min(p, q) + 1 + min(n - p - 1, m - q - 1)
    return (100 + percent) * most >= percent * (n + m) and p <= n - rest(n) - late and q <= m - rest(m) - late


def test_jaccard_moves_texts_in_small_batches(spark, table, monkeypatch):
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda s, df, name: (seen.append((name, int(s.conf.get(key)))), write(s, df, name))[1])
    before = spark.conf.get(key)
    grouped_prefix_join(spark, table.filter("doc_id < 40"))
    assert {n for n, _ in seen} >= {"op3-signatures", "op3-texts", "op3-links"} and all(rows <= 1000 for _, rows in seen)
    assert spark.conf.get(key) == before
    with small_batches(spark, 10), small_batches(spark, 500):  # never more than the caller's own
        assert spark.conf.get(key) == "10"


def test_suffix_pieces_hold_each_window_once():
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 123, 6000).astype(np.uint8))
    blocks = pa.Table.from_batches(repeats.block_mapper(repeats.byte_anchors, 400, 32)(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "crc": [2], "text": [text.decode()]})])))
    hits = [{"a": r["a"], "b": r["b"], "anchor": r["anchor"]} for r in blocks.to_pylist()]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([zstandard.compress(text)], pa.binary()),
                                        pa.array([hits], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("anchor", pa.int64())])))], names=["doc_id", "crc", "blob", "hits"])
    pieces = [r for b in suffix_dedup._piece_mapper(400, 32)(iter([batch])) for r in b.to_pylist()]
    assert sorted(r["a"] + k for r in pieces for k in range(r["starts"])) == list(range(6000 - 400 + 1))
    assert all(r["body"] == text[r["a"]:r["a"] + r["starts"] + 399] for r in pieces)
    # cut into batches of any size, blocks that meet give the same spans; one that meets no other isn't sorted
    rows = sorted([r | {"doc_id": d} for r in pieces for d in (1, 2)] + [pieces[0] | {"meet": 2**62}], key=lambda r: (r["side"], r["meet"]))
    table = pa.Table.from_pylist(rows, pa.schema([("side", pa.string()), ("meet", pa.int64()), ("anchor", pa.int64()), ("doc_id", pa.int64()), ("crc", pa.int64()),
                                                  ("a", pa.int32()), ("starts", pa.int32()), ("body", pa.binary())]))
    for size in (1, 2, 3, 7, 1000):
        got = [(r["doc_id"], k) for b in suffix_dedup._suffix_sorter(400)(iter(table.to_batches(size))) for r in b.to_pylist() for k in range(r["a"], r["b"] + 1)]
        assert sorted(got) == [(d, k) for d in (1, 2) for k in range(6000 - 400 + 1)]


def test_suffix_order_to_a_depth():
    rng = np.random.default_rng(6)
    for trial in range(60):
        text = np.tile(rng.integers(0, 257 if trial % 2 else 4, 200).astype(np.uint16), 3)
        plain = text.tolist()
        for depth in (1, 7, 40):
            got = two_stage_sort(text, depth).tolist()
            assert [plain[i:i + depth] for i in got] == sorted(plain[i:i + depth] for i in range(len(plain)))
        alike = suffix_dedup.alike_neighbours(text, np.array(got), 40)
        assert alike.tolist() == [False, *[max(x, y) + 40 <= len(plain) and plain[x:x + 40] == plain[y:y + 40] for x, y in zip(got, got[1:], strict=False)]]


def test_suffix_order():
    rng = np.random.default_rng(1)
    for trial in range(120):
        text = rng.integers(0, rng.integers(1, 6), rng.integers(1, 150)).astype(np.uint16)
        text = np.tile(text, 1 + trial % 3)
        got, plain = two_stage_sort(text, 10**4), text.tolist()
        assert got.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        shared = adjacent_common_prefixes(text, got, 1000)
        for k in range(1, len(plain)):
            a, b = plain[got[k - 1]:], plain[got[k]:]
            assert shared[k] == next((m for m in range(min(len(a), len(b))) if a[m] != b[m]), min(len(a), len(b)))


def test_jaccard(spark, table):
    rows = [r for r in corpus() if r[0] is not None and r[0] != 33]
    got = grouped_prefix_join(spark, table.filter("doc_id is null or doc_id <> 33")).collect()
    assert some([r for r in got if r.doc_id is not None], "doc_id", "n_shingles", "component_id") == sorted(brute.jaccard_components(rows))
    assert len(got) == len(rows) + 1


def test_lines(spark, table):
    rows = corpus()
    got = line_dedup(spark, table, with_text=True).collect()
    assert some(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == order(brute.line_dedup(rows))
    assert sum(r.n_dropped for r in got) > 0
    # beyond the filters' size limit the result is the same
    index = LineIndex.of(spark, table)
    assert some(index.apply(table, filter_bytes=0).collect(), "doc_id", "n_dropped") == some(got, "doc_id", "n_dropped")
    # deleting and inserting again gives the counts back
    gone = spark.createDataFrame([(k,) for k in range(10, 15)], "id long")
    without = index.delete(gone)
    left = [r for r in rows if r[0] not in range(10, 15)]
    kept = without.apply(table.filter("doc_id is null or doc_id not between 10 and 14")).collect()
    assert some(kept, "doc_id", "n_lines", "n_dropped", "kept_sha256") == order(brute.line_dedup(left))
    back = without.insert(table.filter("doc_id between 10 and 14"))
    assert some(back.counts().collect(), "h1", "n_docs", "last_doc") == some(index.counts().collect(), "h1", "n_docs", "last_doc")


def test_cuckoo():
    rng = np.random.default_rng(3)
    keys = rng.integers(-2**62, 2**62, (2, 3000))
    made = CuckooFilter.of(*keys)
    assert made.contains(*keys).all()
    other = rng.integers(-2**62, 2**62, (2, 3000))
    assert made.contains(*other).mean() < 0.01
    made.delete(*keys[:, :1500])
    assert made.contains(*keys[:, 1500:]).all() and made.contains(*keys[:, :1500]).mean() < 0.01


def test_packing(spark, table):
    from tokenizers import Tokenizer

    ids = {}
    encoder = Tokenizer.from_file(tokenizer_path())
    for i, t in corpus():
        own = np.array(encoder.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k, s in enumerate(range(0, len(own), 2048)):
            part = own[s:s + 2048]
            ids.setdefault((i, k, s, len(part), zlib.crc32(part.tobytes())), []).append(0)
    got = best_fit_packing(spark, table, group_rows=12).toPandas()
    seen = {}
    for r in got.itertuples():
        key = (None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32)
        seen.setdefault(key, []).append(0)
    assert seen == ids
    for _, group in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert group["length"].sum() <= 2048
        assert (group["offset"].to_numpy() == group["length"].cumsum().to_numpy() - group["length"].to_numpy()).all()


def test_word_ids_equal_whole_texts():
    from tokenizers import Tokenizer

    encoder, words = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path())
    texts = ["Hello, WORLD!! it's 2024 ok", "", "á é\tÉtÉ <|endoftext|>x \x1c y", "日本語 テキスト 🙂🙂", "x" * 5000 + "   'll'd"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    got, edges = words(data, np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts]))))
    for t, a, b in zip(texts, edges[:-1], edges[1:], strict=True):
        assert got[a:b].tolist() == encoder.encode(t, add_special_tokens=False).ids


class Counting:
    """A tokenizer that counts the texts it encodes."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **how)


def test_words_of_letters_are_encoded_many_at_a_time():
    from tokenizers import Tokenizer

    rng = random.Random(5)
    draw = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randrange(1, 12)))
    plain, other = [draw("abcdefgh") for _ in range(3000)], [draw("éüaßÅЖ語") for _ in range(3000)]
    ends = ["", "", "", "%%%", "###.", "'", "_-_", "!?"]
    odd = ["İx", "ﾊﾞ", "\u0958\u0958", "\u1112\u1161\u11ab", "e\u0301e", "ΣΑΣ", "ﬁn", "a\u00a0b", "x²", "12", "it's", "'s'", "a</w>b", "</w>"]
    signs = [w + "".join(rng.choice("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~ sé1") for _ in range(rng.randrange(6))) for w in plain]
    lines = [[w + rng.choice(ends) for w in plain], other, odd + other[:9], odd, signs, signs[:99] + ["x<|endoftext|>", "<|endoftext|>%", "X<|EndOfText|>_"], []]
    texts = [" ".join(x) for x in lines]
    encoder, words = Tokenizer.from_file(tokenizer_path()), WordIds(tokenizer_path())
    for some in (texts[:4], texts[4:5], texts):
        data = np.frombuffer("".join(some).encode(), np.uint8)
        got, edges = words(data, np.concatenate(([0], np.cumsum([len(t.encode()) for t in some]))))
        for t, a, b in zip(some, edges[:-1], edges[1:], strict=True):
            assert got[a:b].tolist() == encoder.encode(t, add_special_tokens=False).ids

    words = WordIds(tokenizer_path())
    used = {k: Counting(v) for k, v in vars(words).items() if isinstance(v, Tokenizer)}
    vars(words).update(used)
    data = np.frombuffer(" ".join(plain + other).encode(), np.uint8)
    words(data, np.array([0, len(data)]))
    assert 0 < sum(x.texts for x in used.values()) < len(set(plain + other)) / 100


def test_known_words_last_from_task_to_task():
    from folio.llm import packing as P

    assert P.word_ids(tokenizer_path()) is P.word_ids(tokenizer_path())
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, None, 3], "text": ["one two, three%%%", None, "three two"]})
    first = [x.to_pylist() for x in P._piece_mapper(tokenizer_path(), 2048)(iter([batch]))]
    known = dict(P.word_ids(tokenizer_path()).known)
    assert [x.to_pylist() for x in P._piece_mapper(tokenizer_path(), 2048)(iter([batch]))] == first and P.word_ids(tokenizer_path()).known == known


def test_bounds_certify():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 101, 60)
        _, _, used = best_fit_decreasing(lengths, 100)
        assert -(-lengths.sum() // 100) <= lower_bound(lengths, 100) <= used
    assert lower_bound(np.array([51] * 9), 100) == 9
    assert lower_bound(np.array([34] * 9), 100) == 5


def test_leaks(spark, table):
    item = "What is the mass of a stone that falls 20 km in 4 hours past Berlin to reach Madrid before Berlin sleeps again tonight"
    other = item.replace("20", "35").replace("Berlin", "Oslo").replace("Madrid", "Paris")
    mixed = other.replace("before Oslo", "before Lima").replace("35", "1,5")
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "", "x"), (4, "tiny item", "x")], "item_id long, text string, hash string")
    docs = spark.createDataFrame([(100, f"so then {item} and more"), (101, f"they asked {other}"), (102, "a tiny item here"), (103, "nothing"), (104, None),
                                  (105, mixed), (106, " ".join(item.split()[:9])), (100, f"so then {item} and more")], "doc_id long, text string")
    got = some(template_leaks(spark, docs, bench).collect(), "doc_id", "item_id")
    assert set(got) >= {(100, 1), (101, 1), (102, 4)} and not {d for d, _ in got} & {103, 104, 106}
    assert some(template_leaks(spark, docs, bench, most_windows=0).collect(), "doc_id", "item_id") == got
    assert template_leaks(spark, docs.limit(0), bench).count() == 0 == template_leaks(spark, docs, bench.limit(0)).count()


def test_pages(spark):
    shell = ('<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>menu</a></nav><div class="ad-slot">buy &amp; go</div>'
             '<div class="post-%d"><h1>Head</h1><p>One  <b>bold</b>\n &lt;two&gt; &eacute;<p>Three<br>four</div>'
             '<div id="comments"><p>first!</p></div><aside>side</aside><form><input value=1>send</form><footer>&copy; me</footer><script>var x="<p>";</script></body>')
    want = "Head\nOne bold <two> é\nThree four"
    rows = [(k, f"http://a.example/{k}", shell % k) for k in range(4)] + [(4, None, None), (5, "odd", ""), (6, "http://b.example", "plain & simple"), (6, "http://b.example", "<p>cut <b"),
                                                                          (7, "http://a.example/x", "<body><main><p>other kind</p></main>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'z' as host", "1 as path")
    got = some(consensus_extraction(spark, pages).collect(), "page_id", "text", "n_chars")
    assert got == sorted([(k, want, len(want)) for k in range(4)] + [(4, "", 0), (5, "", 0), (6, "plain & simple", 14), (6, "cut", 3), (7, "other kind", 10)])
    assert consensus_extraction(spark, pages.limit(0)).count() == 0
    assert Page("<div>" * 3000 + "deep").text(None) == "deep"


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16))
    x[300:500] = x[7]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(600, None), (650, [0.0] * 16), (700, [float("nan")] * 16), (750, [None] + [1.0] * 15), (800, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as bucket", "2 as cls")
    got = multiprobe_search(spark, vectors).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 600, 50):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        score = unit @ unit[q]
        score[q] = -9
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and q not in [r.vec_id for r in own]
        assert np.allclose([r.score for r in own], score[[r.vec_id for r in own]])
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & set(np.lexsort((np.arange(600), -np.round(score, 12)))[:5].tolist()))
    assert hits >= 0.9 * 60 and {r.query_id for r in got} == set(range(0, 600, 50))
    few = multiprobe_search(spark, vectors.filter("vec_id < 3")).collect()
    assert [(r.query_id, r["rank"]) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1), (0, 2)]
    assert multiprobe_search(spark, vectors.limit(0)).count() == 0


def test_quality(spark, table):
    good = [(1000 + k, " ".join(random.Random(k).choice(WORDS[:50]) for _ in range(30 + k % 7)), "en", f"s{k % 3}", 100) for k in range(120)]
    bad = [(2000 + k, "BUY!! NOW!! " * (5 + k % 9), "en", f"s{k % 3}", 100) for k in range(60)]
    docs = table.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(good + bad, SCHEMA))
    labels = spark.createDataFrame([(r[0], 1) for r in good[::2]] + [(r[0], 0) for r in bad[::2]] + [(5, None), (None, 1), (1000, 1)], "doc_id long, quality int")
    got = {(r.doc_id, r.predicted) for r in co_trained_quality(spark, docs, labels).collect() if r.doc_id is not None}
    assert sum((r[0], 1) in got for r in good) >= 115 and sum((r[0], 0) in got for r in bad) >= 57
    assert co_trained_quality(spark, docs, labels).count() == docs.count()
    assert {r.predicted for r in co_trained_quality(spark, docs.select("doc_id", "text"), labels.filter("quality = 1")).collect()} == {1}
    assert co_trained_quality(spark, docs.limit(0), labels).count() == 0


def test_toxicity(spark, table):
    rng = random.Random(8)
    def text(toxic, k):
        words = [rng.choice(WORDS) for _ in range(60)]
        for _ in range(4 if toxic else 0):
            words[rng.randrange(60)] = rng.choice(["vilenessy", "rottenhide", "grubsnout"])
        return " ".join(words)
    rows = [(3000 + k, text(k % 4 == 0, k), "en", "s", 1) for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).unionByName(table.select("doc_id", "text", "lang", "source", "n_chars"))
    labels = spark.createDataFrame([(r[0], int(k % 4 == 0)) for k, r in enumerate(rows)] + [(1, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in compression_toxicity(spark, docs, labels).collect() if r.doc_id is not None}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    held = [(got[r[0]].score, k % 4 == 0) for k, r in enumerate(rows) if got[r[0]].held_out]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.9 * len(held)
    assert {r.score for r in compression_toxicity(spark, docs, labels.filter("toxic = 0")).collect()} == {0.0}
    assert compression_toxicity(spark, docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("operator", [relative_lz_dedup, suffix_array_dedup, grouped_prefix_join, line_dedup, best_fit_packing])
def test_empty_table(spark, table, operator):
    assert operator(spark, table.limit(0)).count() == 0


def test_components_in_few_rounds(spark, monkeypatch):
    from folio.llm import jaccard_join as J

    rounds = []
    keep = J.written
    monkeypatch.setattr(J, "written", lambda s, df, name: (rounds.append(name), keep(s, df, name))[1])
    rng = random.Random(3)
    chain = [(k, k + 1) for k in range(499)]
    mixed = rng.sample(range(1000, 1500), 500)
    links = chain + list(zip(mixed, mixed[1:], strict=False)) + [(2000, k) for k in range(2001, 2100)] + [(5000, 5000), (7, 7)]
    forest = J.star_forest(spark, spark.createDataFrame(links, "a long, b long"))
    got = {r.a: r.b for r in forest.collect()}
    assert got == {k: 0 for k in range(1, 500)} | {k: 1000 for k in range(1001, 1500)} | {k: 2000 for k in range(2001, 2100)}
    assert rounds.count("stars") <= 2 * 12
    nodes = spark.createDataFrame([(k, 10_000 - k) for k in (*range(500), 5000)], "node long, label long")
    assert {r.node: r.label for r in J.labelled(nodes, forest).collect()} == {k: 9501 for k in range(500)} | {5000: 5000}


def test_scratch_tables_go_when_no_plan_reads_them(spark):
    from folio.llm import storage

    exists = lambda path: os.path.isdir(path.removeprefix("file:"))
    first = storage.written(spark, spark.range(5).toDF("x"), "scratch-a")
    one = storage._held[-1][2]
    derived = first.filter("x > 2").groupBy().count()
    del first
    second = storage.written(spark, spark.range(3).toDF("x"), "scratch-b")
    two = storage._held[-1][2]
    assert exists(one) and derived.collect()[0][0] == 2
    del derived
    for _ in range(5):
        storage.release(spark)
    assert not exists(one) and exists(two) and second.count() == 3


def test_neighbours_of_very_large_and_small_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0**600, 2.0**601]), (2, [2.0**-600, 2.0**-599]), (3, [2.0**-1074, 2.0**-1073]), (4, [-1.0, 2.0]), (50, [1.5e308, -1e308])]
    got = multiprobe_search(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    first = [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0]
    assert [v for v, _ in first] == [1, 2, 3, 4, 50]
    assert first[:3] == [(k, pytest.approx(1.0)) for k in (1, 2, 3)] and first[3][1] == pytest.approx(0.6)
    assert [(r.vec_id, r.score) for r in got if r.query_id == 50 and r["rank"] == 5] == [(4, pytest.approx(-3.5 / (3.25 * 5) ** 0.5))]
