"""First-fit packing: exact round trip of ids, no padding, no needless cuts; the tree against a plain search."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from folio.llm.first_fit import ByteIds, RoomTree, close_rooms, first_fit_decreasing, first_fit_packing, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def encode(texts):
    own = Tokenizer.from_file(tokenizer_path())
    return [[*own.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def padding(rows, capacity):
    total = {}
    for r in rows:
        total[r.sequence_id] = total.get(r.sequence_id, 0) + r.length
    assert all(0 < n <= capacity for n in total.values())
    return sum(capacity - n for n in total.values() if n.bit_count() > 1), total


def check(rows, docs, capacity):
    """Each id in one piece, ids as encoded, sequences without gaps or overlaps."""
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    ids = dict(zip([i for i, _ in docs], encode([t for _, t in docs]), strict=True))
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i]) and r.ids_crc32 == crc(ids[i][at:at + r.length])
            at += r.length
        assert at == len(ids[i])
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
    return by_doc


def corpus(n=400):
    rng = random.Random(2)
    text = lambda k: " ".join(rng.choice(["the", "Straße", "año", "tion", "12", "x.", "supercali"]) for _ in range(k))
    rows = [(k, text(rng.randrange(1, 120))) for k in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, text(3000)), (1003, "日本語 текст 🎈 " * 40), (1004, "a <|endoftext|> b"), (1005, "z" * 5000), (None, text(7)), (1006, " \n\n  \t x ")]


@pytest.mark.parametrize("capacity, group_rows", [(128, 50), (2048, 20_000), (96, 1000)])
def test_round_trip(spark, capacity, group_rows):
    docs = corpus()
    table = spark.createDataFrame([(i, t, None, "s", 1) for i, t in docs], SCHEMA).selectExpr("*", "1 as row", "2 as `group`", "3 as ids", "4 as length").repartition(3)
    rows = first_fit_packing(spark, table, capacity=capacity, group_rows=group_rows).collect()
    by_doc = check(rows, docs, capacity)
    waste, total = padding(rows, capacity)
    if capacity.bit_count() == 1:
        assert waste == 0
    groups = max(1, -(-len(docs) // group_rows))
    assert len(total) <= -(-sum(total.values()) // capacity) + groups * (capacity.bit_length() + 2)
    needless = sum(len(p) > 1 and p[0].doc_tokens <= capacity for p in by_doc.values())
    assert needless <= 0.1 * len(docs)


def test_repeated_rows_and_empty_table(spark):
    rows = first_fit_packing(spark, spark.createDataFrame([(5, "same words here")] * 40, "doc_id long, text string"), capacity=64).collect()
    n = rows[0].doc_tokens
    assert sum(r.length for r in rows) == 40 * n and padding(rows, 64)[0] == 0
    assert first_fit_packing(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ids_are_the_vocabularys_own():
    ids, own = ByteIds(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    assert ids.fast is not None
    rng = random.Random(6)
    latin = [chr(c) for c in range(0x240)]
    texts = ["".join(rng.choices(latin, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choices([" ", "\n", "\t", "a", "É", "'s", "'", "9", "½", "²", "ª", "\x85", "\xa0", "."], k=rng.randrange(40))) for _ in range(3000)]
    texts += [c + d + "x" for c in latin for d in (" ", "", "7")] + ["<|endoftext|>", "a<|endoftext|>b", "日本 x", "", "a" * 400_000, " " * 400_000, "ab " * 90_000, "\n" * 99_999]
    for t in texts:
        assert ids(t, np.frombuffer(t.encode(), np.uint8)).tolist() == own.encode(t, add_special_tokens=False).ids, t[:80]


def test_tree_is_first_fit():
    rng = np.random.default_rng(7)
    for trial in range(200):
        capacity = int(rng.integers(1, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 120)))
        room, plain = [], np.zeros(len(lengths), np.int64)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            at = next((b for b, r in enumerate(room) if r >= lengths[i]), None)
            if at is None:
                at = len(room)
                room.append(capacity)
            room[at] -= lengths[i]
            plain[i] = at
        assert first_fit_decreasing(lengths, capacity).tolist() == plain.tolist()
    tree = RoomTree(5, 10)
    assert [tree.take(tree.first(6), 6) for _ in range(5)] == [10] * 5 and tree.first(4) == 0


def test_rooms_are_closed():
    rng = np.random.default_rng(9)
    for trial in range(100):
        lengths = rng.integers(1, 64, int(rng.integers(1, 60)))
        held = {}
        for i, at in enumerate(first_fit_decreasing(lengths, 64).tolist()):
            held.setdefault(at, []).append((i, 0, int(lengths[i])))
        done = close_rooms(list(held.values()), 64)
        assert all(sum(n for _, _, n in b).bit_count() == 1 for b in done)
        spans = sorted((i, first, n) for b in done for i, first, n in b)
        for i, size in enumerate(lengths.tolist()):
            own = [(f, n) for j, f, n in spans if j == i]
            assert sum(n for _, n in own) == size and all(a + b == c for (a, b), (c, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0
