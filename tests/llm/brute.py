"""Plain definitions of the operators' results, for small inputs only."""

from __future__ import annotations

import hashlib
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def substring_dedup(rows: list[tuple], n: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) of (doc_id, text) rows."""
    first: dict[tuple, int] = {}
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - n + 1) if i is not None else ():
            g = tuple(w[k:k + n])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - n + 1) if i is not None else ():
            if first[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def suffix_dedup(rows: list[tuple], n: int = 400) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        for k in range(len(b) - n + 1):
            seen[b[k:k + n]] = seen.get(b[k:k + n], 0) + 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k:k + n]] > 1:
                gone[k:k + n] = b"\1" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def line_dedup(rows: list[tuple], least: int = 40, min_docs: int = 5) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept_sha256)."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    found: dict[str, list[int]] = {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")} if i is not None else ():
            if len(k) >= least:
                found.setdefault(k, []).append(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(found.get(key(x), ())) < min_docs or max(found[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, size: int = 3) -> frozenset:
    w = WORDS.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard_components(rows: list[tuple], percent: int = 90) -> list[tuple]:
    """(doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    holders: dict[tuple, list[int]] = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        shared: dict[int, int] = {}
        for g in s:
            for j in holders[g]:
                if j < k:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[find(k)] = find(j)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(s), least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]
