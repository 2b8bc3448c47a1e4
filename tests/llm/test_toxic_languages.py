"""Toxicity where one language has nearly all of the toxic documents."""

import random

import numpy as np

from folio.llm.toxicity import _packed, fit


def texts(seed, n, lang, toxic):
    rng = random.Random(seed)
    syllables = ["ba", "ko", "lu", "mi", "ne", "ra", "so", "ti"] if lang == "x" else ["cha", "fro", "gul", "hep", "jix", "wod", "yab", "zun"]
    usual = ["".join(random.Random(f"{lang}{k}").choice(syllables) for _ in range(3)) for k in range(300)]
    vile = {"x": ["vilenessy", "rottenhide", "grubsnout"], "y": ["qualdring", "quombeast", "quizzfoul", "quelpmire"]}[lang]
    out = []
    for _ in range(n):
        words = [rng.choice(usual) for _ in range(50)]
        for w in rng.sample(vile, 2) if toxic else ():
            words[rng.randrange(50)] = w
        out.append(" ".join(words))
    return out


def test_recall_by_language():
    made = fit(texts(1, 760, "x", True) + texts(2, 40, "y", True), texts(3, 1200, "x", False) + texts(4, 400, "y", False))
    scores = {(lang, toxic): made.scores(*_packed([t.encode() for t in texts(9, 100, lang, toxic)])) for lang in "xy" for toxic in (True, False)}
    recall = {lang: float(np.mean(scores[lang, True] >= 0.5)) for lang in "xy"}
    assert recall["x"] >= 0.95 and recall["y"] >= 0.9, recall
    assert all(np.mean(scores[lang, False] >= 0.5) <= 0.03 for lang in "xy")


def test_many_telling_stems_all_stay():
    rng = random.Random(3)
    words = ["".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(6)) for _ in range(400)]
    toxic = [" ".join(rng.choice(["plain", "usual", "words"]) for _ in range(40)) + " " + " ".join(rng.sample(words, 70)) for _ in range(400)]
    made = fit(toxic, [" ".join(rng.choice(["plain", "usual", "words"]) for _ in range(60)) for _ in range(400)])
    held = set(made.toxic.split())
    assert all(any(w.decode().startswith(p) or p.startswith(w.decode()) for w in held) for p in words)


def test_ordinary_dictionary_learns_from_whole_texts():
    rng = random.Random(5)
    early, late = ([f"{p}{rng.randrange(10**6)}" for _ in range(40)] for p in ("early", "lately"))
    usual = [" ".join([rng.choice(early) for _ in range(320)] + [rng.choice(late) for _ in range(320)]) for _ in range(60)]
    made = fit([t + " vilenessy" for t in usual[:20]], usual[20:])
    assert b"early" in made.ordinary and b"lately" in made.ordinary
