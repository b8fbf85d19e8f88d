"""The classifier's counts, ratios and fit against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np

from stratum.llm import columnar as C
from stratum.llm import toxicity as tox

WORDS = ["kind", "K\u00efnder", "idiot", "fool", "the", "of", "x1", "a", "\U0001f600\u00e9", "foolish", "id\u00edot", "than"]


def grams_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    found = set()
    for word in re.findall("[a-z0-9\u0080-\U0010ffff]+", lower):
        word = f"^{word}$"
        found |= {word[i:i + n] for n in (3, 4, 5, 6) for i in range(len(word) - n + 1)}
    return found


def hash_of(gram):
    data = np.frombuffer(gram.encode(), np.uint8)
    return int(C.span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def data():
    rnd = random.Random(7)
    docs, labels = [], []
    for k in range(300):
        bad = rnd.random() < 0.4
        pool = WORDS + (["idiot", "fool", "foolish"] * 3 if bad else ["kind", "of"] * 3)
        docs.append((k, " ,.".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))))
        labels.append((k, int(bad)))
    docs += [docs[5], docs[5], docs[9], (None, "fool"), (400, None)]            # repeated rows, no id, no text
    labels += [(900 + k, k % 2) for k in range(50)] + [(9, None), (11, 1), (400, 0)]    # no such document; null; twice
    return docs, labels


def test_ngram_counts(spark):
    docs, labels = data()
    rows = [(bool(toxic), text) for k, toxic in labels if toxic is not None for d, text in docs if d == k]
    want = {True: Counter(), False: Counter()}
    for toxic, text in rows:
        want[toxic].update(grams_of(text))
    got = tox.ngram_counts(spark.createDataFrame(rows, "toxic boolean, text string").repartition(3)).collect()
    assert {r["gram"] % 2 ** 64: (r["toxic"], r["clean"]) for r in got} \
        == {hash_of(g): (want[True][g], want[False][g]) for g in want[True] | want[False]}


def test_model(spark):
    """Chosen n-grams by the G-statistic, and weights at which the ridge loss has no slope."""
    docs, labels = data()
    held = {r[0] for r in spark.range(1000).where(tox.held_out(tox.F.col("id"))).collect()}
    rows = [(int(bool(toxic)), grams_of(text)) for k, toxic in labels if toxic is not None and k not in held
            for d, text in docs if d == k]
    bad, clean = Counter(), Counter()
    for toxic, grams in rows:
        (bad if toxic else clean).update(grams)
    t = sum(y for y, _ in rows)
    c = len(rows) - t

    def gain(g):
        a, b = bad[g], clean[g]
        cells = [(a, t * (a + b)), (b, c * (a + b)), (t - a, t * (t + c - a - b)), (c - b, c * (t + c - a - b))]
        return sum(k * math.log(k * (t + c) / n) for k, n in cells if k)

    often = [g for g in bad | clean if bad[g] + clean[g] >= tox.MIN_DOCS]
    grams, weights, intercept = tox.train(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"), max_features=30)
    weight = dict(zip((int(g) for g in grams), weights))
    gains = {hash_of(g): gain(g) for g in often}
    assert len(weight) == 30
    assert min(gains[g] for g in weight) >= max(v for g, v in gains.items() if g not in weight) - 1e-9
    names = {hash_of(g): g for g in often}
    ratio = {names[h]: math.log((bad[names[h]] + 1) / (t + 2)) - math.log((clean[names[h]] + 1) / (c + 2)) for h in weight}
    slope, rest = Counter(), 0.0
    for y, found in rows:
        z = intercept + sum(weight[hash_of(g)] for g in ratio if g in found)
        p = 1 / (1 + math.exp(-z))
        rest += p - y
        for g in ratio:
            if g in found:
                slope[g] += ratio[g] * (p - y)
    assert abs(rest) < 0.05
    for g, r in ratio.items():
        assert abs(slope[g] + tox.RIDGE * weight[hash_of(g)] / r) < 0.05, g
