"""Prefix trie, SimHash classes and fill-in-middle against brute force, with edge cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from stratum.llm import fim, simhash
from stratum.llm.convtrie import numbered_turns, prefix_trie, shared_heads
from stratum.plans import Lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = ["n", "node", "fp", "start", "key", "value", "block", "k0", "t1", "pos", "conv", "form", "output", "depth",
           "component_id", "base", "h", "at", "one", "n_children"]


def clashing(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


def trie(conversations, width=8):
    turns = Lineage(conversations.sparkSession, 1).cut(numbered_turns(conversations), force=True)
    return prefix_trie(*shared_heads(turns), width)


def brute_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    nodes, children, out = defaultdict(list), defaultdict(list), set()
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    for p in nodes:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = sum(saved[k] for k in children[p]) + ((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0)
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        out.add((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("width", [8, 3])
def test_prefix_trie(spark, width):
    rnd = random.Random(4 + width)
    rows = [(c, t, rnd.choice([None, "user", "a"]), rnd.choice(["hi there", "", "x y z", None]))
            for c in range(70) if c != 20 for t in range(rnd.choice([1, 1, 2, 3, 5, 9, 17, 30]))]
    rows += [(7, None, "user", "first"), (None, 1, "user", "x"), (5, 0, "user", "same"), (5, 0, "user", "same")]
    rows += [(90, t, "user", "long " * 20_000 if t == 3 else "w") for t in range(200)]
    rows += [(91, t, "user", "long " * 20_000 if t == 3 else "w") for t in range(190)]
    rnd.shuffle(rows)
    rows = [r for r in rows if r[0] != 5 or r[1] is None or r[1] > 0 or r[3] == "same"]    # equal turns are equal rows
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = [tuple(r) for r in trie(clashing(df), width).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)


def test_prefix_trie_defined_cases(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert trie(spark.createDataFrame([], schema)).collect() == []
    assert trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).collect() == []
    # 1 has fewer turns than it takes from the absent 0, so it is left without any
    assert zlib.crc32(b"1") % 4 > 1
    root, = trie(spark.createDataFrame([(1, 0, "a", "b")], schema)).collect()
    assert tuple(root) == (1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())


def brute_fingerprint(text):
    ws = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(ws[k:k + 4]) for k in range(len(ws) - 3)] if len(ws) >= 4 else [" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def near(fps, budget):
    parent = {i: i for i in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in fps:
        for y in fps:
            if x < y and (fps[x] ^ fps[y]).bit_count() <= budget and find(x) != find(y):
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    return {i: find(i) for i in fps}


@pytest.mark.parametrize("bucket,chain,budget", [(64, None, 4), (1, None, 4), (2, 3, 4), (1, 1, 5), (64, 2, 6)])
def test_simhash_classes(spark, bucket, chain, budget):
    rnd = random.Random(2)
    base = [[rnd.choice(["Ab", "cd", "é", "x1", "yy", "Z"]) + str(rnd.randint(0, 60)) for _ in range(rnd.randint(1, 60))]
            for _ in range(40)]
    docs = []
    for i in range(300):
        ws = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            ws[rnd.randrange(len(ws))] = f"w{rnd.randint(0, 5)}"
        docs.append((i, rnd.choice([" ", "\n ", "\t"]).join(ws)))
    docs += [(300, None), (301, " \n"), (303, ""), (304, "one two"), (305, " ".join(f"v{k % 997}" for k in range(90_000)))]
    fps = {i: brute_fingerprint(t) for i, t in docs}
    docs += [(None, "a b c d e"), (304, "one two")]
    df = clashing(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4))
    got = simhash.simhash_classes(df, budget=budget, bucket=bucket, chain=chain).collect()
    assert len(got) == len(docs)
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    want = near(fps, budget)
    assert len(set(want.values())) < len(set(fps.values()))
    for r in got:
        if r["doc_id"] is not None:
            assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}"
            assert r["component_id"] == want[r["doc_id"]]


def test_simhash_defined_cases(spark):
    schema = "doc_id bigint, text string"
    assert simhash.simhash_classes(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "alpha beta gamma delta epsilon"), (2, "one two three four five"), (2, "alpha beta gamma delta epsilon"),
            (3, "one two three four five")]
    got = simhash.simhash_classes(spark.createDataFrame(rows, schema)).collect()
    assert {r["component_id"] for r in got} == {1}      # id 2 has both texts
    with pytest.raises(ValueError):
        simhash.simhash_classes(spark.createDataFrame(rows, schema), budget=0)


def test_ring_of_segments():
    """Any difference within the budget keeps the budgets of all chains from some start."""
    rnd = random.Random(1)
    for budget in (1, 3, 4, 7):
        sizes = simhash.ring(budget)
        assert sum(sizes) == 64
        for _ in range(300):
            bits = rnd.sample(range(64), budget)
            ends = [sum(sizes[:k + 1]) for k in range(len(sizes))]
            per = [sum(1 for b in bits if ends[k] - sizes[k] <= b < ends[k]) for k in range(len(sizes))]
            turned = [per[k:] + per[:k] for k in range(len(per))]
            assert any(all(sum(t[:n]) <= simhash.allowed(n, len(sizes), budget) for n in range(1, len(sizes) + 1))
                       for t in turned)


def brute_fim(i, text):
    x = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    text = text or ""
    n = len(text)
    a, b, c, d = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return i, n, "plain", None, None, text, text
    p, m, s = text[:lo], text[lo:hi], text[hi:]
    if d % 100 < 20:
        return i, n, "spm", lo, hi - lo, f"<S>{s}<P>{p}<M>{m}", text
    return i, n, "psm", lo, hi - lo, f"<P>{p}<S>{s}<M>{m}", text


def test_fill_in_middle(spark):
    rnd = random.Random(6)
    texts = ["", None, "a", "é😀 ünï\ncode 漢字. " * 20, "<", "<S", "<P>x", ">", "S><", "<<<SSS>", "y" * 2_000_000]
    texts += ["".join(rnd.choice("<SPM >aé😀\n") for _ in range(rnd.randint(0, 30))) for _ in range(600)]
    rows = [*enumerate(texts), (None, "no id here"), (3, "tie"), (3, "tie")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = fim.restore(fim.fill_in_middle(clashing(df))).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str(brute_fim(*r)) for r in rows)
    assert {r["form"] for r in got} == {"plain", "spm", "psm"}
    assert fim.restore(fim.fill_in_middle(df.limit(0))).collect() == []


def test_other_sentinels(spark):
    marks = ("⟨pre⟩", "⟨suf⟩", "⟨mid⟩")
    df = spark.createDataFrame([(k, f"text {k} of some length") for k in range(200)], "doc_id bigint, text string")
    out = fim.restore(fim.fill_in_middle(df, percent=100, spm_percent=50, seed=9, sentinels=marks), sentinels=marks)
    rows = out.collect()
    assert all(r["restored"] == f"text {r['doc_id']} of some length" and r["form"] != "plain" for r in rows)
    for bad in (("<a", "a>", "b"), ("", "a", "b"), ("ab", "bc", "d"), ("x", "axb", "c"), ("a<a", "b", "c")):
        with pytest.raises(ValueError):
            fim.check_sentinels(list(bad))


def test_units_are_code_points():
    texts = pa.array(["", "aé😀", "漢"]).slice(1)
    assert fim.units(texts).to_pylist() == [["a", "é", "😀"], ["漢"]]
