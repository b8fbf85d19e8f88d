"""Operators against brute-force versions on small random data."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratum.llm import jaccard, linedup, mixing, pii, tokencount
from stratum.llm.decontam import contamination, phrase_starts
from stratum.llm.htmltext import main_text
from stratum.llm.jaccard import jaccard_components
from stratum.llm.linedup import aligned_blocks, dedup_lines, without_blocks
from stratum.llm.mixing import mix
from stratum.llm.pii import find_personal_data
from stratum.llm.quality import DUP_PCT, quality_rules
from stratum.llm.tokencount import LONG_SPACE, VOCABULARY, attribute, count_tokens, encoder, token_ends
from stratum.llm.toxicity import classify
from stratum.llm.urlfilter import judge_urls
from stratum.plans import Lineage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rnd, n, vocabulary):
    return [rnd.choice(vocabulary) for _ in range(n)]


def test_quality_counts(spark):
    rnd = random.Random(3)
    vocabulary = ["a", "bb", "c#", "é", "|x|"]
    texts = ["".join(w + rnd.choice([" ", "  ", "\n", "\t"]) for w in words_of(rnd, rnd.randint(0, 90), vocabulary))
             for _ in range(120)]
    got = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(
        list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    for i, t in enumerate(texts):
        ws = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert got[i]["n_words"] == len(ws) and got[i]["word_chars"] == sum(map(len, ws))
        assert got[i]["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert got[i]["n_dup_lines"] == len(lines) - len(set(lines))
        windows = [tuple(ws[k:k + 3]) for k in range(len(ws) - 2)]
        hit = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        assert got[i]["n_repeat_words"] == len(hit)
        assert got[i]["base_failed"] == (len(ws) < 50 or 100 * len(hit) > 50 * len(ws))
        for n in DUP_PCT:
            seen, cover = set(), set()
            for k in range(len(ws) - n + 1):
                w = tuple(ws[k:k + n])
                if w in seen:
                    cover.update(range(k, k + n))
                seen.add(w)
            assert got[i][f"dup{n}_chars"] == sum(len(ws[k]) for k in cover)


def test_url_rules(spark):
    rnd = random.Random(5)
    hosts = ["net", "a.net", "x.a.net", "b.org", "org", "xa.net", "a.net.", "A.Net:80", ""]
    paths = ["", "/", "/en", "/en/", "/en/x", "/e", "/de/a/b", "/en//x/"]
    rules = [("net", "/", "block"), ("a.net", "/en/", "allow"), ("a.net", "/e", "block"), ("org", "", "block"),
             ("b.org", "/de/a/", "allow")]
    urls = [f"http://{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '?q=/en/', '#/en/'])}" for _ in range(300)]
    got = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"),
                     spark.createDataFrame(rules, "host string, path string, action string")).collect()
    for r in got:
        rest = urls[r["page_id"]].split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = host.translate(LOWER)
        fits = [(len(h + p), len(h), a == "block", p, h + p, a) for h, p, a in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)] if host else []
        best = max(fits) if fits else None
        assert (r["host"], r["path"]) == (host, path)
        assert (r["rule"], r["verdict"]) == ((best[4], best[5]) if best else (None, "allow"))


@pytest.mark.parametrize("percent,width", [(80, 5), (60, 2)])
def test_jaccard_components(spark, percent, width):
    rnd = random.Random(percent)
    docs, vocabulary = [], [f"w{k}" for k in range(400)]
    passage = words_of(rnd, 30, vocabulary)
    for _ in range(25):
        base = words_of(rnd, rnd.randint(1, 80), vocabulary)
        for _ in range(rnd.choice([1, 1, 2, 12])):
            copy = list(base)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            docs.append(" ".join(copy if rnd.random() < 0.8 else copy + passage))
    docs += ["", "one", "ONE", "one two"]
    ids = rnd.sample(range(10_000), len(docs))
    sets = {}
    for i, t in zip(ids, docs):
        ws = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(ws[k:k + width]) for k in range(max(1, len(ws) - width + 1))} if ws else set()
    least = {i: i for i in ids}
    for _ in range(len(ids)):
        changed = False
        for i in ids:
            for j in ids:
                both = len(sets[i] & sets[j])
                if both and 100 * both >= percent * len(sets[i] | sets[j]) and least[j] < least[i]:
                    least[i], changed = least[j], True
        if not changed:
            break
    got = jaccard_components(spark.createDataFrame(list(zip(ids, docs)), "doc_id bigint, text string").repartition(5),
                             width=width, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} \
        == {i: (len(sets[i]), least[i]) for i in ids}


def brute_components(sets, percent):
    least = {i: i for i in sets}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] & sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    for _ in sets:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    return least


@pytest.mark.parametrize("percent", [80, 60])
def test_jaccard_families_near_the_threshold(spark, monkeypatch, percent):
    """Copies of a few texts, edited and cut so that pairs lie on both sides of the threshold, in many small parts."""
    monkeypatch.setattr(jaccard, "PART", 3)
    rnd = random.Random(percent + 1)
    docs = {}
    for base in range(3):
        text = [f"b{base}w{k}" for k in range(60)]
        places = rnd.sample(range(60), 12)
        for k in range(60):
            copy = list(text)
            for at in rnd.sample(places, rnd.randint(*((2, 6) if percent == 80 else (4, 11)))):
                copy[at] = f"e{rnd.randrange(3)}" if rnd.random() < 0.5 else f"own{base}x{k}x{at}"
            docs[rnd.randrange(10**6)] = " ".join(copy[rnd.choice([0, 0, 1, 3]):len(copy) - rnd.choice([0, 0, 2, 5])])
    sets = {i: {tuple(t.split()[k:k + 2]) for k in range(len(t.split()) - 1)} for i, t in docs.items()}
    want = brute_components(sets, percent)
    assert 10 < len(set(want.values())) < len(docs) - 10
    got = jaccard_components(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(3),
                             width=2, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def family(spark, n_sets, n_own):
    """Sets of 100 tokens, each with ``n_own`` of its own and the rest in all of them."""
    return spark.range(n_sets).select(
        F.col("id").alias("set_id"), F.col("id").alias("label"), F.lit(100).cast("bigint").alias("n"),
        F.transform(F.sequence(F.lit(1), F.lit(100 - n_own)), lambda k: F.struct(
            F.lit(n_sets).cast("bigint").alias("n_groups"), k.cast("bigint").alias("token"))).alias("foreign"))


def test_family_without_leader_asks_few_parts(spark):
    """A set whose own tokens leave no room for an equally large partner asks nobody, and parts grow with their number."""
    asks, members = jaccard.groups_to_ask(family(spark, 300, 12), 80)
    assert asks.count() == 0 and members.count() == 300
    asks, members = jaccard.groups_to_ask(family(spark, 20_000, 10), 80)
    parts = members.select("part").distinct().count()
    assert parts <= 142 and asks.count() <= 20_000 * parts


def near_copies(rnd, n_sets, n_tokens, edits):
    """Sets of n_tokens that each take ``edits`` tokens of their own in place of common ones."""
    common = list(range(1, n_tokens + 1))
    return {i: sorted(rnd.sample(common, n_tokens - edits) + [10**6 * (i + 1) + k for k in range(edits)])
            for i in range(n_sets)}


def test_new_links_are_a_spanning_forest():
    """A part of near copies makes fewer links than it has labels, and ties the same labels as all its pairs."""
    for edits in (4, 5, 6, 7):            # with 5 of 50 most pairs lie near the threshold
        rnd = random.Random(edits)
        sets = near_copies(rnd, 60, 50, edits)
        label = {i: i - i % rnd.choice([1, 1, 3]) for i in sets}
        rows = pd.DataFrame({"label": [label[i] for i in sets], "n": 50,
                             "tokens": [np.array(t, np.uint64).tobytes() for t in sets.values()]})
        a, b = jaccard.new_links(rows, rows, 80)
        assert len(a) < len(set(label.values()))
        every = {(label[i], label[j]) for i in sets for j in sets if i != j
                 and 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))}
        assert set(zip(a, b)) <= every

        def tied(links):
            least = {x: x for x in label.values()}
            for _ in least:
                for x, y in links:
                    least[x] = least[y] = min(least[x], least[y])
            return least

        assert tied(list(zip(a, b))) == tied(every)


def test_links_of_a_part_grow_with_its_size(spark):
    """A family of near copies in one part makes one link less than it has sets, of thousands of linked pairs."""
    tokens = near_copies(random.Random(3), 80, 50, 2)
    sets = spark.createDataFrame([(i, i, 7, 50, bytearray(np.array(t, np.uint64).tobytes())) for i, t in tokens.items()],
                                 "set_id bigint, label bigint, part bigint, n bigint, tokens binary")
    rows = sets.select("set_id", "label", "part")
    links = [tuple(r) for r in jaccard.open_groups(rows, rows, sets, 80).collect()]
    pairs = sum(100 * len({*tokens[i]} & {*tokens[j]}) >= 80 * len({*tokens[i]} | {*tokens[j]})
                for i in tokens for j in tokens if i < j)
    assert pairs > 3000 and len(links) == 79 and len({x for link in links for x in link}) == 80


def test_token_attribution(spark):
    ends, cuts = np.array([2, 5, 9, 10]), np.array([4, 8, 10])
    assert attribute(ends, cuts, "first") == (pytest.approx([2, 1, 1]), 2)
    assert attribute(ends, cuts, "most") == (pytest.approx([2, 1, 1]), 2)
    assert attribute(ends, cuts, "share") == (pytest.approx([1 + 2 / 3, 1 / 3 + 3 / 4, 1 / 4 + 1]), 2)
    docs = spark.createDataFrame([(1, "Title é", "line one\n\n\n  line two\n"), (2, None, "x")],
                                 "doc_id bigint, title string, body string")
    for rule in tokencount.RULES:
        rows = count_tokens(docs, fields=("title", "body"), rule=rule).orderBy("doc_id", "field", "section").collect()
        for doc, text in ((1, "Title é\nline one\n\n\n  line two\n"), (2, "\nx")):
            mine = [r for r in rows if r["doc_id"] == doc]
            assert sum(r["n_tokens"] for r in mine) == pytest.approx(len(tokencount.token_ends(text, VOCABULARY)))
            assert "".join(text[r["start"]:r["end"]] for r in mine) == text
            assert [r["field"] for r in mine] == sorted(r["field"] for r in mine)
    with pytest.raises(ValueError):
        count_tokens(docs, rule="last")


def test_main_text():
    plain = ("<body><div id=top><a href=x>Home</a> <a href=y>News</a></div><div id=c><p>First paragraph, which is long "
             "enough; it says a lot.</p><p>Second one, also long, with more to say.</p></div><div><a>more</a></div></body>")
    assert main_text(plain)[0] == ("First paragraph, which is long enough; it says a lot. "
                                   "Second one, also long, with more to say.")
    named = ("<header>Site</header><nav>menu</nav><main><h1>T&eacute;st&nbsp;1</h1><p>a<b>b</b> &lt;c&gt;<script>x='<p>'"
             "</script><br>d<div class='share-bar'>tweet</div><aside>side</aside><ul><li>one<li>two</ul>"
             "<section id=comments><p>I disagree, strongly, with this.</p></section></main><form>f<input></form>"
             "<div class=cookie-notice>We use cookies, of course.</div><footer>foot</footer>")
    assert main_text(named)[0] == "Tést 1 ab <c> d one two"


def test_main_text_takes_the_whole_container():
    ps = [f"Paragraph {k} " + "has words, and more of them; " * 14 + "end." for k in range(6)]
    body = "".join(f"<p>{p}</p>" for p in ps)
    want = lambda *around: " ".join([*around[0], *ps, *around[1]])
    side = "<div id=x><a href=1>Other</a> <a href=2>Pages</a></div>"
    page = f"<body>{side}<article><h1>Title</h1><div>By A. Writer</div><div>{body}</div></article>{side}</body>"
    assert main_text(page) == (want(["Title", "By A. Writer"], []), 8, "/body/article")
    page = (f"<body>{side}<article><header><h1>Title</h1><p>Standfirst</p><div><time>May</time></div></header>"
            f"<section>{body}</section></article></body>")
    assert main_text(page)[0] == want(["Title", "Standfirst", "May"], [])
    page = f"<body><article><div>{body}</div><ul><li>one<li>two</ul></article>{side}</body>"
    assert main_text(page)[0] == want([], ["one", "two"])
    page = (f"<body>{side}{body[:body.index('<p>', 3)]}<h2>Between</h2><ul><li>item</ul><div><a>link</a></div>"
            f"{body[body.index('<p>', 3):]}{side}</body>")
    assert main_text(page)[0] == " ".join([ps[0], "Between", "item", *ps[1:]])


def test_main_text_in_wrappers_named_as_boilerplate():
    ps = [f"Paragraph {k} " + "has words, and more of them; " * 14 + "end." for k in range(6)]
    body, text = "".join(f"<p>{p}</p>" for p in ps), " ".join(ps)
    side = "<div class=sidebar><p>Side text, of its own.</p></div>"
    for around in ('<div style="overflow:hidden">', "<div class='content has-sidebar'>", "<div class=no-comments>",
                   "<div title='not hidden'>", "<div data-x=none>"):
        assert main_text(f"<body>{around}{body}</div>{side}</body>")[0] == text, around
        assert main_text(f"<body>{around}<article>{body}{side}</article></div>{side}</body>")[0] == text, around
    assert main_text(f"<body><article class='post promo'><h1>T</h1>{body}</article>{side}</body>")[0] == f"T {text}"
    for gone in ("<div hidden>", "<div style='color:red; display: none'>", "<div style=visibility:hidden>",
                 "<div aria-hidden='true'>", "<nav>"):
        assert main_text(f"<body>{gone}{body}</{gone[1:4]}></div>{side}<p>Seen, at last, and long.</p></body>")[0] \
            == "Seen, at last, and long.", gone


def test_mixing(spark):
    rnd = random.Random(7)
    sources = ["b", "a", "é", "Z", None]
    rows = [(i, "w " * min(int(rnd.expovariate(0.01)), 2000), rnd.choices(sources, [60, 20, 10, 5, 5])[0])
            for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mix(docs.repartition(7)).collect()
    assert {tuple(r) for r in got} == {tuple(r) for r in mix(docs.repartition(2)).collect()}     # reruns agree
    size = {s: sum(t.count("w") for _, t, x in rows if x == s) for s in sources}
    order = sorted([s for s in sources if s is not None]) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, capped, total = dict(weight), set(), 1.5 * sum(size.values())
    while True:
        level = (total - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in left)
        over = {s for s in left if weight[s] * level > 2 * size[s]}
        if not over:
            break
        capped |= over
        left = {s: w for s, w in left.items() if s not in over}
    target = {s: 2 * size[s] if s in capped else weight[s] * level for s in sources}
    source = {i: s for i, _, s in rows}
    taken = dict.fromkeys(sources, 0)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == size[s] and r["target"] == pytest.approx(target[s])
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        taken[s] += r["taken"]
    for s in sources:
        assert abs(taken[s] - target[s]) <= 1000


def test_toxicity_learns_and_ignores_held_out_labels(spark):
    rnd = random.Random(11)
    clean = ["bread", "water", "morning", "oron", "house", "green", "river", "stone"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        ws = words_of(rnd, rnd.randint(5, 60), clean) + (words_of(rnd, 2, ["moron", "Idiots", "scumbag"]) if toxic else [])
        rnd.shuffle(ws)
        rows.append((i, " ".join(ws)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    with_labels = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = classify(docs, with_labels).collect()
    held = [r for r in got if r["held_out"]]
    assert 100 < len(held) < 200
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held) >= 0.98 * len(held)
    flipped = with_labels.withColumn("toxic", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {tuple(r) for r in classify(docs, flipped).collect()} == {tuple(r) for r in got}


def test_contamination(spark):
    rnd = random.Random(13)
    vocabulary = ["a", "B", "c", "dé", "e1"]
    items = [(k, " ".join(words_of(rnd, rnd.choice([0, 2, 3, 6, 12]), vocabulary))) for k in range(12)]
    docs = [(k, "- ".join(words_of(rnd, rnd.randint(0, 40), vocabulary))) for k in range(150)]
    got = {r["doc_id"]: r for r in contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4),
        spark.createDataFrame(items, "item_id bigint, text string"), window=4).collect()}
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(LOWER))
    for i, t in docs:
        ws, hit, found = split(t), set(), set()
        for item, u in items:
            us = split(u)
            for w in {tuple(us[k:k + 4]) for k in range(max(1, len(us) - 3))} - {()}:
                for k in range(len(ws) - len(w) + 1):
                    if tuple(ws[k:k + len(w)]) == w:
                        hit.update(range(k, k + len(w)))
                        found.add(str(item))
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["item_ids"]) == (len(ws), len(hit), sorted(found))


def test_proximity(spark):
    first, last = phrase_starts([np.array([0, 10, 20]), np.array([1, 12, 29]), np.array([2, 13, 30])], slop=1)
    assert list(zip(first, last)) == [(0, 2), (10, 13)]
    docs = spark.createDataFrame([(1, "red big fox"), (2, "red fox"), (3, "fox red"), (4, "red x y z fox")],
                                 "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "red fox")], "item_id bigint, text string")
    hits = {r["doc_id"]: r["n_hit"] for r in contamination(docs, items, slop=1).collect()}
    assert hits == {1: 3, 2: 2, 3: 0, 4: 0}


def test_pii_seeds():
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    digits = lambda m: re.sub("[^0-9]", "", m[0])

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    rnd = random.Random(17)
    pieces = ["a", "@", ".", "-", " ", "1", "25", "300", "+", "(", ")", "1.2.3.4", "4111111111111111",
              "4111 1111-1111 1111", "x@y.z", "\n", "é", "٣"]
    for _ in range(20_000):
        t = "".join(words_of(rnd, rnd.randint(1, 14), pieces))
        want = [(0, *m.span()) for m in email.finditer(t)] \
            + [(1, *m.span()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))] \
            + [(2, *m.span()) for m in card.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))] \
            + [(3, *m.span()) for m in phone.finditer(t) if 8 <= len(digits(m)) <= 15]
        assert pii.seed_spans(t, [m.span() for m in pii.CLUSTER.finditer(t)]) == want


def test_pii_bootstrap(spark):
    seeds = [(k, f"please call me +1 555 010 {1000 + k} today") for k in range(5)]
    rows = seeds + [(10, "please call me 555 010 7777 today"), (11, "order number 555 010 8888 shipped"),
                    (12, "again 555 010 7777 here"), (13, "please call me +1 555 010 1000 today")]
    got = {r["doc_id"]: r for r in find_personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    spans = {i: [tuple(s) for s in r["spans"]] for i, r in got.items()}
    assert got[10]["base"] == [] and spans[10] == [(3, 15, 27)]        # unseen, in a seed's context
    assert spans[11] == [] and spans[12] == [(3, 6, 18)]               # the same number elsewhere
    assert all(spans[k] == [tuple(s) for s in got[k]["base"]] and len(spans[k]) == 1 for k in range(5))
    few = spark.createDataFrame(seeds[:1] * 9 + rows[5:7], "doc_id bigint, text string")
    assert all(r["spans"] == r["base"] for r in find_personal_data(few).collect())    # copies do not vote


def test_pii_strays_and_second_hop(spark):
    rows = [(k, f"please call me +1 555 010 {1000 + k} today") for k in range(20)]
    rows += [(20, "please call me x@y.org today")]                                       # a stray of another kind
    rows += [(30 + k, f"please call me 555 010 777{k} today") for k in range(3)]
    rows += [(40 + k, f"the fax line 555 010 777{k} here") for k in range(3)]
    rows += [(50, "the fax line 555 010 9999 here"), (51, "order number 555 010 8888 shipped")]
    got = {r["doc_id"]: len(r["spans"]) for r in find_personal_data(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: int(i != 51) for i, _ in rows}


def test_aligned_blocks():
    """Blocks hold exactly the windows of b that a has, and each is a run of equal words."""
    rnd = random.Random(19)
    for trial in range(300):
        letters = 3 if trial % 2 else 60
        a = np.array([rnd.randrange(letters) for _ in range(rnd.randint(0, 60))], np.uint32)
        b = np.array([rnd.randrange(letters) for _ in range(rnd.randint(0, 60))], np.uint32)
        if trial % 3 == 0 and len(a) > 20 and len(b) > 20:
            b[3:12], b[14:20] = a[10:19], a[2:8]            # swapped
        blocks = aligned_blocks(a, b, 4)
        windows = {tuple(a[k:k + 4]) for k in range(len(a) - 3)}
        held = {k + j for k in range(len(b) - 3) if tuple(b[k:k + 4]) in windows for j in range(4)}
        assert held == {k for x, y in blocks for k in range(x, y)}
        for x, y in blocks:
            assert any(np.array_equal(a[i:i + y - x], b[x:y]) for i in range(len(a) - (y - x) + 1))
    chain = aligned_blocks(np.arange(20, dtype=np.uint32), np.r_[90:95, 0:8, 95:97, 12:20].astype(np.uint32), 4)
    assert sorted(chain) == [(5, 13), (15, 23)]


def test_line_dedup(spark):
    rnd = random.Random(23)
    passage = [" ".join(f"p{k}x{j}" for j in range(12)) + rnd.choice(".!?") for k in range(5)]
    own = lambda i: [" ".join(f"d{i}l{k}w{j}" for j in range(9)) + "." for k in range(4)]
    slogan = "Best shop in town."
    texts = {}
    for i in range(12):
        lines = own(i)
        lines.insert(2, slogan)
        if i % 3 == 0:
            lines[1:1] = passage
        texts[i] = rnd.choice(["\n", " "]).join(lines)
    texts[20] = texts[0]
    texts[21] = "\n ".join(own(21)) + " " + " ".join(passage[1:4]) + " tail of its own"
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(
        list(texts.items()), "doc_id bigint, text string").repartition(4)).collect()}
    for i in range(12):
        gone = passage if i % 3 == 0 and i else []
        left = texts[i]
        for p in gone:
            left = re.sub(re.escape(p) + r"\s*", "", left)
        assert got[i] == left, i
        assert slogan in got[i]
    assert got[20] == ""
    assert got[21] == "\n ".join(own(21)) + " tail of its own"


def kept_texts(spark, texts, **options):
    return {r["doc_id"]: r["text"] for r in dedup_lines(
        spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3), **options).collect()}


def test_line_dedup_cuts_parts_of_sentences(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    before, after = " ".join(f"b{k}" for k in range(40)), " ".join(f"a{k}" for k in range(40))
    got = kept_texts(spark, [
        (1, f"x y {passage} z."), (2, f"{before} {passage} {after}"), (3, f"{before}x\n{passage.replace(' ', '  ')}"),
        (4, "One two. " + " ".join(passage.split()[:29])), (5, "One three. " + " ".join(passage.split()[:30]) + " q")])
    assert got == {1: f"x y {passage} z.", 2: f"{before} {after}", 3: "b39x\n",
                   4: "One two. " + " ".join(passage.split()[:29]), 5: "One three. q"}


def words_left(t, seen, n):
    """Places of the words of ``t`` in windows of ``n`` words that ``seen`` holds; adds the windows of ``t``."""
    ws = WORD.findall(t)
    windows = [tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)]
    gone = {k + j for k, w in enumerate(windows) if w in seen for j in range(n)}
    seen.update(windows)
    return ws, gone


def test_line_dedup_brute_force(spark):
    """Only words in windows of an earlier document are cut, and at least 0.9 of them."""
    rnd = random.Random(29)
    passages = [words_of(rnd, rnd.randint(31, 90), [f"{c}{k}{'.' * (k % 9 == 0)}" for c in "abé" for k in range(40)]) for _ in range(15)]
    texts = []
    for i in range(60):
        ws = [f"own{i}x{k}" for k in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 8)
            ws[len(ws) // 2:len(ws) // 2] = p[a:len(p) - rnd.randint(0, 8)]
        texts.append((i, "".join(w + rnd.choice([" ", "  ", "\n"]) for w in ws)))
    rows = {r["doc_id"]: r for r in dedup_lines(
        spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)).collect()}
    seen, all_gone, all_cut = set(), 0, 0
    for i, t in texts:
        _, gone = words_left(t, seen, 30)
        spans = [m.span() for m in WORD.finditer(t)]
        cut = {k for k, (x, _) in enumerate(spans) for lo, hi in rows[i]["cuts"] if lo <= x < hi}
        assert cut <= gone
        ends = [x for x, _ in spans[1:]] + [len(t)]
        assert rows[i]["text"] == "".join(t[x:e] for k, ((x, _), e) in enumerate(zip(spans, ends)) if k not in cut)
        all_gone, all_cut = all_gone + len(gone), all_cut + len(cut)
    assert all_gone > 1000 and all_cut >= 0.9 * all_gone


def test_line_dedup_recall_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
    cuts = {r["doc_id"]: r["cuts"] for r in dedup_lines(docs).collect()}
    seen, all_gone, all_cut = set(), 0, 0
    for i, t in texts:
        _, gone = words_left(t, seen, 30)
        cut = {k for k, m in enumerate(WORD.finditer(t)) for lo, hi in cuts[i] if lo <= m.start() < hi}
        assert cut <= gone
        all_gone, all_cut = all_gone + len(gone), all_cut + len(cut)
    assert all_cut >= 0.9 * all_gone


def test_only_repeated_lines_are_paired(spark):
    """Lines of one id stay out of the pairs' aggregate and joins; each line of several ids is there with all its rows."""
    passage = " ".join(f"p{k}" for k in range(50))
    texts = [(i, " ".join(f"d{i}w{k}" for k in range(200)) + ". " + (passage if i % 4 == 0 else "")) for i in range(40)]
    texts += [(50, texts[1][1]), (50, texts[2][1])]
    keyed = spark.createDataFrame(texts, "doc_id bigint, text string") \
        .select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = [tuple(r) for r in linedup.document_lines(keyed, 30).collect()]
    holders = {}
    for i, _, line, _ in rows:
        holders.setdefault(line, set()).add(i)
    want = {r for r in rows if len(holders[r[2]]) > 1}
    got = {tuple(r) for r in linedup.repeated_lines(keyed, Lineage(spark, every=1), 30).collect()}
    assert want and want <= got <= set(rows) and len(got) < len(want) + 0.05 * len(rows)


def test_last_words():
    rnd = random.Random(31)
    for _ in range(200):
        docs = ["".join(rnd.choices(["a", "b.", "c!", " ", "  ", "\n", " \n", "x\ty"], k=rnd.randint(0, 12))).encode() for _ in range(4)]
        offs = np.cumsum([0] + [len(d) for d in docs])
        data = np.frombuffer(b"".join(docs), np.uint8)
        start, end, doc = linedup.C.spans(linedup.C.WORD_BYTES[data], offs)
        if not len(start):
            continue
        text = b"".join(docs)
        want = [k + 1 == len(start) or doc[k + 1] != doc[k] or text[end[k] - 1:end[k]] in (b".", b"!", b"?")
                or b"\n" in text[end[k]:start[k + 1]] for k in range(len(start))]
        assert linedup._last_words(data, start, end, doc).tolist() == want


def test_without_blocks():
    text = "é one. two three\nfour  five. six"
    left, cuts, lines = without_blocks(text.encode(), [{"first": 2, "stop": 4}, {"first": 3, "stop": 5}])
    assert (left.decode(), cuts, lines) == ("é one. five. six", [[7, 23]], 2)
    long = " ".join(f"w{k}" for k in range(200_000))
    left, cuts, lines = without_blocks(long.encode(), [{"first": k, "stop": k + 30} for k in range(0, 199_000, 60)])
    assert len(left.split()) == 200_000 - 30 * len(cuts) and lines == 1


def test_line_dedup_swapped_and_doubled_passages(spark):
    part = lambda name, n: " ".join(f"{name}{k}{'.' if k % 8 == 7 else ''}" for k in range(n))
    p, q = part("p", 48), part("q", 40)
    got = kept_texts(spark, [(1, f"Own one. {p} Between. {q} End."), (2, f"Own two. {q} Middle. {p} Last."),
                             (3, f"Own three. {p} Once more. {p} And {q} Over.")])
    assert got == {1: f"Own one. {p} Between. {q} End.", 2: "Own two. Middle. Last.",
                   3: "Own three. Once more. And Over."}


def test_long_white_space_is_one_piece():
    """Texts with long runs of white space have the tokens of the whole text, and a million blanks end no task."""
    encode, _, lengths = encoder(VOCABULARY)
    rnd = random.Random(5)
    for gap in (" " * LONG_SPACE, "\n" * (LONG_SPACE + 3), " \n\t\u00a0" * LONG_SPACE, "\u2003" * LONG_SPACE):
        for text in (gap, "a" + gap, gap + "b", f"one two{gap}three  {gap}!{gap}4 it's", f"x{gap}\u3000y \x1c{gap}z"):
            text = text + "".join(rnd.choices("ab 1.\n", k=50))
            want = np.cumsum(lengths[np.asarray(encode(text), np.int64)])
            assert np.array_equal(token_ends(text, VOCABULARY), want), (gap[:2], len(text))
    for gap in (" " * 1_500_000, "\n" * 1_500_000):
        assert token_ends(f"a{gap}b", VOCABULARY)[-1] == 1_500_002


@pytest.mark.parametrize("rule", ["first", "most", "share"])
def test_token_counts_brute_force(spark, rule):
    """Every byte is given to its token and its section one by one."""
    rnd = random.Random(11)
    texts = ["".join(rnd.choices(["word", " ", "\n", "\n\n", "é", "字", "12", ".", "  \n "], k=rnd.randint(0, 60)))
             for _ in range(60)]
    encode, _, lengths = encoder(VOCABULARY)
    got = count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), rule=rule).collect()
    got = {(r["doc_id"], r["section"]): (r["n_tokens"], text_of(texts[r["doc_id"]], r)) for r in got}
    for i, text in enumerate(texts):
        lines = text.split("\n")
        lines = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        owner = [k for k, line in enumerate(lines) for _ in line.encode()]
        counts, at = [0.0] * len(lines), 0
        for token in encode(text):
            mine = owner[at:at + int(lengths[token])]
            at += int(lengths[token])
            if rule == "first":
                counts[mine[0]] += 1
            elif rule == "most":
                counts[max(sorted(set(mine)), key=lambda k: mine.count(k))] += 1
            else:
                for k in mine:
                    counts[k] += 1 / len(mine)
        assert [got[i, k][1] for k in range(len(lines))] == lines
        assert [got[i, k][0] for k in range(len(lines))] == pytest.approx(counts)


def text_of(text, row):
    return text[row["start"]:row["end"]]


def test_comments_are_not_spared_for_their_size():
    said = "".join(f"<p>I think, and many agree, that number {k} is wrong.</p>" for k in range(9))
    body = "<p>The article, which is short, has two sentences. This is one.</p><p>And a second paragraph, too.</p>"
    text = "The article, which is short, has two sentences. This is one. And a second paragraph, too."
    assert main_text(f"<body><div>{body}</div><div class=comments>{said}</div></body>")[0] == text
    assert main_text(f"<body><article>{body}</article><article class=comment>{said}</article></body>")[0] == text
    assert main_text(f"<body><div class='page comments-open'>{body}</div><div id=disqus>{said}</div></body>")[0] == text
    assert main_text(f"<body><div class=comment-page><article>{body}</article></div><p>Tag line</p></body>")[0] == text
    assert main_text(f"<body><div class=comments>{body}</div></body>")[0] == text       # all that there is


def test_deeply_nested_page():
    begin = time.time()
    page = "<body>" + "".join(f"<div>word {k}, more." for k in range(8000)) + "</div>" * 8000 + "</body>"
    text, blocks, _ = main_text(page)
    assert blocks >= 1 and text.startswith("word ") and time.time() - begin < 10


def test_mixing_spreads_equal_rows(spark):
    """Rows with no id, equal or not, fall into many blocks; the sums hold, and reruns agree."""
    docs = spark.createDataFrame([(None, "w " * 7, "a")] * 9000 + [(None, f"w w v{k}", "b") for k in range(500)],
                                 "doc_id bigint, text string, source string")
    rows = mixing._numbered(docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"),
                                        F.lit(7).cast("bigint").alias("size")))
    assert rows.count() == 9500 and rows.select("text_key", "nth").distinct().count() == 9500
    block = F.pmod(F.xxhash64("doc_id", "size", "text_key", "nth"), F.lit(148))
    assert rows.groupBy(block).count().agg(F.max("count")).first()[0] < 150
    def total(parts):
        return sorted((r["source_size"], r["copies"], r["taken"]) for r in mix(docs.repartition(parts)).collect())
    first = total(3)
    assert first == total(5) and len(first) == 9500
    for size, target in ((63000, 1.5 * 64500 - 3000), (1500, 3000)):
        assert abs(sum(t for s, _, t in first if s == size) - target) <= 7


def test_slop_bound(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    for slop in (-1, 5000):
        with pytest.raises(ValueError):
            contamination(docs, items, slop=slop)


def test_contexts_at_any_distance():
    def brute(text, a, b):
        left = [w.lower() for w in pii.WORD.findall(text[:a])][-2:]
        right = pii.WORD.search(text[b:])
        return (pii._key(" ".join(left)) if len(left) == 2 else None,
                pii._key(f"{left[-1]} _ {right[0].lower()}") if left and right else None)
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choices(["call", "Me", " ", " ", "é", "x" * 90, "-" * 100, "1", "."], k=12))
        a = rnd.randrange(len(text))
        b = rnd.randrange(a + 1, len(text) + 1)
        got = pii._contexts(text, [(1, True, a, b)])[0]
        assert (got["before2"], got["around"]) == brute(text, a, b), (text, a, b)
