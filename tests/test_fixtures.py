"""Hand-built fixtures with known results (FIXTURES.md), one per operator
family, including the traps and defects listed in the survey."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratum.operators import bits, cells, graphs, ordered, ranges, reshape, spatial


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_steps_hits_and_crossings(spark):
    df = spark.createDataFrame([(1, 50), (2, -100), (3, 250)], "ord long, delta long")
    hits = ordered.running_residue_hits(df, ["ord"], "delta", 50, 100, 0)
    assert hits.first()["hits"] == 2
    cross = ordered.modulus_crossings(df, ["ord"], "delta", 50, 100)
    assert cross.first()["crossings"] == 4
    tot = ordered.running_total(df, ["ord"], "delta", 50)
    assert [r["total"] for r in tot.orderBy("ord").collect()] == [100, 0, 250]


def test_two_level_scan_matches_plain_window(spark):
    data = [(k % 3, i, (i * 37) % 11 - 5) for i in range(200) for k in [i]]
    df = spark.createDataFrame(data, "k long, o long, v long").withColumn("b", F.col("o") / 17)
    df = df.withColumn("b", F.floor("b"))
    for agg in ("sum", "max", "min"):
        for excl in (False, True):
            a = ordered.ordered_scan(df, ["o"], "v", "x", agg, ["k"], "b", excl)
            b = ordered.ordered_scan(df, ["o"], "v", "x", agg, ["k"], None, excl)
            assert rows(a, "k", "o", "x") == rows(b, "k", "o", "x")


def test_block_ranges(spark):
    r = spark.createDataFrame([(1, 8, 25), (2, 95, 115)], "range_id long, lo long, hi long")
    twice = ranges.block_repeat_ids(r, "range_id", "lo", "hi", "twice")
    assert sum(int(x["sum_ids"]) for x in twice.collect()) == 132
    anyrep = ranges.block_repeat_ids(r, "range_id", "lo", "hi", "any")
    assert sum(int(x["sum_ids"]) for x in anyrep.collect()) == 243


def test_block_repeat_closed_form_equals_regex(spark):
    r = spark.createDataFrame([(1, 1, 5000), (2, 99990, 112000), (3, 5, 3)],
                              "range_id long, lo long, hi long")
    closed = ranges.block_repeat_ids(r, "range_id", "lo", "hi", "any")
    ids = (r.where("lo <= hi").select("range_id", F.explode(F.sequence("lo", "hi")).alias("id")))
    brute = (ranges.block_repeat_filter(ids, "id").groupBy("range_id")
             .agg(F.count("*").alias("n_ids"), F.sum("id").alias("sum_ids")))
    assert rows(closed, "range_id", "n_ids") == rows(brute, "range_id", "n_ids")
    assert sorted(int(x["sum_ids"]) for x in closed.collect()) == sorted(x["sum_ids"] for x in brute.collect())


def test_subsequence(spark):
    df = spark.createDataFrame([(1, i + 1, d) for i, d in enumerate([3, 9, 1, 8, 2])],
                               "k long, pos long, digit long")
    assert ordered.best_ordered_pair(df, ["k"], "pos", "digit").first()["best"] == 98
    assert ordered.best_k_subsequence(df, ["k"], "pos", "digit", 2).first()["best"] == 98
    assert ordered.best_k_subsequence(df, ["k"], "pos", "digit", 3).first()["best"] == 982


def test_isolated_and_full_block(spark):
    iso = spark.createDataFrame([(1, 1), (5, 5)], "r long, c long")
    nb = cells.neighbour_counts(iso)
    assert nb.where("n < 4").count() == 2
    assert cells.peel(iso, 4).count() == 0  # both removed (the reference returns no row here)
    full = spark.createDataFrame([(r, c) for r in range(3) for c in range(3)], "r long, c long")
    assert cells.neighbour_counts(full).where("n < 4").count() == 4
    assert cells.peel(full, 4).count() == 0


def test_intervals(spark):
    iv = spark.createDataFrame([(1, 3), (2, 6), (7, 7), (10, 12)], "lo long, hi long")
    cov = ranges.covered_length(iv, "lo", "hi").first()
    assert cov["covered"] == 10
    pts = spark.createDataFrame([(3,), (8,), (10,), (10,)], "p long")
    assert ranges.points_in_ranges(pts, "p", iv, "lo", "hi").count() == 2


def test_merge_is_disjoint_and_covers(spark):
    data = [((i * 7) % 50, (i * 7) % 50 + (i % 4)) for i in range(60)]
    iv = spark.createDataFrame(data, "lo long, hi long")
    isl = sorted((r["lo"], r["hi"]) for r in ranges.merge_intervals(iv, "lo", "hi").collect())
    for (a0, a1), (b0, b1) in zip(isl, isl[1:]):
        assert a1 < b0
    covered = {x for lo, hi in data for x in range(lo, hi + 1)}
    assert covered == {x for lo, hi in isl for x in range(lo, hi + 1)}


def test_product_and_dispatch(spark):
    df = spark.createDataFrame([("a", 2), ("a", 3), ("a", 4), ("b", 5)], "k string, v long")
    prod = {r["k"]: int(r["product"]) for r in reshape.exact_product(df, ["k"], "v").collect()}
    assert prod == {"a": 24, "b": 5}
    ops = df.withColumn("op", F.lit("+"))
    sums = {r["k"]: int(r["result"]) for r in reshape.dispatch_aggregate(ops, ["k"], "v", "op").collect()}
    assert sums == {"a": 9, "b": 5}


def test_exact_product_large_and_signs(spark):
    df = spark.createDataFrame([("a", 10)] * 30 + [("b", -3), ("b", 7), ("c", 0), ("c", 9), ("d", 1)],
                               "k string, v long")
    prod = {r["k"]: r["product"] for r in reshape.exact_product(df, ["k"], "v").collect()}
    assert int(prod["a"]) == 10 ** 30 and int(prod["b"]) == -21
    assert int(prod["c"]) == 0 and int(prod["d"]) == 1


def test_propagation(spark):
    starts = spark.createDataFrame([(3,)], "col long")
    sp = spark.createDataFrame([(1, 3), (2, 2)], "level long, col long")
    reach = {r["level"]: (r["n_beams"], r["n_splits"]) for r in cells.layered_reach(starts, sp, 2).collect()}
    assert sum(s for _, s in reach.values()) == 2
    paths = cells.layered_path_counts(starts, sp, 2)
    per_level = {}
    for r in paths.collect():
        per_level[r["level"]] = per_level.get(r["level"], 0) + int(r["paths"])
    assert per_level == {1: 2, 2: 3}


@pytest.mark.parametrize("block_levels, width", [(1, 2), (3, 7), (8, 1 << 13)])
def test_propagation_in_blocks(spark, block_levels, width):
    """Beams that cross block borders, negative columns, big counts: level by level in plain Python."""
    rnd = random.Random(width)
    starts = [rnd.randint(-10, 10) for _ in range(6)]
    sp = {(lv, c) for lv in range(1, 9) for c in range(-20, 20) if rnd.random() < 0.6}
    front, want, splits = Counter(starts), {}, {}
    for lv in range(1, 8):
        after, splits[lv] = Counter(), sum((lv, c) in sp for c in front)
        for c, n in front.items():
            for d in ((c - 1, c + 1) if (lv, c) in sp else (c,)):
                after[d] += n
        front, want[lv] = after, after
    a = spark.createDataFrame([(c,) for c in [*starts, None]], "col long")
    b = spark.createDataFrame([*sp, *list(sp)[:5], (2, None)], "level long, col long")
    got = cells.layered_path_counts(a, b, 7, block_levels=block_levels, width=width).collect()
    assert {(r["level"], r["col"]): int(r["paths"]) for r in got} == {(lv, c): n for lv in want for c, n in want[lv].items()}
    got = cells.layered_reach(a, b, 7, block_levels=block_levels, width=width).collect()
    assert {r["level"]: (r["n_beams"], r["n_splits"]) for r in got} == {lv: (len(want[lv]), splits[lv]) for lv in want}


@pytest.mark.parametrize("shape", ["narrow", "diagonal", "sparse", "full"])
def test_peel_tiles(spark, shape):
    """No tile holds more cells than the limit, whatever the grid's shape, and tiles do not change the result."""
    rnd = random.Random(1)
    data = {"narrow": {(r, c) for r in range(600) for c in range(-3, 4) if rnd.random() < 0.7},
            "diagonal": {(i + d, i) for i in range(-300, 600) for d in range(-2, 3) if rnd.random() < 0.9},
            "sparse": {(rnd.randint(0, 10 ** 8), rnd.randint(0, 10 ** 8)) for _ in range(400)},
            "full": {(r, c) for r in range(40) for c in range(40)}}[shape]
    df = spark.createDataFrame(sorted(data), "r long, c long")
    base, tiles = cells.tile_map(df, 100)
    sizes = df.withColumns({"br": F.shiftright("r", base), "bc": F.shiftright("c", base)}).join(tiles, ["br", "bc"]) \
        .groupBy(*cells.TILE).count().agg(F.max("count"), F.sum("count"), F.count(F.lit(1))).first()
    assert sizes[0] <= 100 and sizes[1] == len(data)
    assert sizes[2] <= 60 if shape == "sparse" else sizes[2] >= len(data) / 100
    left = set(data)
    while gone := {(r, c) for r, c in left if sum((r + a, c + b) in left for a, b in cells.KING_OFFSETS) < 4}:
        left -= gone
    assert {tuple(x) for x in cells.peel_blocked(df, 4, cells_per_tile=100).collect()} == left


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 7)], "node long")
    lab = graphs.connected_components(e, nodes=nodes)
    comp = {r["node"]: r["component"] for r in lab.collect()}
    assert comp == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    assert int(graphs.top_component_product(lab, 3).first()["product"]) == 6


def test_long_chain_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(1, 200)], "a long, b long")
    lab = graphs.connected_components(e)
    assert lab.select("component").distinct().collect()[0]["component"] == 1


def test_spanning_edge(spark):
    pts = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 10)], "id long, x long")
    pairs = (pts.alias("p").join(pts.alias("q"), F.col("p.id") < F.col("q.id"))
             .select(F.col("p.id").alias("i"), F.col("q.id").alias("j"),
                     ((F.col("p.x") - F.col("q.x")) ** 2).cast("long").alias("d2")))
    top = graphs.spanning_edge(pairs).first()
    assert (top["i"], top["j"], top["d2"]) == (3, 4, 49)


def test_k_core_degrees(spark):
    # a 5-clique plus a pendant path: the 3-core is the clique
    clique = [(a, b) for a in range(5) for b in range(a + 1, 5)]
    e = spark.createDataFrame(clique + [(4, 10), (10, 11)], "a long, b long")
    core = graphs.k_core(e, 3)
    deg = graphs.degrees(core)
    assert sorted((r["node"], r["degree"]) for r in deg.collect()) == [(i, 4) for i in range(5)]


def test_rectangles(spark):
    pts = spark.createDataFrame([(0, 4), (4, 0)], "x long, y long")
    assert spatial.max_rectangle(pts, "x", "y").first()["area"] == 25


def test_max_rectangle_brute(spark):
    import random
    for seed, n, lo, hi, ylo, yhi in [(3, 80, 0, 30, 0, 30), (4, 60, -50, 50, -5, 5),
                                      (5, 120, 0, 1000, 0, 20), (6, 40, -3, 3, -200, 200)]:
        rnd = random.Random(seed)
        pts = [(rnd.randint(lo, hi), rnd.randint(ylo, yhi)) for _ in range(n)]
        df = spark.createDataFrame(pts, "x long, y long")
        brute = max((abs(a[0] - b[0]) + 1) * (abs(a[1] - b[1]) + 1) for a in pts for b in pts)
        assert spatial.max_rectangle(df, "x", "y").first()["area"] == brute, seed


def test_xor_subset(spark):
    m = spark.createDataFrame([(1, 1), (1, 3), (1, 6)], "g long, mask long")
    t = spark.createDataFrame([(1, 5)], "g long, target long")
    assert bits.min_subset_xor(m, t, "g").first()["presses"] == 2


def test_xor_subset_brute(spark):
    import itertools
    import random
    rnd = random.Random(5)
    groups = {g: sorted({rnd.randint(1, 63) for _ in range(rnd.randint(1, 7))}) for g in range(40)}
    targets = {g: rnd.randint(0, 63) for g in groups}
    m = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g long, mask long")
    t = spark.createDataFrame(list(targets.items()), "g long, target long")
    got = {r["g"]: r["presses"] for r in bits.min_subset_xor(m, t, "g").collect()}
    want = {}
    for g, xs in groups.items():
        for size in range(len(xs) + 1):
            hit = False
            for sub in itertools.combinations(xs, size):
                acc = 0
                for v in sub:
                    acc ^= v
                if acc == targets[g]:
                    hit = True
                    break
            if hit:
                want[g] = size
                break
    assert got == want


def test_masks(spark):
    df = spark.createDataFrame([(1, ".##."), (2, "")], "id long, s string")
    got = [tuple(r) for r in bits.mask_from_text(df, "s", "#", ["id"]).collect()]
    assert got == [(1, 0, 6)]                                    # an empty text has no words
    pos = spark.createDataFrame([(1, 0), (1, 2), (1, 2)], "g long, p long")
    assert bits.mask_from_positions(pos, ["g"], "p").first()["mask"] == 5


def test_empty_text_and_series(spark):
    df = spark.createDataFrame([(1, "")], "id long, s string")
    assert reshape.split_rows(df, "s", ",", ["id"]).count() == 0
    r = spark.createDataFrame([(1, 5, 3)], "range_id long, lo long, hi long")
    assert ranges.block_repeat_ids(r, "range_id", "lo", "hi").count() == 0


def test_tokens_squeeze_and_pack(spark):
    df = spark.createDataFrame([(1, 1, "  a  bb c "), (1, 2, "dd e")], "g long, row long, s string")
    tok = reshape.tokens(df, "s", ["g", "row"])
    assert rows(tok, "row", "pos", "token") == [(1, 1, "a"), (1, 2, "bb"), (1, 3, "c"), (2, 1, "dd"), (2, 2, "e")]
    cols = reshape.ordered_concat(tok, ["g", "pos"], "token", "row", "", "col")
    assert rows(cols, "pos", "col") == [(1, "add"), (2, "bbe"), (3, "c")]


def test_blocked_peel_matches_rounds(spark):
    import random
    rnd = random.Random(11)
    pts = {(r, c) for r in range(60) for c in range(30) if rnd.random() < 0.75}
    df = spark.createDataFrame(sorted(pts), "r long, c long")
    a = rows(cells.peel(df, 4), "r", "c")
    b = rows(cells.peel_blocked(df, 4, cells_per_tile=100), "r", "c")
    assert a == b and 0 < len(a) < len(pts)
    iso = spark.createDataFrame([(1, 1), (5, 5)], "r long, c long")
    assert cells.peel_blocked(iso, 4).count() == 0


def test_l_shaped_ring(spark):
    ring = [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
    v = spark.createDataFrame([("L", k, x, y) for k, (x, y) in enumerate(ring)], "poly string, k long, x long, y long")
    assert spatial.max_interior_rectangle(v, "poly", "k").first()["area"] == 15
    cells_ = spatial.polygon_cells(v, "poly", "k")
    assert cells_.where("inside").agg(F.sum("tiles")).first()[0] == 21
    # reversed orientation gives the same answers
    rv = spark.createDataFrame([("L", k, x, y) for k, (x, y) in enumerate(ring[::-1])],
                               "poly string, k long, x long, y long")
    assert spatial.max_interior_rectangle(rv, "poly", "k").first()["area"] == 15


def test_ring_with_narrow_notch(spark):
    # a U shape with a one-tile-wide notch: tiles (2,2), (2,3), (2,4) lie between
    # the prongs and are outside; (2,1) is on the bottom edge of the notch (inside)
    ring = [(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4)]
    v = spark.createDataFrame([("U", k, x, y) for k, (x, y) in enumerate(ring)], "poly string, k long, x long, y long")
    inside = spatial.polygon_cells(v, "poly", "k").where("inside").agg(F.sum("tiles")).first()[0]
    assert inside == 25 - 3
    assert spatial.max_interior_rectangle(v, "poly", "k").first()["area"] == 10


def test_component_labels_agree_on_edges(spark):
    import random
    rnd = random.Random(9)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(70)]
    e = spark.createDataFrame(edges, "a long, b long")
    lab = {r["node"]: r["component"] for r in graphs.connected_components(e).collect()}
    assert all(lab[a] == lab[b] for a, b in edges if a != b)
    assert all(lab[n] <= n for n in lab)


def test_k_core_degrees_at_least_k(spark):
    import random
    rnd = random.Random(10)
    edges = {(min(a, b), max(a, b)) for a, b in ((rnd.randint(0, 40), rnd.randint(0, 40)) for _ in range(300)) if a != b}
    e = spark.createDataFrame(sorted(edges), "a long, b long")
    core = graphs.k_core(e, 6)
    degs = [r["degree"] for r in graphs.degrees(core).collect()]
    assert degs and min(degs) >= 6


def test_corner_inset(spark):
    """Corners of the outline around a ring of tiles, whichever way the ring runs."""
    square, bent = [(0, 0), (4, 0), (4, 3), (0, 3)], [(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]
    loose = [(0, 0), (2, 0), (4, 0), (4, 0), (4, 3), (0, 3)]        # a straight middle and a repeated vertex
    rows = [(name, k, x, y) for name, ring in {
        "square": square, "bent": bent, "back": bent[::-1], "loose": loose, "flat": [(1, 1), (1, 1), (5, 1)]}.items()
        for k, (x, y) in enumerate(ring)] + [("square", 9, None, 2)]
    got = {}
    for r in spatial.corner_inset(spark.createDataFrame(rows, "poly string, k long, x long, y long"), "poly", "k").collect():
        got.setdefault(r["poly"], set()).add((r["x"], r["y"], r["turn"], r["ix"], r["iy"]))
    box = {(0, 0, 1, 0, 0), (4, 0, 1, 5, 0), (4, 3, 1, 5, 4), (0, 3, 1, 0, 4)}
    ell = {(0, 0, 1, 0, 0), (4, 0, 1, 5, 0), (4, 2, 1, 5, 3), (2, 2, -1, 3, 3), (2, 4, 1, 3, 5), (0, 4, 1, 0, 5)}
    assert got == {"square": box, "loose": box, "bent": ell, "back": ell}
