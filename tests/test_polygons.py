"""Runs, pockets and largest rectangles of rings against a count of every tile."""

import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import spatial

ROOM = [(0, 0), (0, 10), (5, 10), (5, 7), (3, 7), (3, 3), (7, 3), (7, 7), (6, 7), (6, 10), (10, 10), (10, 0)]
COMB = [(0, 0), (12, 0), *[p for k in range(6, 0, -1) for p in ((2 * k, 9), (2 * k - 1, 9), (2 * k - 1, 2), (2 * k - 2, 2))]]


def walk(seed, steps, tall):
    """A ring with a random upper and lower outline over columns of width 1 to 3."""
    rnd = random.Random(seed)
    xs = [0]
    for _ in range(steps):
        xs.append(xs[-1] + rnd.randint(1, 3))
    up, down = [], []
    for a, b in zip(xs, xs[1:]):
        h, d = rnd.randint(1, tall), -rnd.randint(1, tall)
        up += [(a, h), (b, h)]
        down += [(a, d), (b, d)]
    return up + down[::-1]


def diamond(n):
    up = [p for k in range(n) for p in ((k, n + k), (k, n + k + 1))] + [p for k in range(n) for p in ((n + k, 2 * n - k), (n + k + 1, 2 * n - k))]
    return up + [(2 * n - x, 2 * n - y) for x, y in up]


def tiles_of(ring):
    edges = list(zip(ring, ring[1:] + ring[:1]))
    xs, ys = [p[0] for p in ring], [p[1] for p in ring]
    inside = set()
    for x in range(min(xs), max(xs) + 1):
        for y in range(min(ys), max(ys) + 1):
            on = any(min(a[0], b[0]) <= x <= max(a[0], b[0]) and min(a[1], b[1]) <= y <= max(a[1], b[1]) for a, b in edges)
            walls = sum(a[0] == b[0] and a[0] < x and min(a[1], b[1]) <= y < max(a[1], b[1]) for a, b in edges)
            if on or walls % 2:
                inside.add((x, y))
    return inside


def largest(ring, inside):
    best = 0
    for i, (ax, ay) in enumerate(ring):
        for bx, by in ring[:i]:
            area = (abs(ax - bx) + 1) * (abs(ay - by) + 1)
            if area > best and all((x, y) in inside for x in range(min(ax, bx), max(ax, bx) + 1)
                                   for y in range(min(ay, by), max(ay, by) + 1)):
                best = area
    return best


RINGS = {"room": ROOM, "comb": COMB, "comb on its side": [(y, x) for x, y in COMB], "diamond": diamond(5),
         "upside down": [(x, -y) for x, y in ROOM], "spike": [(0, 0), (4, 0), (9, 0), (4, 0), (4, 4), (0, 4)],
         "point": [(3, 3), (3, 3)], "dot": [(1, 1)], **{f"walk {k}": walk(k, 4 + 3 * k, 2 + k) for k in range(6)}}
RINGS |= {f"{name}, turned": [(y, x) for x, y in ring][::-1] for name, ring in RINGS.items() if name.startswith("walk")}


@pytest.fixture(scope="module")
def rings(spark):
    rows = [(name, k, x, y) for name, ring in RINGS.items() for k, (x, y) in enumerate(ring)]
    rows += [("comb", 99, None, 1), ("nothing", 0, None, None), (None, 0, 1, 1), (None, 1, 2, 1)]
    return spark.createDataFrame(rows, "poly string, k long, x long, y long").repartition(5)


def test_runs_are_the_inside_tiles(rings):
    got = {}
    for r in spatial.inside_runs(rings, "poly", "k").collect():
        for y in range(r["y"], r["y"] + r["rows"]):
            for x in range(r["lo"], r["hi"] + 1):
                assert (x, y) not in got.setdefault(r["poly"], set())
                got[r["poly"]].add((x, y))
    assert got == {name: tiles_of(ring) for name, ring in RINGS.items()}


def test_pockets(rings):
    got = {tuple(r) for r in spatial.pockets(spatial.inside_runs(rings, "poly", "k"), "poly").collect()}
    # the strip between the lines 3 and 7 of the room, in tiles 4 to 6
    assert got == {("room", 4, 4, 6), ("upside down", -6, 4, 6)}
    assert spatial.pockets(spatial.inside_runs(rings.where("poly like 'walk%'"), "poly", "k"), "poly") is None


@pytest.mark.parametrize("block", [2, 5, 64])
def test_largest_rectangle(rings, block):
    got = {r["poly"]: r["area"] for r in spatial.max_interior_rectangle(rings, "poly", "k", block=block).collect()}
    assert got == {name: largest(ring, tiles_of(ring)) for name, ring in RINGS.items() if len(ring) > 1}


def test_a_large_ring(spark):
    """4,000 columns: as many runs as crossings, far from columns x lines; vertices of 250 blocks."""
    ring = walk(77, 4000, 30)
    v = spark.createDataFrame([(1, k, x, y) for k, (x, y) in enumerate(ring)], "poly long, k long, x long, y long")
    runs = spatial.inside_runs(v, "poly", "k", "y", "x")
    assert runs.count() < 2 * 8001                  # one run a column line and strip
    top, deep = {}, {}
    for (a, y), (b, _) in zip(ring[::2], ring[1::2]):
        for x in range(min(a, b), max(a, b) + 1):
            top[x], deep[x] = max(top.get(x, 0), y), min(deep.get(x, 0), y)
    assert runs.agg(F.sum((F.col("hi") - F.col("lo") + 1) * F.col("rows"))).first()[0] == sum(top[x] - deep[x] + 1 for x in top)
    best, at = 0, {}
    for x, y in ring:
        at.setdefault(x, set()).add(y)
    for x, ys in at.items():
        for y in ys:
            low, high = deep[x], top[x]
            for r in range(x, max(top) + 1):
                low, high = max(low, deep[r]), min(high, top[r])
                if not low <= y <= high:
                    break
                best = max([best, *[(r - x + 1) * (abs(y - z) + 1) for z in at.get(r, ()) if low <= z <= high]])
    assert spatial.max_interior_rectangle(v, "poly", "k").first()["area"] == best


def test_empty(spark):
    none = spark.createDataFrame([], "poly string, k long, x long, y long")
    assert spatial.inside_runs(none, "poly", "k").count() == 0
    assert spatial.max_interior_rectangle(none, "poly", "k").count() == 0


@pytest.mark.parametrize("whole", [0, 10])
def test_whole_and_dealt_rings(rings, whole):
    """Rings that stay in one task and rings whose rows are dealt out have the same runs and rectangles."""
    got = {}
    for r in spatial.inside_runs(rings, "poly", "k", whole=whole).collect():
        got.setdefault(r["poly"], []).extend((x, y) for y in range(r["y"], r["y"] + r["rows"]) for x in range(r["lo"], r["hi"] + 1))
    assert {name: sorted(tiles) for name, tiles in got.items()} == {name: sorted(tiles_of(ring)) for name, ring in RINGS.items()}
    areas = {r["poly"]: r["area"] for r in spatial.max_interior_rectangle(rings, "poly", "k", block=5, whole=whole).collect()}
    assert areas == {name: largest(ring, tiles_of(ring)) for name, ring in RINGS.items() if len(ring) > 1}


def test_runs_of_short_rings_are_shuffled_once(spark, tmp_path):
    """Once dealt out by ring, the runs are made without another exchange, and so are the rings of the query."""
    from stratum.catalog.spatial import skyline
    from stratum.plans import physical_plan
    rows = [(n, k, x, y) for n in range(50) for k, (x, y) in enumerate(walk(n, 6, 3))]
    v = spark.createDataFrame(rows, "poly long, k long, x long, y long")
    assert physical_plan(spatial.inside_runs(v, "poly", "k")).count("Exchange hashpartitioning") == 1
    orders = spark.range(300).selectExpr("id % 40 o_custkey", "date_add(date'2000-01-01', cast(id * 7 as int)) o_orderdate")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert physical_plan(skyline(spark, str(tmp_path))).count("Exchange hashpartitioning") == 2


def test_skyline_of_odd_orders(spark, tmp_path):
    """Customers without dates and orders without a customer have a ring too; the latter's is flat."""
    from datetime import date
    from stratum.catalog.spatial import skyline
    rows = [(1, date(2000, 1, 5)), (1, date(2000, 1, 9)), (1, date(2000, 3, 1)), (2, None), (None, date(2000, 2, 1))]
    spark.createDataFrame(rows, "o_custkey long, o_orderdate date").write.parquet(str(tmp_path / "orders.parquet"))
    got = {}
    for r in skyline(spark, str(tmp_path)).orderBy("poly", "k").collect():
        got.setdefault(r["poly"], []).append((r["x"], r["y"]))
    flat = [(0, 0), (0, 1), (3, 1), (3, 0)]
    assert got == {1: [(0, 0), (0, 3), (1, 3), (1, 1), (2, 1), (2, 2), (3, 2), (3, 0)], 2: flat, None: flat}
    spark.createDataFrame([], "o_custkey long, o_orderdate date").write.parquet(str(tmp_path / "none" / "orders.parquet"))
    assert skyline(spark, str(tmp_path / "none")).count() == 0
