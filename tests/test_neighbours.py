"""Pair search: closest pairs and the spanning tree against brute force on hostile shapes."""

import math
import random

import pytest

from stratum.operators import graphs
from stratum.operators import neighbours as nb
from stratum.plans import Lineage


def shapes():
    rnd = random.Random(11)
    near = lambda: (rnd.randint(0, 60), rnd.randint(0, 60), rnd.randint(0, 60))
    return {
        "uniform": [tuple(rnd.randint(-500, 500) for _ in range(3)) for _ in range(150)],
        "outlier": [near() for _ in range(150)] + [(10 ** 9, -10 ** 9, 5)],
        "clusters": [near() for _ in range(70)] + [tuple(x + 100_000 for x in near()) for _ in range(70)]
                    + [(300, 0, 0), (-10 ** 7, 0, 0)],
        "coincident": [(5, 5, 5)] * 40 + [(5, 5, 6)] * 20 + [near() for _ in range(30)],
        "one place": [(1, 2, 3)] * 30,
        "line": [(k * k, 0, 0) for k in range(120)],
        "lattice": [(x, y, 0) for x in range(10) for y in range(10)],
    }


def frame(spark, points):
    rows = [(k * 7 % 1009, *p) for k, p in enumerate(points)]
    return rows, spark.createDataFrame(rows, "id bigint, x bigint, y bigint, z bigint").repartition(3)


def all_pairs(rows):
    return sorted((sum((p - q) ** 2 for p, q in zip(a[1:], b[1:])), a[0], b[0])
                  for a in rows for b in rows if a[0] < b[0])


def kruskal(rows):
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    tree = []
    for d2, i, j in all_pairs(rows):
        a, b = find(i), find(j)
        if a != b:
            parent[b] = a
            tree.append((i, j, d2))
    return tree


@pytest.mark.parametrize("shape", ["outlier", "clusters", "coincident", "line"])
def test_closest_pairs(spark, shape):
    rows, df = frame(spark, shapes()[shape])
    pairs = all_pairs(rows)
    got = [(r["d2"], r["i"], r["j"]) for r in nb.closest_pairs(df, "id", ["x", "y", "z"], 60).collect()]
    assert got == pairs[:60]


@pytest.mark.parametrize("shape,block", [("clusters", 64), ("coincident", nb.BLOCK), ("lattice", nb.BLOCK)])
def test_spanning_tree(spark, shape, block):
    rows, df = frame(spark, shapes()[shape])
    got = [tuple(r) for r in nb.spanning_tree(df, "id", ["x", "y", "z"], block).collect()]
    want = kruskal(rows)
    assert len(got) == len(rows) - 1
    assert sorted(got) == sorted(want)
    tree = spark.createDataFrame(got, "i bigint, j bigint, d2 bigint")
    assert tuple(graphs.heaviest_edge(tree).first()) == want[-1]


def test_defined_cases(spark):
    schema = "id bigint, x bigint, y bigint, z bigint"
    coords = ["x", "y", "z"]
    for rows in ([], [(1, None, 0, 0), (None, 1, 1, 1), (2, 5, 5, 5)]):
        df = spark.createDataFrame(rows, schema)
        assert nb.closest_pairs(df, "id", coords, 5).collect() == []
        assert nb.spanning_tree(df, "id", coords).collect() == []
    df = spark.createDataFrame([(3, 0, 0, 0), (1, 9, 0, 0)], schema)
    assert [tuple(r) for r in nb.closest_pairs(df, "id", coords, 5).collect()] == [(1, 3, 81)]
    assert [tuple(r) for r in nb.closest_pairs(df, "id", ["x"], 5).collect()] == [(1, 3, 81)]


@pytest.mark.parametrize("shape", ["outlier", "clusters"])
def test_candidates_are_bounded(spark, shape):
    """Pairs that the search forms stay near the number of points, wherever the outliers are."""
    points = shapes()[shape]
    _, df = frame(spark, points)
    n = 20
    pts = nb._points(df, "id", ["x", "y", "z"])
    level = nb.finest_level(pts, 3, n)
    assert n <= nb.pairs_in_cells(pts, 3, level) <= 8 * (n + len(points))
    assert nb.pairs_in_cells(pts, 3, level - 1) < n
    r2 = nb.pair_radius(pts, 3, n)
    formed = nb.candidate_pairs(pts, 3, math.isqrt(r2) + 1)
    assert formed.count() == formed.select("i", "j").distinct().count() <= 14 * (n + len(points))


def test_only_borders_are_paired(spark):
    """Two dense clusters far apart: cells deep inside a cluster leave, and one edge joins the two."""
    side = range(12)
    points = [(x, y, z) for x in side for y in side for z in side] + [(x + 10_000, y, z) for x in side for y in side for z in side]
    rows = [(k, 0 if p[0] < 5_000 else 1, *p) for k, p in enumerate(points)]
    nodes = spark.createDataFrame(rows, "id bigint, comp bigint, x0 bigint, x1 bigint, x2 bigint")
    lineage = Lineage(spark, 1)
    level = nb.pure_level(nodes, 3, 0)
    assert 2 ** level < 10_000
    for block in (nb.BLOCK, 64):
        edge, = nb.foreign_edges(nodes, 3, level, 20_000, lineage, block).collect()
        assert (edge["ca"], edge["cb"], edge["d2"]) == (0, 1, (10_000 - 11) ** 2)
