"""Pair search in space: closest pairs and the Euclidean spanning tree.

Both measure before they pair.  Cells of side 2^level are nested, so the number of
pairs inside cells only grows with the level, and one aggregate per probe of a
binary search finds the finest level with enough of them: a dense cluster and a far
outlier each get the cells that their own counts call for, whatever the bounding box.

Coordinates are integers.  Rows with a null id or coordinate take no part.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions import floor_div
from stratum.plans import Lineage

BLOCK = 4096        # point pairs of two cells that are compared without splitting the cells further
_ID = "bigint"


def _points(points: DataFrame, pid: str, coords: list[str]) -> DataFrame:
    """(id, x0, x1, ...), moved so that the least value of every axis is 0."""
    named = points.select(F.col(pid).alias("id"), *[F.col(c).cast(_ID).alias(f"x{k}") for k, c in enumerate(coords)]).dropna()
    least = named.agg(*[F.min(f"x{k}").alias(f"m{k}") for k in range(len(coords))]).first()
    return named.select("id", *[(F.col(f"x{k}") - F.lit(least[f"m{k}"] or 0)).alias(f"x{k}") for k in range(len(coords))])


def _cell(dims: int, level: int) -> list[Column]:
    return [F.shiftright(f"x{k}", level).alias(f"c{k}") for k in range(dims)]


def pairs_in_cells(pts: DataFrame, dims: int, level: int) -> float:
    """Number of pairs that share a cell of side 2^level (counted, not formed)."""
    sizes = pts.groupBy(*_cell(dims, level)).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return sizes.agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()[0] or 0.0


def finest_level(pts: DataFrame, dims: int, need: int) -> int:
    """The least level at which at least ``need`` pairs share a cell (or the one that holds all points)."""
    extent = pts.agg(F.max(F.greatest(*[F.col(f"x{k}") for k in range(dims)], F.lit(0)))).first()[0] or 0
    lo, hi = 0, int(extent).bit_length()
    while lo < hi:
        mid = (lo + hi) // 2
        if pairs_in_cells(pts, dims, mid) >= need:
            hi = mid
        else:
            lo = mid + 1
    return lo


def half_neighbours(dims: int) -> list[tuple]:
    """A cell itself and one of each two opposite neighbours: 14 offsets in space."""
    return [o for o in product((0, 1, -1), repeat=dims) if o >= (0,) * dims]


def candidate_pairs(pts: DataFrame, dims: int, side: int) -> DataFrame:
    """(i, j, d2): every pair in the same or in touching cells of side ``side``, once, unfiltered."""
    cells = [f"c{k}" for k in range(dims)]
    homes = pts.select(F.col("id").alias("i"), *[F.col(f"x{k}").alias(f"a{k}") for k in range(dims)],
                       *[floor_div(f"x{k}", side).alias(c) for k, c in enumerate(cells)])
    offsets = F.explode(F.array(*[F.array(*[F.lit(v) for v in o]) for o in half_neighbours(dims)]))
    guests = pts.select(F.col("id").alias("j"), *[F.col(f"x{k}").alias(f"b{k}") for k in range(dims)], offsets.alias("o"))
    guests = guests.select("j", *[f"b{k}" for k in range(dims)], "o",
                           *[(floor_div(f"b{k}", side) - F.col("o")[k]).alias(c) for k, c in enumerate(cells)])
    here = F.lit(True)
    for k in range(dims):
        here = here & (F.col("o")[k] == 0)
    met = homes.join(guests, cells).filter(~here | (F.col("i") < F.col("j")))
    return met.select(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), _distance(dims).alias("d2"))


def _distance(dims: int) -> Column:
    return sum((F.col(f"a{k}") - F.col(f"b{k}")) * (F.col(f"a{k}") - F.col(f"b{k}")) for k in range(dims)).cast(_ID)


def _coincident_pairs(pts: DataFrame, dims: int, n: int) -> DataFrame:
    """Pairs of points in one place that can be among the first ``n`` by (i, j).

    The m least ids of a place count, m <= n + 1; the r-th of them has (r - 1) * (2m - r) / 2
    pairs of the place before its own, so a place gives about n + m pairs at most.
    """
    place = [f"x{k}" for k in range(dims)]
    nth = F.row_number().over(Window.partitionBy(*place).orderBy("id"))
    few = pts.withColumn("r", nth).filter(F.col("r") <= n + 1)
    m = few.groupBy(*place).agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > 1)
    few = few.join(m, place)
    first = few.filter((F.col("r") - 1) * (2 * F.col("m") - F.col("r")) < 2 * n)
    return first.select(*place, F.col("id").alias("i")).join(few.select(*place, F.col("id").alias("j")), place) \
        .filter(F.col("i") < F.col("j")).select("i", "j", F.lit(0).cast(_ID).alias("d2"))


def pair_radius(pts: DataFrame, dims: int, need: int) -> int | None:
    """A squared distance within which at least ``need`` pairs lie, or None if they lie in one place.

    At the finest level with ``need`` pairs in its cells, the ``need``-th smallest distance of those
    pairs is a bound.  The level below has fewer, so no cell holds more than 2^d * (sqrt(2 need) + 1)
    points, and the pairs of all cells together are at most 2^d * (need + points).
    """
    level = finest_level(pts, dims, need)
    if level == 0:
        return None
    cells = [f"c{k}" for k in range(dims)]
    a = pts.select(F.col("id").alias("i"), *[F.col(f"x{k}").alias(f"a{k}") for k in range(dims)],
                   *[F.shiftright(f"x{k}", level).alias(f"c{k}") for k in range(dims)])
    b = pts.select(F.col("id").alias("j"), *[F.col(f"x{k}").alias(f"b{k}") for k in range(dims)],
                   *[F.shiftright(f"x{k}", level).alias(f"c{k}") for k in range(dims)])
    inside = a.join(b, cells).filter(F.col("i") < F.col("j")).select(_distance(dims).alias("d2"))
    return int(inside.orderBy("d2").limit(need).agg(F.max("d2")).first()[0])


def closest_pairs(points: DataFrame, pid: str, coords: list[str], n: int) -> DataFrame:
    """(i, j, d2) of the ``n`` closest unordered pairs, ties broken by (i, j).

    A radius that is known to hold ``n`` pairs is measured first (``pair_radius``); then every
    pair within it is formed once, from a cell and half of its neighbours, and the top-n is the
    report itself.  Places that hold ``n`` pairs or more of coincident points need no radius.
    """
    dims = len(coords)
    lineage = Lineage(points.sparkSession, 1)
    pts = lineage.cut(_points(points, pid, coords), force=True)
    count = pts.count()
    need = min(n, count * (count - 1) // 2)
    if need == 0:
        return pts.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(0).cast(_ID).alias("d2")).limit(0)
    r2 = pair_radius(pts, dims, need)
    if r2 is None:
        found = _coincident_pairs(pts, dims, need)
    else:
        found = candidate_pairs(pts, dims, max(1, math.isqrt(r2) + (math.isqrt(r2) ** 2 < r2))).filter(F.col("d2") <= r2)
    return found.orderBy("d2", "i", "j").limit(n)


# ---------------------------------------------------------------------------
# Spanning tree: the nearest foreign neighbour of every component
# ---------------------------------------------------------------------------


def _boruvka(edges: DataFrame, lineage: Lineage) -> tuple[list[DataFrame], DataFrame | None]:
    """Picked edges (i, j, d2) and the new component of every component (c, root) that has an edge.

    ``edges`` are (ca, cb, d2, i, j); they shrink to those that still join two components.
    """
    chosen, moved = [], None
    while True:
        both = edges.unionByName(edges.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"), "d2", "i", "j"))
        picks = lineage.cut(both.groupBy("ca").agg(F.min(F.struct("d2", "i", "j", "cb")).alias("e"))
                            .select(F.col("ca").alias("c"), F.col("e.cb").alias("p"), "e.d2", "e.i", "e.j"), force=True)
        if picks.isEmpty():
            return chosen, moved
        chosen.append(picks.select("i", "j", "d2"))
        # of two components that pick each other, the smaller is the root
        back = picks.select(F.col("c").alias("p"), F.col("p").alias("pp"))
        up = picks.select("c", "p").join(back, "p", "left").select(
            "c", F.when((F.col("pp") == F.col("c")) & (F.col("c") < F.col("p")), F.col("c")).otherwise(F.col("p")).alias("p"))
        while True:
            for _ in range(2):
                up = up.join(up.select(F.col("c").alias("p"), F.col("p").alias("pp")), "p").select("c", F.col("pp").alias("p"))
            up = lineage.cut(up, force=True)
            above = up.select(F.col("c").alias("p"), F.col("p").alias("pp"))
            if up.join(above, "p").filter(F.col("p") != F.col("pp")).isEmpty():
                break
        roots = up.select("c", F.col("p").alias("root"))
        moved = roots if moved is None else \
            moved.join(roots.select(F.col("c").alias("root"), F.col("root").alias("next")), "root", "left") \
            .select("c", F.coalesce("next", "root").alias("root"))
        edges = edges.join(roots.select(F.col("c").alias("ca"), F.col("root").alias("ra")), "ca") \
            .join(roots.select(F.col("c").alias("cb"), F.col("root").alias("rb")), "cb") \
            .filter(F.col("ra") != F.col("rb")) \
            .groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb")) \
            .agg(F.min(F.struct("d2", "i", "j")).alias("e")).select("ca", "cb", "e.d2", "e.i", "e.j")
        edges = lineage.cut(edges, force=True)


def _boxes(nodes: DataFrame, dims: int, level: int) -> DataFrame:
    """Cells of side 2^level: their key, component, number of points and tight box."""
    axes = range(dims)
    return nodes.groupBy(F.struct(*_cell(dims, level)).alias("cell")).agg(
        F.min("comp").alias("comp"), F.count(F.lit(1)).alias("n"),
        *[F.min(f"x{k}").alias(f"lo{k}") for k in axes], *[F.max(f"x{k}").alias(f"hi{k}") for k in axes])


def _sides(boxes: DataFrame, tag: str) -> DataFrame:
    return boxes.select(*[F.col(c).alias(f"{c}_{tag}") for c in boxes.columns])


def _gap(dims: int) -> Column:
    """Least squared distance of two boxes."""
    apart = [F.greatest(F.col(f"lo{k}_a") - F.col(f"hi{k}_b"), F.col(f"lo{k}_b") - F.col(f"hi{k}_a"), F.lit(0))
             for k in range(dims)]
    return sum(x * x for x in apart)


def _reach(dims: int) -> Column:
    """Greatest squared distance of two points of two boxes."""
    apart = [F.greatest(F.col(f"hi{k}_a") - F.col(f"lo{k}_b"), F.col(f"hi{k}_b") - F.col(f"lo{k}_a"))
             for k in range(dims)]
    return sum(x * x for x in apart)


def _useful(pairs: DataFrame, dims: int, lineage: Lineage) -> DataFrame:
    """Box pairs that can hold the lightest edge of their two components."""
    pairs = lineage.cut(pairs, force=True)
    bound = pairs.groupBy("comp_a", "comp_b").agg(F.min(_reach(dims)).alias("bound"))
    return pairs.join(bound, ["comp_a", "comp_b"]).filter(_gap(dims) <= F.col("bound")).drop("bound")


def pure_level(nodes: DataFrame, dims: int, least: int) -> int:
    """The greatest level, ``least`` or more, at which every cell holds one component."""
    extent = nodes.agg(F.max(F.greatest(*[F.col(f"x{k}") for k in range(dims)], F.lit(0)))).first()[0] or 0
    lo, hi = least, max(int(extent).bit_length(), least)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        mixed = nodes.groupBy(*_cell(dims, mid)).agg(F.min("comp").alias("a"), F.max("comp").alias("b")) \
            .filter(F.col("a") != F.col("b"))
        if mixed.isEmpty():
            lo = mid
        else:
            hi = mid - 1
    return lo


def foreign_edges(nodes: DataFrame, dims: int, level: int, radius: int, lineage: Lineage,
                  block: int = BLOCK) -> DataFrame:
    """(ca, cb, d2, i, j): the lightest edge between any two components that come within ``radius``.

    ``nodes`` are (id, comp, x0, ...), and cells of ``level`` hold one component each.  So cells
    are paired, not points: first only those whose neighbourhood holds two components, then of
    those only pairs of different components whose boxes can hold the lightest edge between them.
    Cells with more than ``block`` point pairs between them are split in halves of each axis until
    they have fewer.
    """
    side = radius + (1 << level)
    home = [floor_div(f"lo{k}", side) for k in range(dims)]
    boxes = lineage.cut(_boxes(nodes, dims, level).withColumns({f"h{k}": c for k, c in enumerate(home)}), force=True)
    keys = [f"h{k}" for k in range(dims)]
    per_home = boxes.groupBy(*keys).agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
    around = F.explode(F.array(*[F.array(*[F.lit(v) for v in o]) for o in product((0, 1, -1), repeat=dims)]))
    mixed = per_home.select(*keys, "least", "most", around.alias("o")) \
        .groupBy(*[(F.col(c) + F.col("o")[k]).alias(c) for k, c in enumerate(keys)]) \
        .agg(F.min("least").alias("least"), F.max("most").alias("most")).filter(F.col("least") != F.col("most")).select(*keys)
    border = boxes.join(mixed, keys, "left_semi")
    half = F.explode(F.array(*[F.array(*[F.lit(v) for v in o]) for o in half_neighbours(dims)]))
    a = _sides(border.drop(*keys), "a").columns
    one = border.select(*[F.col(c[:-2]).alias(c) for c in a], *keys)
    two = border.select(*[F.col(c[:-2]).alias(c[:-1] + "b") for c in a], *keys, half.alias("o")) \
        .withColumns({c: F.col(c) - F.col("o")[k] for k, c in enumerate(keys)}).drop("o")
    pairs = one.join(two, keys).filter((F.col("comp_a") != F.col("comp_b")) & (_gap(dims) <= radius * radius)).drop(*keys)
    # a cell meets the others of its own neighbourhood from both sides: keep the pair with the smaller component first
    swapped = [F.when(F.col("comp_a") < F.col("comp_b"), F.col(c[:-1] + x)).otherwise(F.col(c[:-1] + y)).alias(c[:-1] + x)
               for x, y in ("ab", "ba") for c in a]
    pairs = pairs.select(*swapped).distinct()

    edges = None
    while True:
        pairs = lineage.cut(_useful(pairs, dims, lineage), force=True)
        heavy = F.col("n_a") * F.col("n_b") > (block if level else math.inf)
        found = _lightest(pairs.filter(~heavy), nodes, dims, level, radius)
        edges = found if edges is None else edges.unionByName(found)
        pairs = pairs.filter(heavy)
        if level == 0 or pairs.isEmpty():
            break
        level -= 1
        parts = _boxes(nodes, dims, level).withColumn("whole", F.struct(
            *[F.shiftright(F.col("cell")[f"c{k}"], 1).alias(f"c{k}") for k in range(dims)]))
        pairs = pairs.select(F.col("cell_a").alias("whole_a"), F.col("cell_b").alias("whole_b")) \
            .join(_sides(parts, "a"), "whole_a").join(_sides(parts, "b"), "whole_b").drop("whole_a", "whole_b") \
            .filter(_gap(dims) <= radius * radius)
    return edges.groupBy("ca", "cb").agg(F.min(F.struct("d2", "i", "j")).alias("e")).select("ca", "cb", "e.d2", "e.i", "e.j")


def _lightest(pairs: DataFrame, nodes: DataFrame, dims: int, level: int, radius: int) -> DataFrame:
    """The lightest edge of every two components among the points of some cell pairs."""
    cell = F.struct(*_cell(dims, level))
    a = nodes.select(cell.alias("cell_a"), F.col("id").alias("p"), *[F.col(f"x{k}").alias(f"a{k}") for k in range(dims)])
    b = nodes.select(cell.alias("cell_b"), F.col("id").alias("q"), *[F.col(f"x{k}").alias(f"b{k}") for k in range(dims)])
    met = pairs.select("cell_a", "cell_b", F.col("comp_a").alias("ca"), F.col("comp_b").alias("cb")) \
        .join(a, "cell_a").join(b, "cell_b").withColumn("d2", _distance(dims)).filter(F.col("d2") <= radius * radius)
    return met.groupBy("ca", "cb").agg(F.min(F.struct("d2", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j")))
                                       .alias("e")).select("ca", "cb", "e.d2", "e.i", "e.j")


def spanning_tree(points: DataFrame, pid: str, coords: list[str], block: int = BLOCK) -> DataFrame:
    """(i, j, d2) of the minimum spanning tree, edges ordered by (d2, i, j).

    Coincident points hang on the smallest id of their place, which stands for them.  Borůvka runs
    on all pairs within a radius that holds about as many pairs as points, then on the lightest
    edges between components within a larger radius, and so on (``foreign_edges``).  The next
    radius is measured: it is the diagonal of the finest cells that hold two components, and at
    least twice the last.  A component that picks an edge within the radius has picked its
    lightest, since all others are longer, so picks hold.  Pairs inside a component are never
    written.
    """
    dims = len(coords)
    place = [f"x{k}" for k in range(dims)]
    lineage = Lineage(points.sparkSession, 1)
    pts = lineage.cut(_points(points, pid, coords), force=True)
    nodes = lineage.cut(pts.groupBy(*place).agg(F.min("id").alias("id")), force=True)
    hung = pts.join(nodes.withColumnRenamed("id", "first"), place).filter(F.col("id") != F.col("first")) \
        .select(F.col("first").alias("i"), F.col("id").alias("j"), F.lit(0).cast(_ID).alias("d2"))
    tree = [hung]
    count = nodes.count()
    if count > 1:
        radius = 1 << finest_level(nodes, dims, count)
        edges = lineage.cut(candidate_pairs(nodes, dims, radius).filter(F.col("d2") <= radius * radius)
                            .select(F.col("i").alias("ca"), F.col("j").alias("cb"), "d2", "i", "j"), force=True)
        nodes = nodes.withColumn("comp", F.col("id"))
        while True:
            chosen, moved = _boruvka(edges, lineage)
            tree += chosen
            if moved is not None:
                nodes = lineage.cut(nodes.join(moved.select(F.col("c").alias("comp"), "root"), "comp", "left")
                                    .select("id", *place, F.coalesce("root", "comp").alias("comp")), force=True)
            if nodes.select("comp").distinct().limit(2).count() < 2:
                break
            # components are more than the radius apart, so cells of that diagonal are pure
            level = pure_level(nodes, dims, max(int(radius / math.sqrt(dims)), 1).bit_length() - 1)
            radius = max(2 * radius, math.ceil(math.sqrt(dims) * 2 ** (level + 1)))
            edges = lineage.cut(foreign_edges(nodes, dims, level, radius, lineage, block), force=True)
    out = tree[0]
    for t in tree[1:]:
        out = out.unionByName(t)
    return out.distinct()
