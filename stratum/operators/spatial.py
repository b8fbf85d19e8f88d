"""Geometry operators: rectangles, coordinate compression, rectilinear
polygons (U21-U28).

Pairs are never formed blindly: the rectangle search prunes to Pareto
staircases before pairing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.graphs import connected_components
from stratum.plans import Lineage, ordered_scan, spread
from stratum.plans.prefix import ordered_scans


def staircases(points: DataFrame, x: str, y: str) -> DataFrame:
    """Pareto staircases for the four corner directions.

    Per distinct x the lowest and highest y (an aggregate); a point is on
    the (min x, min y) staircase when its y is below every y at smaller x,
    and likewise for the other three corners (running min/max over x).
    Returns ``(kind, r, x, y)`` with kind in {'ll','lr','ul','ur'} and r the
    1-based rank of the point along its staircase in x order.
    """
    lineage = Lineage(points.sparkSession, 1)
    col = points.groupBy(F.col(x).alias("x")).agg(F.min(y).alias("ylo"), F.max(y).alias("yhi"))
    col = lineage.cut(col.withColumn("nx", -F.col("x")), force=True)
    # running extremes over smaller x (before) and larger x (after), two-level
    s = ordered_scans(col, ["x"], [("ylo", "lo_b", "min"), ("yhi", "hi_b", "max")], [], True, True)
    s = ordered_scans(s, ["nx"], [("ylo", "lo_a", "min"), ("yhi", "hi_a", "max")], [], True, True)
    flags = {
        "ll": F.col("lo_b").isNull() | (F.col("ylo") < F.col("lo_b")),
        "ul": F.col("hi_b").isNull() | (F.col("yhi") > F.col("hi_b")),
        "lr": F.col("lo_a").isNull() | (F.col("ylo") < F.col("lo_a")),
        "ur": F.col("hi_a").isNull() | (F.col("yhi") > F.col("hi_a")),
    }
    s = s.select("x", "ylo", "yhi", *[f.cast("bigint").alias(f"f_{k}") for k, f in flags.items()])
    # rank of each staircase point in x order: running count of its flag
    s = ordered_scans(s, ["x"], [(f"f_{k}", f"r_{k}", "sum") for k in flags], [], True)
    ys = {"ll": "ylo", "lr": "ylo", "ul": "yhi", "ur": "yhi"}
    parts = [s.where(F.col(f"f_{k}") == 1).select(F.lit(k).alias("kind"), F.col(f"r_{k}").alias("r"), "x",
                                                   F.col(ys[k]).alias("y")) for k in flags]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _ranked(st: DataFrame, kind: str, ysign: int) -> DataFrame:
    """One staircase as ``(r, x, y)``, y optionally negated."""
    return st.where(F.col("kind") == kind).select("r", "x", (F.col("y") * ysign).alias("y"))


def _monge_best(p: DataFrame, q: DataFrame) -> DataFrame:
    """max over i, j of (X_j - x_i + 1)(Y_j - y_i + 1) for two staircases
    (x ascending, y strictly descending in both).

    The matrix is inverse-Monge -- f(i,j) + f(i',j') >= f(i,j') + f(i',j)
    for i < i', j < j' -- so the rightmost best column of a row never moves
    left as the row grows.  Divide and conquer on rows: each round solves
    the middle row of every open segment over that segment's column range
    and splits the segment there.  Column ranges of one round overlap only
    at their ends, so a round explodes O(#rows + #columns) candidates, and
    there are log2(#rows) rounds.  Every step is an equi join or aggregate.
    """
    lineage = Lineage(p.sparkSession, 1)
    P = lineage.cut(p.select(F.col("r").alias("mid"), F.col("x").alias("px"), F.col("y").alias("py")), force=True)
    Q = lineage.cut(q.select(F.col("r").alias("j"), F.col("x").alias("qx"), F.col("y").alias("qy")), force=True)
    seg = P.agg(F.min("mid").alias("i_lo"), F.max("mid").alias("i_hi")).select(
        "i_lo", "i_hi", Q.select(F.min("j")).scalar().alias("j_lo"), Q.select(F.max("j")).scalar().alias("j_hi"))
    seg = lineage.cut(seg, force=True)
    found = []
    while True:
        open_seg = seg.where(F.col("i_lo") <= F.col("i_hi"))
        if open_seg.isEmpty():
            break
        open_seg = open_seg.withColumn("mid", F.call_function("div", F.col("i_lo") + F.col("i_hi"), F.lit(2)))
        cand = (open_seg.select("*", F.explode(F.sequence("j_lo", "j_hi")).alias("j"))
                .join(Q, "j").join(P, "mid")
                .withColumn("f", (F.col("qx") - F.col("px") + 1) * (F.col("qy") - F.col("py") + 1)))
        pick = lineage.cut(cand.groupBy("i_lo", "i_hi", "j_lo", "j_hi", "mid")
                           .agg(F.max(F.struct("f", "j")).alias("_m"))
                           .select("i_lo", "i_hi", "j_lo", "j_hi", "mid", F.col("_m.f").alias("f"),
                                   F.col("_m.j").alias("best_j")), force=True)
        found.append(pick.select("f"))
        seg = (pick.select("i_lo", (F.col("mid") - 1).alias("i_hi"), "j_lo", F.col("best_j").alias("j_hi"))
               .unionByName(pick.select((F.col("mid") + 1).alias("i_lo"), "i_hi",
                                        F.col("best_j").alias("j_lo"), "j_hi")))
    if not found:       # an empty staircase
        return P.select(F.lit(None).cast("bigint").alias("f")).limit(0).agg(F.max("f").alias("_a"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.agg(F.max("f").alias("_a"))


def max_rectangle(points: DataFrame, x: str, y: str, out: str = "area") -> DataFrame:
    """Max (|dx|+1)(|dy|+1) over pairs of points.

    An optimal pair is a lower-left/upper-right or upper-left/lower-right
    pair of staircase points (a dominated corner can be swapped for the
    point dominating it).  Within one diagonal the area matrix between the
    two staircases is inverse-Monge, so ``_monge_best`` finds its maximum
    with O((a + b) log a) candidate rows instead of the a*b pairs; pairs in
    the wrong orientation only score <= 0 there and are covered by the
    other diagonal (y negated).
    """
    st = Lineage(points.sparkSession, 1).cut(staircases(points, x, y), force=True)
    d1 = _monge_best(_ranked(st, "ll", 1), _ranked(st, "ur", 1))
    d2 = _monge_best(_ranked(st, "ul", -1), _ranked(st, "lr", -1))
    return d1.unionByName(d2).agg(F.max("_a").cast("bigint").alias(out))


def compress(values: DataFrame, value: str, keys: list[str] = (), out: str = "idx") -> DataFrame:
    """Map each distinct value to its 1-based rank (per key)."""
    keys = list(keys)
    d = values.select(*keys, value).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    return ordered_scan(d, [value], "_one", out, "sum", keys, True).drop("_one")


# ---------------------------------------------------------------------------
# Rectilinear polygons (U23-U28).  Polygons are rings of integer vertices
# ``(poly, k, x, y)`` in ring order; a vertex stands for a unit tile and an
# edge covers the tiles it passes.  "Inside" means on the boundary or
# enclosed.
# ---------------------------------------------------------------------------


def ring_edges(vertices: DataFrame, poly: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """One edge per vertex to the next one, the last wrapping to the first."""
    w = Window.partitionBy(poly).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return vertices.select(
        poly, order, x, y,
        F.coalesce(F.lead(x).over(w), F.first(x).over(whole)).alias("nx"),
        F.coalesce(F.lead(y).over(w), F.first(y).over(whole)).alias("ny"))


def corner_inset(vertices: DataFrame, poly: str, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """The corners of a ring of tiles, moved from the tiles to the grid lines around the ring.

    A vertex (x, y) stands for the tile with corners (x, y) and (x + 1, y + 1).  The outline passes
    one of the four: away from the inside on the axis of either edge.  For a ring that runs with its
    inside on the right (y down: clockwise), an edge to the right has the inside below, one down has
    it to the left, and so on, so the offset of an axis is 1 where the edge across it has the inside
    on the lesser side.  The turn sense of the whole ring (the sign of its area) tells on which side
    the inside is, so rings may run either way.  Returns ``(poly, order, x, y, turn, ix, iy)``, turn
    being 1 where the ring bends as it does as a whole and -1 where it bends back.

    Defined cases: NULL coordinates drop the vertex; repeated vertices and those in the middle of a
    straight line are no corners and are left out; a ring without area has none.
    """
    ring = Window.partitionBy(poly).orderBy(order)
    all_of = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = vertices.select(poly, order, F.col(x).cast("bigint").alias(x), F.col(y).cast("bigint").alias(y)) \
        .where(F.col(x).isNotNull() & F.col(y).isNotNull())

    def around(df):
        """Both neighbours of every vertex, the ends wrapping round."""
        return df.select("*", *[F.coalesce(f(c).over(ring), end(c).over(all_of)).alias(f"_{side}{c}")
                                for c in (x, y) for side, f, end in (("p", F.lag, F.last), ("n", F.lead, F.first))])

    v = around(v).where((F.col(x) != F.col(f"_n{x}")) | (F.col(y) != F.col(f"_n{y}"))).select(poly, order, x, y)
    v = around(v)
    bend = (F.col(x) - F.col(f"_p{x}")) * (F.col(f"_n{y}") - F.col(y)) \
        - (F.col(y) - F.col(f"_p{y}")) * (F.col(f"_n{x}") - F.col(x))
    twice = F.sum(F.col(x) * F.col(f"_n{y}") - F.col(f"_n{x}") * F.col(y)).over(Window.partitionBy(poly))
    v = v.withColumn("_bend", F.signum(bend)).withColumn("_sense", F.signum(twice)) \
        .where((F.col("_bend") != 0) & (F.col("_sense") != 0))
    dx, dy = F.signum(F.col(f"_n{x}") - F.col(f"_p{x}")), F.signum(F.col(f"_n{y}") - F.col(f"_p{y}"))
    # the path from the previous to the next vertex goes on along both axes at a corner
    right = (dy * F.col("_sense") > 0).cast("bigint")       # going down with the inside on the left: the far side
    below = (dx * F.col("_sense") < 0).cast("bigint")
    return v.select(poly, order, x, y, (F.col("_bend") * F.col("_sense")).cast("bigint").alias("turn"),
                    (F.col(x) + right).alias("ix"), (F.col(y) + below).alias("iy"))


def compressed_axis(vertices: DataFrame, poly: str, coord: str) -> DataFrame:
    """U22 (tile form): per polygon, the distinct vertex coordinates become
    odd indices 1, 3, 5, ... ("lines", one tile wide) and the open gaps
    between them even indices ("strips", holding ``next - v - 1`` tiles,
    possibly none).  Every compressed cell is then wholly inside or wholly
    outside the polygon.  Returns ``(poly, c, v, tiles, is_line)``.
    """
    ranks = compress(vertices.select(poly, F.col(coord).alias("v")), "v", [poly], "rank")
    nxt = F.lead("v").over(Window.partitionBy(poly).orderBy("v"))
    r = ranks.withColumn("_next", nxt)
    lines = r.select(poly, (F.col("rank") * 2 - 1).alias("c"), "v", F.lit(1).cast("bigint").alias("tiles"),
                     F.lit(True).alias("is_line"))
    strips = r.where(F.col("_next").isNotNull()).select(
        poly, (F.col("rank") * 2).alias("c"), "v", (F.col("_next") - F.col("v") - 1).alias("tiles"),
        F.lit(False).alias("is_line"))
    return lines.unionByName(strips)


def _polygon_parts(vertices: DataFrame, poly: str, order: str, x: str, y: str):
    lineage = Lineage(vertices.sparkSession, 1)
    v = lineage.cut(vertices.select(poly, order, x, y), force=True)
    xs = lineage.cut(compressed_axis(v, poly, x), force=True)
    ys = lineage.cut(compressed_axis(v, poly, y), force=True)
    return v, xs, ys


def polygon_cells(vertices: DataFrame, poly: str, order: str, x: str = "x", y: str = "y",
                  parts=None) -> DataFrame:
    """U24-U26, dense form: the compressed grid of every polygon with an inside flag
    (``inside_runs`` has a row per crossing instead of one per cell).

    Returns ``(poly, cx, cy, tiles, inside)``.  Edges are rasterised in
    compressed units (U25): vertical edges give wall marks on the half-open
    row range (the crossing-number rule that makes vertices count once),
    and both edge kinds mark their closed range as boundary.  A cell is
    inside when it is boundary or has an odd number of walls to its left
    (U26, a running sum per compressed row).  All windows are per
    (polygon, row) or (polygon, column), bounded by the polygon's size.
    """
    vertices, xs, ys = parts or _polygon_parts(vertices, poly, order, x, y)
    e = ring_edges(vertices, poly, order, x, y)
    xl = xs.where("is_line").select(poly, "v", "c")
    yl = ys.where("is_line").select(poly, "v", "c")
    ce = (e.join(xl.withColumnRenamed("v", x).withColumnRenamed("c", "c0"), [poly, x])
          .join(xl.withColumnRenamed("v", "nx").withColumnRenamed("c", "c1"), [poly, "nx"])
          .join(yl.withColumnRenamed("v", y).withColumnRenamed("c", "r0"), [poly, y])
          .join(yl.withColumnRenamed("v", "ny").withColumnRenamed("c", "r1"), [poly, "ny"]))
    vert = ce.where(F.col("c0") == F.col("c1")).select(
        poly, F.col("c0").alias("cx"), F.least("r0", "r1").alias("lo"), F.greatest("r0", "r1").alias("hi"))
    horiz = ce.where(F.col("r0") == F.col("r1")).select(
        poly, F.col("r0").alias("cy"), F.least("c0", "c1").alias("lo"), F.greatest("c0", "c1").alias("hi"))
    walls = vert.where(F.col("lo") < F.col("hi")).select(
        poly, "cx", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("cy")).groupBy(poly, "cx", "cy").agg(
        F.count(F.lit(1)).alias("_walls"))
    border = (vert.select(poly, "cx", F.explode(F.sequence("lo", "hi")).alias("cy"))
              .unionByName(horiz.select(poly, F.explode(F.sequence("lo", "hi")).alias("cx"), "cy"))
              .distinct().withColumn("_edge", F.lit(True)))
    grid = (xs.select(poly, F.col("c").alias("cx"), F.col("tiles").alias("tx"))
            .join(ys.select(poly, F.col("c").alias("cy"), F.col("tiles").alias("ty")), poly))
    g = grid.join(walls, [poly, "cx", "cy"], "left").join(border, [poly, "cx", "cy"], "left")
    left = Window.partitionBy(poly, "cy").orderBy("cx").rowsBetween(Window.unboundedPreceding, -1)
    g = g.withColumn("_par", F.coalesce(F.sum(F.coalesce("_walls", F.lit(0))).over(left), F.lit(0)) % 2)
    inside = F.coalesce(F.col("_edge"), F.lit(False)) | (F.col("_par") == 1)
    return g.select(poly, "cx", "cy", (F.col("tx") * F.col("ty")).alias("tiles"), inside.alias("inside"))


WHOLE_RING = 1024     # vertices of a ring that stays in one task; longer ones are dealt out by their rows


def _by_length(vertices: DataFrame, poly: str, whole: int) -> tuple[DataFrame, DataFrame | None]:
    """The vertices of rings of up to ``whole`` vertices, and those of longer ones (None without any)."""
    long = vertices.groupBy(poly).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > whole).select(poly)
    long = Lineage(vertices.sparkSession, 1).cut(long, force=True)
    if long.isEmpty():
        return vertices, None
    return vertices.join(long, poly, "left_anti"), vertices.join(long, poly, "left_semi")


def _rings(vertices: DataFrame, poly: str, order: str, x: str, y: str) -> DataFrame:
    """One row a ring: its vertices ``(n, x, y)`` in order, ``n`` from 1."""
    ring = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_k"), F.col(x).alias("x"), F.col(y).alias("y"))))
    return spread(vertices, vertices.count(), poly).groupBy(poly).agg(ring.alias("_ring")).select(
        poly, F.transform("_ring", lambda p, i: F.struct((i + 1).cast("bigint").alias("n"), p["x"].alias("x"),
                                                         p["y"].alias("y"))).alias("ring"))


def _edges_of(rings: DataFrame, poly: str, along: str, line: str) -> DataFrame:
    """``rings`` with the sorted coordinates of their rows, ``_at``, and their ``_edges`` (vertices ``p`` and
    ``q``, from ``a`` to ``b`` along the rows, from row ``r0`` to ``r1``)."""
    rings = rings.withColumn("_at", F.array_sort(F.array_distinct(F.transform("ring", lambda p: p[line]))))
    ends = F.transform("ring", lambda p, i: F.struct(p.alias("p"), F.get("ring", (i + 1) % F.size("ring")).alias("q")))
    row = lambda v: F.array_position("_at", v[line]) * 2 - 1
    return rings.withColumn("_edges", F.transform(ends, lambda e: F.struct(
        e["p"], e["p"][along].alias("a"), e["q"][along].alias("b"), row(e["p"]).alias("r0"), row(e["q"]).alias("r1"))))


def _span_count(rings: DataFrame, poly: str, along: str, line: str) -> int:
    """A bound on the rows of ``_runs_of_rings`` before they are joined to runs."""
    rows = F.transform("_edges", lambda e: F.abs(e["r1"] - e["r0"]) + 2)
    return _edges_of(rings, poly, along, line).agg(
        F.sum(F.aggregate(rows, F.lit(0).cast("bigint"), lambda n, r: n + r))).first()[0] or 0


def _spans(rings: DataFrame, poly: str, along: str, line: str) -> DataFrame:
    """The spans of the rings' rows, one a row: walls (they end at the next one), edges and vertices (``mark``).

    A row of a ring is a line of vertices (odd ``c``) or a strip between two, ``rows`` tiles from ``y``; strips
    without tiles are left out.
    """
    def row(c, at):
        this, beyond = F.get(at, F.shiftright(c - 1, 1).cast("int")), F.get(at, F.shiftright(c + 1, 1).cast("int"))
        return F.struct(c.alias("c"), F.when(c % 2 == 1, this).otherwise(this + 1).alias("y"),
                        F.when(c % 2 == 1, F.lit(1).cast("bigint")).otherwise(beyond - this - 1).alias("rows"))

    rings = _edges_of(rings, poly, along, line)
    rings = rings.withColumn("_rows", F.transform(
        F.sequence(F.lit(1).cast("bigint"), F.size("_at").cast("bigint") * 2 - 1), lambda c: row(c, F.col("_at"))))

    def span(r, lo, hi, wall: bool, mark):
        return F.struct(r["c"].alias("c"), r["y"].alias("y"), r["rows"].alias("rows"), lo.alias("lo"),
                        hi.alias("hi"), F.lit(wall).alias("wall"), mark.alias("mark"))

    def of_edge(e):
        nothing = F.get("ring", F.lit(-1))           # a vertex that is not there
        line_of = lambda c: F.get("_rows", (c - 1).cast("int"))
        top, bottom = F.least(e["r0"], e["r1"]), F.greatest(e["r0"], e["r1"])
        crossed = F.filter(F.slice("_rows", top.cast("int"), (bottom - top).cast("int")), lambda r: r["rows"] > 0)
        walls = F.transform(crossed, lambda r: span(r, e["a"], e["a"], True, nothing))
        vertex = span(line_of(e["r0"]), e["a"], e["a"], False, e["p"])
        foot = span(line_of(bottom), e["a"], e["a"], False, nothing)
        flat = span(line_of(e["r0"]), F.least(e["a"], e["b"]), F.greatest(e["a"], e["b"]), False, nothing)
        return F.when((e["a"] == e["b"]) & (e["r0"] != e["r1"]), F.concat(walls, F.array(vertex, foot))) \
            .when(e["r0"] == e["r1"], F.array(vertex, flat)).otherwise(F.array(vertex))

    # every ring has a span; plain inline would have the optimizer test that it has, by making all spans once more
    return rings.withColumn("_spans", F.flatten(F.transform("_edges", of_edge))).select(poly, F.inline_outer("_spans"))


def _runs_of_rings(rings: DataFrame, poly: str, along: str, line: str) -> DataFrame:
    """The runs of inside tiles of whole rings (``_rings``), with the vertices on each as ``marks``.

    With ``rings`` partitioned by ``poly``, every window and aggregate is made inside these parts.
    """
    spans = _spans(rings, poly, along, line)
    in_row = Window.partitionBy(poly, "c", "wall").orderBy("lo")
    spans = spans.withColumn("_next", F.lead("lo").over(in_row)).withColumn("_nth", F.row_number().over(in_row)) \
        .where(~F.col("wall") | (F.col("_nth") % 2 == 1)) \
        .withColumn("hi", F.when(F.col("wall"), F.col("_next")).otherwise(F.col("hi")))
    in_row = Window.partitionBy(poly, "c").orderBy("lo", "hi")
    reach = F.max("hi").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("_new", F.when(F.col("lo") <= reach + 1, 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(in_row.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy(poly, "c", "_run").agg(
            F.min("y").alias("y"), F.min("rows").alias("rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.collect_list("mark").alias("marks")) \
        .select(poly, "y", "rows", (F.col("c") % 2 == 1).alias("is_line"), "lo", "hi", "marks")


def inside_runs(vertices: DataFrame, poly: str, order: str, x: str = "x", y: str = "y",
                whole: int = WHOLE_RING) -> DataFrame:
    """The runs of inside tiles of every ring, ``(poly, y, rows, is_line, lo, hi)``.

    A row is the line of a vertex (``rows`` 1) or the strip between two such lines, of ``rows`` tiles
    with equal runs.  Vertical edges cross the rows of their half-open range, and every second gap
    between crossings is inside; edges themselves are inside too (a closed range), and touching
    spans become one run.  There is a row per crossing, not per cell of a grid, and no window is
    wider than one row of one ring.

    A ring of up to ``whole`` vertices stays in one task, so that its rows are shuffled once; the
    rows of longer rings are dealt to all tasks.

    Defined cases: edges run along an axis; vertices with a NULL and rings without an id are left
    out; repeated vertices and edges that run back on themselves are boundary.
    """
    lineage = Lineage(vertices.sparkSession, 1)
    v = lineage.cut(vertices.select(poly, order, x, y).where(
        F.col(poly).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()), force=True)
    short, long = _by_length(v, poly, whole)
    rings = lineage.cut(_rings(short, poly, order, x, y), force=True)
    runs = _runs_of_rings(spread(rings, _span_count(rings, poly, "x", "y"), poly), poly, "x", "y").drop("marks")
    return runs if long is None else runs.unionByName(_runs_of_long(lineage.cut(long, force=True), poly, order, x, y))


def _runs_of_long(v: DataFrame, poly: str, order: str, x: str, y: str) -> DataFrame:
    """``inside_runs`` of rings whose rows are dealt to all tasks; no vertex has a NULL."""
    lineage = Lineage(v.sparkSession, 1)
    rows = lineage.cut(compressed_axis(v, poly, y), force=True)
    line = rows.where("is_line")
    n = v.count()
    e = ring_edges(spread(v, n, poly), poly, order, x, y) \
        .join(line.select(poly, F.col("v").alias(y), F.col("c").alias("_r0")), [poly, y]) \
        .join(line.select(poly, F.col("v").alias("ny"), F.col("c").alias("_r1")), [poly, "ny"])
    top, bottom = F.least("_r0", "_r1"), F.greatest("_r0", "_r1")
    upright = e.where((F.col(x) == F.col("nx")) & (F.col("_r0") != F.col("_r1")))
    in_row = Window.partitionBy(poly, "c").orderBy("lo")
    walls = upright.select(poly, F.explode(F.sequence(top, bottom - 1)).alias("c"), F.col(x).alias("lo"))
    # an edge crosses several rows: the parts are made for them, so that their sorts do not spill
    crossings = upright.agg(F.sum(bottom - top)).first()[0] or 0
    walls = spread(walls, crossings, poly, "c") \
        .select(poly, "c", "lo", F.lead("lo").over(in_row).alias("hi"), F.row_number().over(in_row).alias("_nth"))
    spans = walls.where(F.col("_nth") % 2 == 1).drop("_nth") \
        .unionByName(upright.select(poly, bottom.alias("c"), F.col(x).alias("lo"), F.col(x).alias("hi"))) \
        .unionByName(e.where(F.col("_r0") == F.col("_r1")).select(
            poly, F.col("_r0").alias("c"), F.least(x, "nx").alias("lo"), F.greatest(x, "nx").alias("hi")))
    in_row = Window.partitionBy(poly, "c").orderBy("lo", "hi")
    spans = spread(spans, crossings + n, poly, "c")
    reach = F.max("hi").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("_new", F.when(F.col("lo") <= reach + 1, 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(in_row.rowsBetween(Window.unboundedPreceding, 0))) \
        .groupBy(poly, "c", "_run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    first = F.when(F.col("is_line"), F.col("v")).otherwise(F.col("v") + 1)
    return runs.join(rows.where(F.col("tiles") > 0), [poly, "c"]).select(
        poly, first.alias("y"), F.col("tiles").alias("rows"), "is_line", "lo", "hi")


def pockets(runs: DataFrame, poly: str) -> DataFrame | None:
    """The outside tiles that a ring encloses, as ``(poly, y, lo, hi)`` per row; None without any.

    Gaps between the runs of a row join those that they touch in the next row.  A group of gaps is
    open when one of them touches the tiles beside the outermost runs.  Rings that do not touch
    themselves have open gaps only.  A pocket's first row is covered from above and its last from below,
    so where no gap is covered from one of these sides, nothing more is done.
    """
    lineage = Lineage(runs.sparkSession, 1)
    runs = lineage.cut(runs, force=True)
    in_row = Window.partitionBy(poly, "y").orderBy("lo")
    gaps = runs.select(poly, "y", "rows", (F.col("hi") + 1).alias("lo"), (F.lead("lo").over(in_row) - 1).alias("hi")) \
        .where(F.col("hi").isNotNull())
    covered = (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
    beyond = F.col("y") + F.col("rows")
    for gap_side, run_side in ((beyond, F.col("y")), (F.col("y"), beyond)):
        cover = runs.select(poly, run_side.alias("_at"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
        if gaps.withColumn("_at", gap_side).join(cover, [poly, "_at"]).where(covered).isEmpty():
            return None
    gaps = lineage.cut(gaps.withColumn("gap", F.struct(poly, "y", "lo")), force=True)
    upper = gaps.select(poly, (F.col("y") + F.col("rows")).alias("y"), F.col("lo").alias("_lo"),
                        F.col("hi").alias("_hi"), F.col("gap").alias("_gap"))
    links = gaps.join(upper, [poly, "y"]).where((F.col("lo") <= F.col("_hi")) & (F.col("_lo") <= F.col("hi"))) \
        .select("gap", "_gap")
    group = lineage.cut(connected_components(links, "gap", "_gap", gaps, "gap").withColumnRenamed("node", "gap"), force=True)
    width = runs.groupBy(poly, "y", "rows").agg(F.min("lo").alias("_from"), F.max("hi").alias("_to"))
    sides = gaps.withColumn("_at", F.explode(F.array(F.col("y") - 1, F.col("y") + F.col("rows"))))
    # a neighbouring row is known by its first tile from above and by its last tile from below
    ends = width.select(poly, F.explode(F.array_distinct(F.array(F.col("y"), F.col("y") + F.col("rows") - 1))).alias("_at"),
                        "_from", "_to")
    free = sides.join(ends, [poly, "_at"], "left").where(
        F.col("_from").isNull() | (F.col("lo") < F.col("_from")) | (F.col("hi") > F.col("_to")))
    is_open = free.select("gap").distinct().join(group, "gap").select("component").distinct()
    shut = group.join(is_open, "component", "left_anti").select("gap")
    inner = lineage.cut(gaps.join(shut, "gap", "left_semi").select(poly, "y", "lo", "hi"), force=True)
    return None if inner.isEmpty() else inner


def _sight(vertices: DataFrame, runs: DataFrame, poly: str, line: str, along: str, out: str, rows: int) -> DataFrame:
    """``vertices`` (about ``rows``) with the run of inside tiles that holds each on its line, as the struct ``out``."""
    marks = runs.select(poly, F.col("y").alias(line), F.col("lo").alias(along), F.struct("lo", "hi").alias("_run"))
    both = vertices.unionByName(marks, allowMissingColumns=True)
    before = Window.partitionBy(poly, line).orderBy(along, F.col("_run").isNull()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    both = spread(both, 2 * rows, poly, line)
    return both.withColumn(out, F.last("_run", ignorenulls=True).over(before)).where(F.col("_run").isNull()).drop("_run")


def _sight_of_rings(vertices: DataFrame, poly: str, order: str, lineage: Lineage) -> tuple[DataFrame, DataFrame]:
    """The level runs of whole rings, and their vertices ``(n, x, y)`` with both runs, ``h`` and ``v``,
    partitioned by ``poly``: the vertices on a run come with it."""
    rings = lineage.cut(_rings(vertices, poly, order, "x", "y"), force=True)
    level = lineage.cut(_runs_of_rings(spread(rings, _span_count(rings, poly, "x", "y"), poly), poly, "x", "y"), force=True)
    run = F.struct("lo", "hi")
    level_sight = level.select(poly, F.inline(F.transform("marks", lambda p: F.struct(p["n"], p["x"], p["y"], run.alias("h")))))
    rings = spread(level_sight, _span_count(rings, poly, "y", "x"), poly).groupBy(poly).agg(
        F.array_sort(F.collect_list(F.struct("n", "x", "y", "h"))).alias("ring"))
    plumb = _runs_of_rings(rings, poly, "y", "x").select(poly, F.inline(F.transform(
        "marks", lambda p: F.struct(p["n"], p["x"], p["y"], p["h"], run.alias("v")))))
    return level.drop("marks"), plumb


def _sight_of_long(vertices: DataFrame, poly: str, order: str, lineage: Lineage) -> tuple[DataFrame, DataFrame]:
    """As ``_sight_of_rings``, for rings whose rows are dealt to all tasks."""
    v = lineage.cut(ordered_scan(vertices.withColumn("_one", F.lit(1).cast("bigint")), [order], "_one", "n", "sum", [poly], True)
                    .drop("_one"), force=True)
    n = v.count()
    level = lineage.cut(_runs_of_long(v, poly, "n", "x", "y"), force=True)
    plumb = _runs_of_long(v, poly, "n", "y", "x").where("is_line")
    seen = _sight(v.drop(order), level.where("is_line"), poly, "y", "x", "h", n)
    seen = _sight(seen, plumb, poly, "x", "y", "v", n)
    return level, seen


VERTEX_BLOCK = 64     # consecutive vertices of a ring that meet another block's in one row


def max_interior_rectangle(vertices: DataFrame, poly: str, order: str, x: str = "x", y: str = "y",
                           out: str = "area", block: int = VERTEX_BLOCK, whole: int = WHOLE_RING) -> DataFrame:
    """Per ring, the largest (|dx|+1)(|dy|+1) rectangle with two vertices as opposite corners
    and no outside tile.

    The four sides of such a rectangle are inside if each vertex sees the other's column along its
    row and the other's row along its column, so a vertex only needs its two runs (``inside_runs``
    along either axis).  With its sides inside, a rectangle holds an outside tile only if it holds a
    whole pocket of the ring (``pockets``; most rings have none).

    A ring of up to ``whole`` vertices stays in one task: both runs of its vertices, and its blocks, are
    found with one shuffle each way.  The rows of longer rings are dealt to all tasks.

    Vertices are cut into blocks along the ring.  Two blocks meet if their ranges of sight do and if
    the rectangle that these allow is larger than the best of blocks that lie side by side, which
    are searched first.  A pair of blocks is one row, so a large ring's work is dealt to all tasks,
    and the pairs of vertices are never written.

    Defined cases: as for ``inside_runs``; a ring of one vertex has no row.
    """
    lineage = Lineage(vertices.sparkSession, 1)
    v = lineage.cut(vertices.select(poly, order, F.col(x).cast("bigint").alias("x"), F.col(y).cast("bigint").alias("y")).where(
        F.col(poly).isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull()), force=True)
    short, long = _by_length(v, poly, whole)

    def blocks_of(seen: DataFrame) -> DataFrame:
        return seen.groupBy(poly, "b").agg(
            F.collect_list(F.struct("n", "x", "y", "h", "v")).alias("all"),          # ``block`` of them
            F.min("x").alias("x1"), F.max("x").alias("x2"), F.min("y").alias("y1"), F.max("y").alias("y2"),
            F.max("h.hi").alias("hx"), F.max("v.hi").alias("vy"))

    in_block = F.floor((F.col("n") - 1) / block)
    level, seen = _sight_of_rings(short, poly, order, lineage)
    others = F.max("b").over(Window.partitionBy(poly)) > 0           # the ring has more than one block
    blocks = lineage.cut(blocks_of(seen.withColumn("b", in_block)).withColumn("others", others), force=True)
    if long is not None:
        long = lineage.cut(long, force=True)
        long_level, seen = _sight_of_long(long, poly, order, lineage)
        level = level.unionByName(long_level)
        seen = spread(seen.withColumn("b", in_block), long.count(), poly, "b")
        blocks = blocks.unionByName(lineage.cut(blocks_of(seen).withColumn("others", F.lit(True)), force=True))
    inner = pockets(level, poly)

    def side(name: str, *cols: str) -> DataFrame:
        return blocks.where("others").select(poly, *[F.col(c).alias(f"{name}_{c}") for c in ("b", *cols)])

    def extent(lo: str, hi: str, reach: str):
        return F.greatest(F.least(f"q_{hi}", f"p_{reach}") - F.col(f"p_{lo}"),
                          F.least(f"p_{hi}", f"q_{reach}") - F.col(f"q_{lo}"))

    bounds = ("x1", "x2", "y1", "y2", "hx", "vy")
    wide, high = extent("x1", "x2", "hx"), extent("y1", "y2", "vy")
    meets = side("p", *bounds).join(side("q", *bounds).where(F.col("q_b") > 0), poly).where(
        (F.col("p_b") < F.col("q_b")) & (wide >= 0) & (high >= 0)) \
        .select(poly, "p_b", "q_b", ((wide + 1) * (high + 1)).alias("bound"))

    def of_pairs(pairs: DataFrame) -> DataFrame:
        return pairs.join(side("p", "all"), [poly, "p_b"]).join(side("q", "all"), [poly, "q_b"]).select(poly, "p_all", "q_all")

    def best(pairs: DataFrame) -> DataFrame:
        opened = pairs.select(poly, "q_all", F.explode("p_all").alias("p")).select(poly, "p", F.explode("q_all").alias("q"))
        p, q = F.col("p"), F.col("q")
        sees = q["x"].between(p["h"]["lo"], p["h"]["hi"]) & p["x"].between(q["h"]["lo"], q["h"]["hi"]) \
            & q["y"].between(p["v"]["lo"], p["v"]["hi"]) & p["y"].between(q["v"]["lo"], q["v"]["hi"])
        found = opened.where((p["n"] != q["n"]) & sees).select(
            poly, F.least(p["x"], q["x"]).alias("l"), F.greatest(p["x"], q["x"]).alias("r"),
            F.least(p["y"], q["y"]).alias("t"), F.greatest(p["y"], q["y"]).alias("u"))
        if inner is not None:
            hole = inner.select(F.col(poly).alias("_of"), F.col("lo").alias("_x"), F.col("y").alias("_y"))
            found = found.join(hole, (F.col(poly) == F.col("_of")) & (F.col("_x") > F.col("l")) & (F.col("_x") < F.col("r"))
                               & (F.col("_y") > F.col("t")) & (F.col("_y") < F.col("u")), "left_anti")
        return found.groupBy(poly).agg(
            F.max((F.col("r") - F.col("l") + 1) * (F.col("u") - F.col("t") + 1)).cast("bigint").alias(out))

    # a block meets itself without a join; a ring of one block needs no other
    alone = blocks.select(poly, F.col("all").alias("p_all"), F.col("all").alias("q_all"))
    beside = of_pairs(meets.where(F.col("q_b") - F.col("p_b") == 1))
    near = lineage.cut(best(alone.unionByName(beside)), force=True)
    far = lineage.cut(meets.where(F.col("q_b") - F.col("p_b") > 1).join(near, poly, "left").where(
        F.col("bound") > F.coalesce(out, F.lit(0))).select(poly, "p_b", "q_b"), force=True)
    if far.isEmpty():
        return near
    return near.unionByName(best(of_pairs(far))).groupBy(poly).agg(F.max(out).alias(out))
