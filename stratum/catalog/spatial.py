"""Geometry queries on ``part`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.functions import cents
from stratum.operators import spatial as op
from stratum.plans import spread
from stratum.sources.tables import load


def _points2(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("x"), cents("p_retailprice").alias("y"))


def skyline(spark, sf_dir):
    """Per customer, the outline of monthly order counts as a ring.

    Heights are the month's order count plus one (so no month touches the
    base line), months with equal neighbouring heights are merged, and the
    ring runs (0,0) up the first bar, along every height step, down the last
    bar and back.  Returns ``(poly, k, x, y)``.
    """
    o = load(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("poly"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("bigint").alias("mi"))
    lo, hi, polys = o.agg(F.min("mi"), F.max("mi"), F.approx_count_distinct("poly")).first()
    counts = o.groupBy("poly", "mi").agg(F.count(F.lit(1)).alias("n"))
    # a customer's months come from one row: the windows below stay in the parts that are made here
    known = F.when(F.col("poly").isNotNull() & F.col("mi").isNotNull(), F.struct("mi", "n"))
    counts = spread(counts, polys * (hi - lo + 1) if polys and lo is not None else 0, "poly").groupBy("poly").agg(
        F.map_from_entries(F.collect_list(known)).alias("n"))
    months = counts.select("poly", "n", F.explode(F.sequence(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"))).alias("mi"))
    h = months.select("poly", (F.col("mi") - F.lit(lo).cast("bigint")).alias("m"),
                      (F.coalesce(F.col("n")[F.col("mi")], F.lit(0)) + 1).cast("bigint").alias("h"))
    w = Window.partitionBy("poly").orderBy("m")
    runs = (h.withColumn("_new", F.when(F.lag("h").over(w) == F.col("h"), 0).otherwise(1))
            .withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("poly", "run").agg(F.min("m").alias("s"), F.max("m").alias("e"), F.first("h").alias("h")))
    wr = Window.partitionBy("poly").orderBy("run")
    runs = runs.withColumn("h_next", F.lead("h").over(wr))
    pt = lambda k, x, y: F.struct(k.cast("bigint").alias("k"), x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
    k2 = F.col("run") * 2
    right = F.col("e") + 1
    step = F.when(F.col("h_next").isNotNull(),
                  F.array(pt(k2, right, F.col("h")), pt(k2 + 1, right, F.col("h_next")))) \
        .otherwise(F.array(pt(k2, right, F.col("h")), pt(k2 + 1, right, F.lit(0))))
    first = F.when(F.col("run") == 1, F.array(pt(F.lit(0), F.lit(0), F.lit(0)), pt(F.lit(1), F.lit(0), F.col("h")))) \
        .otherwise(F.array().cast("array<struct<k:bigint,x:bigint,y:bigint>>"))
    verts = runs.select("poly", F.explode(F.concat(first, step)).alias("v"))
    return verts.select("poly", "v.k", "v.x", "v.y")


def q_max_rectangle(spark, sf_dir):
    return op.max_rectangle(_points2(spark, sf_dir), "x", "y")


def q_compress_coordinates(spark, sf_dir):
    pts = _points2(spark, sf_dir)
    xs = op.compress(pts.select(F.col("x").alias("v")), "v").withColumn("axis", F.lit("x"))
    ys = op.compress(pts.select(F.col("y").alias("v")), "v").withColumn("axis", F.lit("y"))
    return xs.unionByName(ys).select("axis", "v", "idx")


def q_ring_edges(spark, sf_dir):
    return op.ring_edges(skyline(spark, sf_dir), "poly", "k")


def q_corner_inset(spark, sf_dir):
    return op.corner_inset(skyline(spark, sf_dir), "poly", "k")


def q_polygon_area(spark, sf_dir):
    runs = op.inside_runs(skyline(spark, sf_dir), "poly", "k")
    tiles = (F.col("hi") - F.col("lo") + 1) * F.col("rows")
    return runs.groupBy("poly").agg(F.sum(tiles).cast("bigint").alias("inside_tiles"))


def q_max_interior_rectangle(spark, sf_dir):
    return op.max_interior_rectangle(skyline(spark, sf_dir), "poly", "k")


QUERIES = {
    "max_rectangle": q_max_rectangle,
    "compress_coordinates": q_compress_coordinates,
    "ring_edges": q_ring_edges,
    "corner_inset": q_corner_inset,
    "polygon_area": q_polygon_area,
    "max_interior_rectangle": q_max_interior_rectangle,
}

_P2 = "pts AS (SELECT p_partkey AS x, CAST(round(p_retailprice * 100) AS BIGINT) AS y FROM part)"

_SKY = """o AS (SELECT o_custkey AS poly, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS mi FROM orders),
b AS (SELECT min(mi) AS lo, max(mi) AS hi FROM o),
months AS (SELECT poly, unnest(range(lo, hi + 1)) AS mi FROM (SELECT DISTINCT poly FROM o), b),
cnt AS (SELECT poly, mi, count(*) AS n FROM o GROUP BY poly, mi),
h AS (SELECT m.poly, m.mi - b.lo AS m, coalesce(c.n, 0) + 1 AS h FROM months m CROSS JOIN b
      LEFT JOIN cnt c ON c.poly = m.poly AND c.mi = m.mi),
f AS (SELECT poly, m, h, CASE WHEN lag(h) OVER (PARTITION BY poly ORDER BY m) = h THEN 0 ELSE 1 END AS nw FROM h),
g AS (SELECT poly, m, h, sum(nw) OVER (PARTITION BY poly ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM f),
runs AS (SELECT poly, run, min(m) AS s, max(m) AS e, any_value(h) AS h FROM g GROUP BY poly, run),
rn AS (SELECT *, lead(h) OVER (PARTITION BY poly ORDER BY run) AS h_next FROM runs),
verts AS (
  SELECT poly, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS x, CAST(0 AS BIGINT) AS y FROM rn WHERE run = 1
  UNION ALL SELECT poly, 1, 0, h FROM rn WHERE run = 1
  UNION ALL SELECT poly, 2 * run, e + 1, h FROM rn
  UNION ALL SELECT poly, 2 * run + 1, e + 1, coalesce(h_next, 0) FROM rn),
edges AS (SELECT poly, k, x, y,
  coalesce(lead(x) OVER (PARTITION BY poly ORDER BY k), first_value(x) OVER (PARTITION BY poly ORDER BY k)) AS nx,
  coalesce(lead(y) OVER (PARTITION BY poly ORDER BY k), first_value(y) OVER (PARTITION BY poly ORDER BY k)) AS ny
  FROM verts)"""

# brute force over every tile of each polygon's bounding box
_TILES = """bbox AS (SELECT poly, max(x) AS mx, max(y) AS my FROM verts GROUP BY poly),
tiles AS (SELECT poly, tx, ty FROM (SELECT poly, unnest(range(0, mx + 1)) AS tx, my FROM bbox),
          LATERAL (SELECT unnest(range(0, my + 1)) AS ty)),
onb AS (SELECT DISTINCT t.poly, t.tx, t.ty FROM tiles t JOIN edges e ON e.poly = t.poly
        AND t.tx BETWEEN least(e.x, e.nx) AND greatest(e.x, e.nx) AND t.ty BETWEEN least(e.y, e.ny) AND greatest(e.y, e.ny)),
cross_ct AS (SELECT t.poly, t.tx, t.ty, count(e.k) AS c FROM tiles t LEFT JOIN edges e ON e.poly = t.poly AND e.x = e.nx
        AND e.x < t.tx AND t.ty >= least(e.y, e.ny) AND t.ty < greatest(e.y, e.ny) GROUP BY t.poly, t.tx, t.ty),
ins AS (SELECT c.poly, c.tx, c.ty, (c.c % 2 = 1 OR b.tx IS NOT NULL) AS inside FROM cross_ct c
        LEFT JOIN onb b ON b.poly = c.poly AND b.tx = c.tx AND b.ty = c.ty)"""

SQL = {
    "max_rectangle": f"""WITH {_P2}
SELECT CAST(max((abs(a.x - b.x) + 1) * (abs(a.y - b.y) + 1)) AS BIGINT) AS area FROM pts a, pts b""",
    "compress_coordinates": f"""WITH {_P2}
SELECT 'x' AS axis, x AS v, CAST(dense_rank() OVER (ORDER BY x) AS BIGINT) AS idx FROM (SELECT DISTINCT x FROM pts)
UNION ALL
SELECT 'y', y, CAST(dense_rank() OVER (ORDER BY y) AS BIGINT) FROM (SELECT DISTINCT y FROM pts)""",
    "ring_edges": f"WITH {_SKY} SELECT poly, k, x, y, nx, ny FROM edges",
    # by a table of the directions of both edges; these rings go up first, with the inside on the right
    "corner_inset": f"""WITH {_SKY},
d AS (SELECT *, CASE WHEN ny > y THEN 'up' WHEN ny < y THEN 'down' WHEN nx > x THEN 'right' ELSE 'left' END AS away
      FROM edges),
c AS (SELECT *, coalesce(lag(away) OVER w, last_value(away) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS came
      FROM d WINDOW w AS (PARTITION BY poly ORDER BY k)),
t(came, away, turn, dx, dy) AS (VALUES ('up', 'right', 1, 0, 1), ('right', 'down', 1, 1, 1), ('down', 'left', 1, 1, 0),
  ('left', 'up', 1, 0, 0), ('right', 'up', -1, 0, 1), ('up', 'left', -1, 0, 0), ('left', 'down', -1, 1, 0), ('down', 'right', -1, 1, 1))
SELECT poly, k, x, y, CAST(turn AS BIGINT) AS turn, CAST(x + dx AS BIGINT) AS ix, CAST(y + dy AS BIGINT) AS iy
FROM c JOIN t USING (came, away)""",
    "polygon_area": f"""WITH {_SKY}, {_TILES}
SELECT poly, CAST(count(*) AS BIGINT) AS inside_tiles FROM ins WHERE inside GROUP BY poly""",
    "max_interior_rectangle": f"""WITH {_SKY}, {_TILES},
o1 AS (SELECT poly, tx, ty, sum(CASE WHEN inside THEN 0 ELSE 1 END) OVER (PARTITION BY poly, ty ORDER BY tx
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s1 FROM ins),
sat AS (SELECT poly, tx, ty, sum(s1) OVER (PARTITION BY poly, tx ORDER BY ty ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM o1),
pairs AS (SELECT a.poly, (abs(a.x - b.x) + 1) * (abs(a.y - b.y) + 1) AS area,
  least(a.x, b.x) AS x1, greatest(a.x, b.x) AS x2, least(a.y, b.y) AS y1, greatest(a.y, b.y) AS y2
  FROM verts a JOIN verts b ON a.poly = b.poly AND a.k < b.k)
SELECT p.poly, CAST(max(p.area) AS BIGINT) AS area FROM pairs p
LEFT JOIN sat s22 ON s22.poly = p.poly AND s22.tx = p.x2 AND s22.ty = p.y2
LEFT JOIN sat s12 ON s12.poly = p.poly AND s12.tx = p.x1 - 1 AND s12.ty = p.y2
LEFT JOIN sat s21 ON s21.poly = p.poly AND s21.tx = p.x2 AND s21.ty = p.y1 - 1
LEFT JOIN sat s11 ON s11.poly = p.poly AND s11.tx = p.x1 - 1 AND s11.ty = p.y1 - 1
WHERE coalesce(s22.s, 0) - coalesce(s12.s, 0) - coalesce(s21.s, 0) + coalesce(s11.s, 0) = 0
GROUP BY p.poly""",
}
