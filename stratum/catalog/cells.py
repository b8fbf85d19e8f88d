"""Grid and layered-propagation queries on ``lineitem`` (U6, U7 grid, U15, U16)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import cells as op
from stratum.sources.tables import load

# Fixed recipe parameters: grid width, neighbour threshold, first year of the levels.
GRID_COLS, THRESHOLD = 40, 4
FIRST_YEAR = 1995


def _cells(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("r"), (F.col("l_suppkey") % GRID_COLS).alias("c"))     # cells may repeat


def _splitters(spark, sf_dir):
    """A splitter where a part was shipped in a quarter: level = quarter from 1, column = part."""
    li = load(spark, sf_dir, "lineitem")
    quarter = (F.year("l_shipdate") - FIRST_YEAR) * 4 + F.quarter("l_shipdate")
    return li.select(quarter.cast("bigint").alias("level"), F.col("l_partkey").alias("col")).distinct()


def _source(spark, sf_dir):
    """A beam enters at every part."""
    return load(spark, sf_dir, "part").select(F.col("p_partkey").alias("col"))


def _last_level(sp) -> int:
    return int(sp.agg(F.max("level")).first()[0] or 0)


def q_stencil_counts(spark, sf_dir):
    return op.neighbour_counts(_cells(spark, sf_dir))


def q_stencil_sparse(spark, sf_dir):
    nb = op.neighbour_counts(_cells(spark, sf_dir))
    return nb.agg(F.count_if(F.col("n") < THRESHOLD).cast("bigint").alias("n_cells"))


def q_grid_peel(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    left = op.peel_blocked(cells, THRESHOLD).where(F.col("r").isNotNull() & F.col("c").isNotNull())
    # the cells that are left are among the cells, so both are counted and not matched
    both = op.cell_words(cells).select(F.bit_count("mask").alias("_all"), F.lit(0).alias("_kept")).unionByName(
        left.select(F.lit(0).alias("_all"), F.lit(1).alias("_kept")))
    return both.agg(F.coalesce(F.sum("_all") - F.sum("_kept"), F.lit(0)).cast("bigint").alias("n_removed"),
                    F.coalesce(F.sum("_kept"), F.lit(0)).cast("bigint").alias("n_remaining"))


def q_layered_reach(spark, sf_dir):
    sp = _splitters(spark, sf_dir)
    return op.layered_reach(_source(spark, sf_dir), sp, _last_level(sp))


def q_layered_path_counts(spark, sf_dir):
    sp = _splitters(spark, sf_dir)
    return op.layered_path_counts(_source(spark, sf_dir), sp, _last_level(sp))


QUERIES = {
    "stencil_counts": q_stencil_counts,
    "stencil_sparse": q_stencil_sparse,
    "grid_peel": q_grid_peel,
    "layered_reach": q_layered_reach,
    "layered_path_counts": q_layered_path_counts,
}

_OFFS = "offs(dr, dc) AS (VALUES " + ", ".join(f"({a}, {b})" for a, b in op.KING_OFFSETS) + ")"
_CELLS = f"cells AS (SELECT DISTINCT l_partkey AS r, l_suppkey % {GRID_COLS} AS c FROM lineitem)"
_NB = """nb AS (SELECT a.r, a.c, count(b.r) AS n FROM cells a CROSS JOIN offs
  LEFT JOIN cells b ON b.r = a.r + offs.dr AND b.c = a.c + offs.dc GROUP BY a.r, a.c)"""
_SP = f"""sp AS (SELECT DISTINCT (year(l_shipdate) - {FIRST_YEAR}) * 4 + quarter(l_shipdate) AS level, l_partkey AS col
  FROM lineitem),
mx AS (SELECT max(level) AS m FROM sp)"""
_STEP = """LEFT JOIN sp ON sp.level = b.level + 1 AND sp.col = b.col
  JOIN (VALUES (-1, true), (1, true), (0, false)) d(dc, is_split) ON d.is_split = (sp.col IS NOT NULL)
  WHERE b.level < (SELECT m FROM mx)"""

SQL = {
    "stencil_counts": f"WITH {_CELLS}, {_OFFS}, {_NB} SELECT r, c, CAST(n AS BIGINT) AS n FROM nb",
    "stencil_sparse": f"""WITH {_CELLS}, {_OFFS}, {_NB}
SELECT CAST(count(*) FILTER (WHERE n < {THRESHOLD}) AS BIGINT) AS n_cells FROM nb""",
    "grid_peel": f"""WITH RECURSIVE {_CELLS}, {_OFFS},
peel(rnd, r, c, n_cur, n_prev) AS (
  SELECT 0, r, c, (SELECT count(*) FROM cells), (SELECT count(*) FROM cells) + 1 FROM cells
  UNION ALL
  SELECT rnd, r, c, count(*) OVER (), n_prev FROM (
    SELECT p.rnd + 1 AS rnd, p.r, p.c, p.n_cur AS n_prev
    FROM peel p JOIN offs o ON true JOIN peel q ON q.rnd = p.rnd AND q.r = p.r + o.dr AND q.c = p.c + o.dc
    WHERE p.n_cur < p.n_prev
    GROUP BY p.rnd, p.r, p.c, p.n_cur HAVING count(*) >= {THRESHOLD})),
kept AS (SELECT coalesce(max(n_cur), 0) AS n FROM peel WHERE n_cur = n_prev)
SELECT CAST((SELECT count(*) FROM cells) - kept.n AS BIGINT) AS n_removed, CAST(kept.n AS BIGINT) AS n_remaining
FROM kept""",
    "layered_reach": f"""WITH RECURSIVE {_SP},
beams(level, col) AS (
  SELECT 0, p_partkey FROM part
  UNION
  SELECT b.level + 1, b.col + d.dc FROM beams b {_STEP}),
splits AS (SELECT p.level + 1 AS level, count(*) AS n FROM beams p JOIN sp ON sp.level = p.level + 1 AND sp.col = p.col
  GROUP BY p.level + 1)
SELECT CAST(b.level AS BIGINT) AS level, CAST(count(*) AS BIGINT) AS n_beams,
       CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_splits
FROM beams b LEFT JOIN splits s ON s.level = b.level WHERE b.level >= 1 GROUP BY b.level""",
    "layered_path_counts": f"""WITH RECURSIVE {_SP},
pc(level, col, paths) AS (
  SELECT 0, p_partkey, CAST(1 AS HUGEINT) FROM part
  UNION ALL
  SELECT b.level + 1, b.col + d.dc, sum(b.paths) FROM pc b {_STEP}
  GROUP BY b.level + 1, b.col + d.dc)
SELECT CAST(level AS BIGINT) AS level, CAST(col AS BIGINT) AS col, CAST(paths AS DECIMAL(38,0)) AS paths
FROM pc WHERE level >= 1""",
}
