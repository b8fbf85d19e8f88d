"""Range queries on ``orders`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import ranges as op
from stratum.operators.ranges import _primes
from stratum.sources.tables import load

# Fixed recipe parameters: id ranges from order keys, interval groups.
RANGE_MUL, RANGE_OFF, RANGE_SPAN = 37, 10, 5000
N_GROUPS, MAX_LEN_DAYS = 50, 7
EPOCH = "1995-01-01"


def _ranges(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    lo = F.col("o_orderkey") * RANGE_MUL + RANGE_OFF
    return o.select(F.col("o_orderkey").alias("range_id"), lo.alias("lo"),
                    (lo + F.floor("o_totalprice") % RANGE_SPAN).alias("hi"))


def _intervals(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    lo = F.datediff(F.to_date("o_orderdate"), F.lit(EPOCH)).cast("bigint")
    return o.select((F.col("o_orderkey") % N_GROUPS).alias("g"), lo.alias("lo"),
                    (lo + F.col("o_orderkey") % MAX_LEN_DAYS).alias("hi"))


def _days(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.datediff(F.to_date("l_shipdate"), F.lit(EPOCH)).cast("bigint").alias("p"))


def q_block_repeat_twice(spark, sf_dir):
    return op.block_repeat_ids(_ranges(spark, sf_dir), "range_id", "lo", "hi", "twice")


def q_block_repeat_any(spark, sf_dir):
    return op.block_repeat_ids(_ranges(spark, sf_dir), "range_id", "lo", "hi", "any")


def q_block_repeat_filter(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return op.block_repeat_filter(o, "o_orderkey")


def q_merge_intervals(spark, sf_dir):
    return op.merge_intervals(_intervals(spark, sf_dir), "lo", "hi", ["g"], True).drop("island")


def q_covered_length(spark, sf_dir):
    return op.covered_length(_intervals(spark, sf_dir), "lo", "hi", ["g"], True)


def q_covered_length_global(spark, sf_dir):
    return op.covered_length(_intervals(spark, sf_dir), "lo", "hi", [], split=True)


def q_points_in_ranges(spark, sf_dir):
    pts = op.points_in_ranges(_days(spark, sf_dir), "p", _intervals(spark, sf_dir),
                              "lo", "hi", [], True)
    return pts.agg(F.count(F.lit(1)).alias("n_points"))


def q_points_in_ranges_by_group(spark, sf_dir):
    pts = op.points_in_ranges(_days(spark, sf_dir), "p", _intervals(spark, sf_dir), "lo", "hi",
                              ["g"], True)
    return pts.groupBy("g").agg(F.count(F.lit(1)).alias("n_points"))


QUERIES = {
    "block_repeat_twice": q_block_repeat_twice,
    "block_repeat_any": q_block_repeat_any,
    "block_repeat_filter": q_block_repeat_filter,
    "merge_intervals": q_merge_intervals,
    "covered_length": q_covered_length,
    "covered_length_global": q_covered_length_global,
    "points_in_ranges": q_points_in_ranges,
    "points_in_ranges_by_group": q_points_in_ranges_by_group,
}

# Brute force for the oracle: every id of every range, tested as text.
_IDS = f"""r AS (
  SELECT o_orderkey AS range_id, o_orderkey * {RANGE_MUL} + {RANGE_OFF} AS lo,
         o_orderkey * {RANGE_MUL} + {RANGE_OFF} + CAST(floor(o_totalprice) AS BIGINT) % {RANGE_SPAN} AS hi
  FROM orders),
ids AS (SELECT range_id, id, CAST(id AS VARCHAR) AS t FROM (SELECT range_id, unnest(range(lo, hi + 1)) AS id FROM r))"""


def _repeat_pred(t: str) -> str:
    """Text test: t is its own prefix of length len/p repeated p times, some prime p."""
    parts = [f"(len({t}) % {p} = 0 AND repeat(left({t}, len({t}) // {p}), {p}) = {t})"
             for p in _primes(op.MAX_DIGITS)]
    return "(" + " OR ".join(parts) + ")"


_TWICE = "(len(t) % 2 = 0 AND left(t, len(t) // 2) = right(t, len(t) // 2))"

_IV = f"""iv AS (
  SELECT o_orderkey % {N_GROUPS} AS g,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) AS BIGINT) AS lo,
         CAST(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) AS BIGINT) + o_orderkey % {MAX_LEN_DAYS} AS hi
  FROM orders)"""

_ISLANDS = """m AS (SELECT g, lo, hi, max(hi) OVER (PARTITION BY g ORDER BY lo, hi
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM iv),
f AS (SELECT g, lo, hi, SUM(CASE WHEN pm IS NULL OR lo > pm THEN 1 ELSE 0 END) OVER (PARTITION BY g
          ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM m),
isl AS (SELECT g, min(lo) AS lo, max(hi) AS hi FROM f GROUP BY g, island)"""

_PTS = f"""pts AS (SELECT DISTINCT CAST(date_diff('day', DATE '{EPOCH}', CAST(l_shipdate AS DATE)) AS BIGINT) AS p
  FROM lineitem)"""

SQL = {
    "block_repeat_twice": f"""WITH {_IDS}
SELECT range_id, count(*) AS n_ids, CAST(sum(id) AS DECIMAL(38,0)) AS sum_ids
FROM ids WHERE {_TWICE} GROUP BY range_id""",
    "block_repeat_any": f"""WITH {_IDS}
SELECT range_id, count(*) AS n_ids, CAST(sum(id) AS DECIMAL(38,0)) AS sum_ids
FROM ids WHERE {_repeat_pred('t')} GROUP BY range_id""",
    "block_repeat_filter": f"""SELECT o_orderkey, o_custkey FROM orders
WHERE {_repeat_pred('CAST(o_orderkey AS VARCHAR)')}""",
    "merge_intervals": f"WITH {_IV}, {_ISLANDS} SELECT g, lo, hi FROM isl",
    "covered_length": f"""WITH {_IV}, {_ISLANDS}
SELECT g, count(*) AS n_islands, CAST(sum(hi - lo + 1) AS BIGINT) AS covered FROM isl GROUP BY g""",
    "covered_length_global": f"""WITH {_IV.replace(f'o_orderkey % {N_GROUPS} AS g', '0 AS g')}, {_ISLANDS}
SELECT count(*) AS n_islands, CAST(sum(hi - lo + 1) AS BIGINT) AS covered FROM isl""",
    "points_in_ranges": f"""WITH {_IV}, {_PTS}
SELECT count(DISTINCT p) AS n_points FROM pts JOIN iv ON p BETWEEN lo AND hi""",
    "points_in_ranges_by_group": f"""WITH {_IV}, {_PTS}
SELECT g, count(DISTINCT p) AS n_points FROM pts JOIN iv ON p BETWEEN lo AND hi GROUP BY g""",
}
