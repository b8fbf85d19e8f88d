"""Ordered-sequence queries on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators import ordered as op
from stratum.sources import recipes

# Fixed parameters of the running-total operators (the reference's start and
# modulus): totals start at 50, hits and crossings are counted modulo 100.
START, MOD, RESIDUE = 50, 100, 0
SUBSEQ_K = 12

ORDER = ["ts", "event_id"]

STEPS_SQL = """steps AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN event_type IN ('error', 'view') THEN -CAST(round(value * 100) AS BIGINT)
              ELSE CAST(round(value * 100) AS BIGINT) END AS delta
  FROM events)"""

DIGITS_SQL = """digits AS (
  SELECT user_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS pos,
         CAST(((CAST(round(value * 100) AS BIGINT) % 9) + 9) % 9 + 1 AS BIGINT) AS digit
  FROM events)"""


def q_running_residue_hits(spark, sf_dir):
    return op.running_residue_hits(recipes.steps(spark, sf_dir), ORDER, "delta", START, MOD,
                                   RESIDUE, keys=["user_id"], split=True)


def q_running_residue_hits_global(spark, sf_dir):
    return op.running_residue_hits(recipes.steps(spark, sf_dir), ORDER, "delta", START, MOD,
                                   RESIDUE, keys=[], split=True)


def q_modulus_crossings(spark, sf_dir):
    return op.modulus_crossings(recipes.steps(spark, sf_dir), ORDER, "delta", START, MOD,
                                keys=["user_id"], split=True)


def q_modulus_crossings_global(spark, sf_dir):
    return op.modulus_crossings(recipes.steps(spark, sf_dir), ORDER, "delta", START, MOD,
                                keys=[], split=True)


def q_best_ordered_pair(spark, sf_dir):
    return op.best_ordered_pair(recipes.digits(spark, sf_dir), ["user_id"], "pos", "digit")


def q_best_k_subsequence(spark, sf_dir):
    return op.best_k_subsequence(recipes.digits(spark, sf_dir), ["user_id"], "pos", "digit",
                                 SUBSEQ_K)


def q_delimiter_groups(spark, sf_dir):
    st = recipes.steps(spark, sf_dir)
    g = op.delimiter_groups(st, ORDER, F.col("event_type") == "signup", keys=["user_id"],
                            split=True)
    return g.groupBy("user_id", "grp").agg(F.count(F.lit(1)).alias("n_events"),
                                           F.sum("delta").cast("bigint").alias("net_delta"))


def q_suffix_max(spark, sf_dir):
    d = recipes.digits(spark, sf_dir)
    return op.suffix_max(d, ["pos"], "digit", ["user_id"], "later_max", True).select(
        "user_id", "pos", "digit", "later_max")


QUERIES = {
    "suffix_max": q_suffix_max,
    "running_residue_hits": q_running_residue_hits,
    "running_residue_hits_global": q_running_residue_hits_global,
    "modulus_crossings": q_modulus_crossings,
    "modulus_crossings_global": q_modulus_crossings_global,
    "best_ordered_pair": q_best_ordered_pair,
    "best_k_subsequence": q_best_k_subsequence,
    "delimiter_groups": q_delimiter_groups,
}

_TOTALS = lambda part: f"""totals AS (
  SELECT {part}delta, {START} + SUM(delta) OVER ({'PARTITION BY user_id ' if part else ''}ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM steps)"""

_FL = lambda x: f"(({x}) - ((({x}) % {MOD}) + {MOD}) % {MOD}) // {MOD}"

_CROSS = f"""CASE WHEN delta > 0 THEN {_FL('total')} - {_FL('total - delta')}
              WHEN delta < 0 THEN {_FL('total - delta - 1')} - {_FL('total - 1')}
              ELSE 0 END"""

SQL = {
    "suffix_max": f"""WITH {DIGITS_SQL}
SELECT user_id, pos, digit, max(digit) OVER (PARTITION BY user_id ORDER BY pos
  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later_max FROM digits""",
    "running_residue_hits": f"""WITH {STEPS_SQL}, {_TOTALS('user_id, ')}
SELECT user_id, CAST(count(*) FILTER (WHERE ((total % {MOD}) + {MOD}) % {MOD} = {RESIDUE}) AS BIGINT) AS hits
FROM totals GROUP BY user_id""",
    "running_residue_hits_global": f"""WITH {STEPS_SQL}, {_TOTALS('')}
SELECT CAST(count(*) FILTER (WHERE ((total % {MOD}) + {MOD}) % {MOD} = {RESIDUE}) AS BIGINT) AS hits
FROM totals""",
    "modulus_crossings": f"""WITH {STEPS_SQL}, {_TOTALS('user_id, ')}
SELECT user_id, CAST(SUM({_CROSS}) AS BIGINT) AS crossings FROM totals GROUP BY user_id""",
    "modulus_crossings_global": f"""WITH {STEPS_SQL}, {_TOTALS('')}
SELECT CAST(SUM({_CROSS}) AS BIGINT) AS crossings FROM totals""",
    "best_ordered_pair": f"""WITH {DIGITS_SQL}
SELECT a.user_id, CAST(max(10 * a.digit + b.digit) AS BIGINT) AS best
FROM digits a JOIN digits b ON a.user_id = b.user_id AND a.pos < b.pos
GROUP BY a.user_id""",
    "best_k_subsequence": f"""WITH RECURSIVE {DIGITS_SQL},
lens AS (SELECT user_id, max(pos) AS n FROM digits GROUP BY user_id),
pick(user_id, i, last_pos, val) AS (
  SELECT user_id, 0, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM lens WHERE n >= {SUBSEQ_K}
  UNION ALL
  SELECT p.user_id, p.i + 1,
         (SELECT d.pos FROM digits d WHERE d.user_id = p.user_id AND d.pos > p.last_pos
            AND d.pos <= l.n - ({SUBSEQ_K} - p.i - 1) ORDER BY d.digit DESC, d.pos LIMIT 1),
         p.val * 10 + (SELECT max(d.digit) FROM digits d WHERE d.user_id = p.user_id
            AND d.pos > p.last_pos AND d.pos <= l.n - ({SUBSEQ_K} - p.i - 1))
  FROM pick p JOIN lens l ON l.user_id = p.user_id WHERE p.i < {SUBSEQ_K})
SELECT user_id, CAST(val AS BIGINT) AS best FROM pick WHERE i = {SUBSEQ_K}""",
    "delimiter_groups": f"""WITH {STEPS_SQL},
g AS (SELECT user_id, delta, SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp
      FROM steps)
SELECT user_id, CAST(grp AS BIGINT) AS grp, CAST(count(*) AS BIGINT) AS n_events,
       CAST(SUM(delta) AS BIGINT) AS net_delta
FROM g GROUP BY user_id, grp""",
}
