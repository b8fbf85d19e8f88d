"""Ordered-sequence operators (running totals, best subsequences, groups).

Sequences are rows ``(keys..., order..., value)``; ``keys=[]`` means one
sequence over the whole table.  Running values go through
``stratum.plans.ordered_scan`` so neither the keyless case nor a hot key is
evaluated by a single task when ``split`` is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.functions import floor_div
from stratum.plans import Lineage, join_on_group, ordered_scan


def running_total(df: DataFrame, order: list, delta: str, start: int = 0,
                  keys: list[str] = (), split: bool = False,
                  out: str = "total") -> DataFrame:
    """``out`` = start + inclusive running sum of ``delta`` (per key)."""
    scanned = ordered_scan(df, order, delta, "_run", "sum", keys, split)
    return scanned.withColumn(out, F.lit(start).cast("bigint") + F.col("_run")).drop("_run")


def running_residue_hits(df: DataFrame, order: list, delta: str, start: int, m: int,
                         r: int = 0, keys: list[str] = (), split: bool = False,
                         out: str = "hits") -> DataFrame:
    """Count running totals congruent to ``r`` modulo ``m`` (per key)."""
    tot = running_total(df, order, delta, start, keys, split)
    hit = F.pmod(F.col("total"), F.lit(m)) == F.lit(r % m)
    return tot.groupBy(*keys).agg(F.count_if(hit).cast("bigint").alias(out))


def modulus_crossings(df: DataFrame, order: list, delta: str, start: int, m: int,
                      keys: list[str] = (), split: bool = False,
                      out: str = "crossings") -> DataFrame:
    """Multiples of ``m`` touched or passed by the running total (per key).

    A step from ``prev`` to ``cur`` counts multiples in (prev, cur] going up
    and in [cur, prev) going down.  ``prev`` is ``cur - delta``, so no lag
    window is needed.
    """
    tot = running_total(df, order, delta, start, keys, split, out="_cur")
    cur = F.col("_cur")
    prev = cur - F.col(delta)
    up = floor_div(cur, m) - floor_div(prev, m)
    down = floor_div(prev - 1, m) - floor_div(cur - 1, m)
    step = F.when(F.col(delta) > 0, up).when(F.col(delta) < 0, down).otherwise(F.lit(0))
    return tot.groupBy(*keys).agg(F.sum(step).cast("bigint").alias(out))


def best_ordered_pair(df: DataFrame, keys: list[str], pos: str, digit: str,
                      out: str = "best") -> DataFrame:
    """Largest two-digit number ``10*d_i + d_j`` with i < j, per key.

    Only per-(key, digit) first/last positions are needed: the tens digit is
    the largest digit whose first occurrence is not the last position; the
    ones digit is the largest digit occurring after that first occurrence.
    Everything is a map-side-combined aggregate, so a hot key costs no more
    than a cold one.
    """
    keys = list(keys)
    summ = df.groupBy(*keys, digit).agg(F.min(pos).alias("_first"), F.max(pos).alias("_last"))
    n = summ.groupBy(*keys).agg(F.max("_last").alias("_n"))
    tens = (summ.join(n, keys).where(F.col("_first") < F.col("_n"))
            .groupBy(*keys).agg(F.max(F.struct(F.col(digit), F.col("_first"))).alias("_t")))
    tens = tens.select(*keys, F.col("_t")[digit].alias("_a"), F.col("_t")["_first"].alias("_af"))
    ones = (summ.join(tens, keys).where(F.col("_last") > F.col("_af"))
            .groupBy(*keys, "_a").agg(F.max(digit).alias("_b")))
    return ones.select(*keys, (F.col("_a") * 10 + F.col("_b")).cast("bigint").alias(out))


def best_k_subsequence(df: DataFrame, keys: list[str], pos: str, digit: str, k: int,
                       out: str = "best") -> DataFrame:
    """Largest k-digit number formed by an order-keeping subsequence, per key.

    Greedy: pick i takes, after the pick before and up to position n - k + i,
    the largest digit, the earliest on ties.  Among the first n - k + 1
    positions only an element with no larger later one there can ever be
    picked, and only the first k of those; with the last k - 1 positions that
    leaves at most 2k - 1 rows per key, found by one split suffix maximum, and
    the k picks fold over them.  Keys shorter than k have no answer.  Requires
    positions 1..n per key.
    """
    keys = list(keys)
    data = Lineage(df.sparkSession, 1).cut(df.select(*keys, F.col(pos).cast("bigint").alias("_p"),
                                                     F.col(digit).cast("bigint").alias("_d")), force=True)
    n = data.groupBy(*keys).agg(F.max("_p").alias("_n")).where(F.col("_n") >= k)
    data = join_on_group(data, n, keys)
    early = F.col("_p") <= F.col("_n") - (k - 1)
    later = suffix_max(data.where(early), ["_p"], "_d", keys, "_later", True)
    top = later.where(F.col("_later").isNull() | (F.col("_later") <= F.col("_d")))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_p"))
    few = top.withColumn("_rank", rank).where(F.col("_rank") <= k).select(*keys, "_n", "_p", "_d") \
        .unionByName(data.where(~early).select(*keys, "_n", "_p", "_d"))
    packed = few.groupBy(*keys, "_n").agg(F.collect_list(F.struct("_d", (-F.col("_p")).alias("_np"))).alias("_all"))
    start = F.struct(F.lit(0).cast("bigint").alias("last"), F.lit(0).cast("bigint").alias("val"))

    def pick(acc: Column, i: Column) -> Column:
        best = F.array_max(F.filter("_all", lambda x: (-x["_np"] > acc["last"])
                                    & (-x["_np"] <= F.col("_n") - k + i)))
        return F.struct((-best["_np"]).alias("last"), (acc["val"] * 10 + best["_d"]).alias("val"))

    folded = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.lit(k).cast("bigint")), start, pick, lambda acc: acc["val"])
    return packed.select(*keys, folded.alias(out))


def delimiter_groups(df: DataFrame, order: list, is_break: Column | str, keys: list[str] = (),
                     split: bool = False, out: str = "grp") -> DataFrame:
    """Gaps-and-islands: ``out`` = running count of break flags (per key)."""
    flag = (F.col(is_break) if isinstance(is_break, str) else is_break).cast("bigint")
    return ordered_scan(df.withColumn("_brk", flag), order, "_brk", out, "sum", keys, split).drop("_brk")


def suffix_max(df: DataFrame, order: list[str], value: str, keys: list[str] = (),
               out: str = "suffix_max", split: bool = False) -> DataFrame:
    """Max of the elements after the current one (NULL for the last),
    per key.  Evaluated as an exclusive running max in reversed order, so
    the two-level scan applies."""
    rev = [F.col(o).desc() for o in order]
    return ordered_scan(df, rev, value, out, "max", keys, split, exclusive=True)


def previous_value(df: DataFrame, order: list[str], value: str | Column, out: str,
                   keys: list[str] = (), split: bool = False, default=None) -> DataFrame:
    """LAG(value, 1, default) without a key-wide window.

    The previous row under a total order is the exclusive running maximum of
    ``struct(order..., value)``, so the two-level scan applies and a
    hot key or the keyless case is split across tasks.
    """
    val = F.col(value) if isinstance(value, str) else value
    packed = F.struct(*[F.col(o).alias(f"_o{k}") for k, o in enumerate(order)], val.alias("_v"))
    scanned = ordered_scan(df.withColumn("_pk", packed), order, "_pk", "_prev", "max", keys,
                           split, exclusive=True)
    prev = F.col("_prev._v")
    if default is not None:
        prev = F.coalesce(prev, F.lit(default))
    return scanned.withColumn(out, prev).drop("_pk", "_prev")
