"""Range operators: repeated-block ids, interval merging, points in ranges.

Nothing here enumerates every id of a range.  Repeated-block ids are counted
and summed in closed form per (range, length); interval merging is two
ordered scans (prefix max, prefix sum); point-in-range is one more scan, and with
keys looks up the numbers of the points at each merged interval's ends, so the
work is that of the result and no range is cut into bins.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import floor_div, int_div, is_block_repeat
from stratum.plans import Lineage, ordered_scan

DEC = "decimal(38,0)"
MAX_DIGITS = 19  # BIGINT ids have at most 19 decimal digits
PIECE = 1 << 14  # numbers of points that one row expands to


def _primes(n: int) -> list[int]:
    return [p for p in range(2, n + 1) if all(p % q for q in range(2, p))]


def period_terms(spark: SparkSession, mode: str = "any", max_len: int = MAX_DIGITS) -> DataFrame:
    """Inclusion-exclusion terms for repeated-block numbers, one row per term.

    A length-L number is a block repeated >= 2 times iff it has period L/p
    for a prime p | L; periods L/p and L/q share exactly period L/(pq), so the
    union over primes is an alternating sum over prime subsets.  ``mode``
    'twice' keeps only period L/2.  Each row carries the multiplier
    ``R = (10^L - 1) / (10^d - 1)`` and the length bounds, so the Spark side
    is plain BIGINT arithmetic.  A few dozen rows: broadcast.
    """
    top = 2 ** 63 - 1
    rows = []
    for L in range(2, max_len + 1):
        if mode == "twice":
            terms = [(L // 2, 1)] if L % 2 == 0 else []
        else:
            ps = [p for p in _primes(L) if L % p == 0]
            terms = []
            for r in range(1, len(ps) + 1):
                for subset in combinations(ps, r):
                    prod = 1
                    for p in subset:
                        prod *= p
                    terms.append((L // prod, 1 if r % 2 else -1))
        for d, sign in terms:
            rows.append((L, d, sign, (10 ** L - 1) // (10 ** d - 1), 10 ** (L - 1),
                         min(10 ** L - 1, top), 10 ** (d - 1), 10 ** d - 1))
    return spark.createDataFrame(
        rows, "L int, d int, sign int, R bigint, len_lo bigint, len_hi bigint, "
              "blk_lo bigint, blk_hi bigint")


def block_repeat_ids(ranges: DataFrame, range_id: str, lo: str, hi: str,
                     mode: str = "any") -> DataFrame:
    """Per range, count and sum of ids in [lo, hi] that are a repeated block.

    For length L and period d, such ids are ``block * R`` with ``block`` a
    d-digit number, so the ids of a range form an arithmetic series per
    (L, d): O(digits) work per range whatever its width.  Each id counts once
    per range (as in the reference, overlapping ranges count it again).
    """
    spark = ranges.sparkSession
    terms = F.broadcast(period_terms(spark, mode))
    r = ranges.select(F.col(range_id), F.greatest(F.col(lo).cast("bigint"), F.lit(1)).alias("_lo"),
                      F.col(hi).cast("bigint").alias("_hi")).where(F.col("_lo") <= F.col("_hi"))
    lengths = r.select("*", F.explode(F.sequence(F.length(F.col("_lo").cast("string")),
                                                 F.length(F.col("_hi").cast("string")))).alias("L"))
    j = lengths.join(terms, "L")
    lo_l = F.greatest(F.col("_lo"), F.col("len_lo"))
    hi_l = F.least(F.col("_hi"), F.col("len_hi"))
    bmin = F.greatest(int_div(lo_l - 1, F.col("R")) + 1, F.col("blk_lo"))   # ceil(lo_l / R)
    bmax = F.least(int_div(hi_l, F.col("R")), F.col("blk_hi"))
    j = j.select(range_id, "sign", "R", bmin.alias("_b0"), bmax.alias("_b1"))
    cnt = F.greatest(F.col("_b1") - F.col("_b0") + 1, F.lit(0).cast("bigint"))
    ends = F.col("_b0") + F.col("_b1")
    # sum of the blocks b0..b1 without an intermediate beyond BIGINT
    half = F.when(cnt % 2 == 0, ends * int_div(cnt, 2)).otherwise(int_div(ends, 2) * cnt)
    j = j.select(range_id, (F.col("sign") * cnt).alias("_n"),
                 (F.col("sign") * F.col("R").cast(DEC) * half.cast(DEC)).cast(DEC).alias("_s"))
    out = j.groupBy(range_id).agg(F.sum("_n").cast("bigint").alias("n_ids"),
                                  F.sum("_s").cast(DEC).alias("sum_ids"))
    return out.where(F.col("n_ids") > 0)


def block_repeat_filter(df: DataFrame, id_col: str) -> DataFrame:
    """Rows whose ``id_col`` text is one block repeated >= 2 times."""
    return df.where(is_block_repeat(id_col))


def merge_intervals(df: DataFrame, lo: str, hi: str, keys: list[str] = (),
                    split: bool = False) -> DataFrame:
    """Disjoint islands ``(keys, island, lo, hi)`` covering the same integers.

    Closed intervals; only those that overlap merge.  Per (keys, lo) the
    largest hi is kept first, so the order is total and a start that a third
    of the intervals share is one row.  An interval starts an island when it
    begins above every earlier end.  Empty intervals (hi < lo) and NULL bounds
    cover nothing and are dropped.
    """
    keys = list(keys)
    starts = df.where(F.col(lo) <= F.col(hi)).groupBy(*keys, lo).agg(F.max(hi).alias(hi))
    before = ordered_scan(starts, [lo], hi, "_prev_max", "max", keys, split, exclusive=True)
    flagged = before.withColumn("_new", (F.col("_prev_max").isNull() | (F.col(lo) > F.col("_prev_max"))).cast("bigint"))
    marked = ordered_scan(flagged, [lo], "_new", "island", "sum", keys, split)
    return marked.groupBy(*keys, "island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi))


def covered_length(df: DataFrame, lo: str, hi: str, keys: list[str] = (),
                   split: bool = False) -> DataFrame:
    """Number of islands and of integers covered, per key."""
    keys = list(keys)
    isl = merge_intervals(df, lo, hi, keys, split)
    return isl.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_islands"),
                                  F.sum(F.col(hi) - F.col(lo) + 1).cast("bigint").alias("covered"))


def points_in_ranges(points: DataFrame, p: str, intervals: DataFrame, lo: str, hi: str,
                     keys: list[str] = (), split: bool = False) -> DataFrame:
    """U8: distinct points covered by at least one interval (per interval key).

    Points are made distinct; intervals are merged per key.  Without keys the islands
    are disjoint, so one ordered scan of +1 at an island's start and -1 at its end tells
    of each point whether it is covered, and no row is expanded.  With keys, points are
    numbered in order and the scan gives each island the numbers of its first and last
    point; these are cut into pieces of ``PIECE`` numbers, which are dealt to all tasks
    before they are expanded, so one long island is no task's own work.
    """
    keys = list(keys)
    pts = points.select(F.col(p).alias("_at")).where(F.col("_at").isNotNull()).distinct()
    isl = merge_intervals(intervals, lo, hi, keys, split).select(
        F.struct(*keys, F.lit(0).alias("_none")).alias("_key"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    if not keys:
        def step(rows, at, kind, change):
            return rows.select(F.col(at).alias("_at"), F.lit(kind).alias("_kind"),
                               F.lit(change).cast("bigint").alias("_step"))

        events = step(isl, "_lo", 0, 1).unionByName(step(pts, "_at", 1, 0)).unionByName(step(isl, "_hi", 2, -1))
        swept = ordered_scan(events, ["_at", "_kind"], "_step", "_open", "sum", [], True)
        return swept.where((F.col("_kind") == 1) & (F.col("_open") > 0)).select(F.col("_at").alias(p))
    none = F.lit(None).cast(isl.schema["_key"].dataType)
    # at one value: island starts, then the point, then island ends
    events = pts.select("_at", F.lit(1).alias("_kind"), F.lit(1).cast("bigint").alias("_one"),
                        none.alias("_key"), F.lit(None).cast("bigint").alias("_lo")) \
        .unionByName(isl.select(F.col("_lo").alias("_at"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_one"),
                                "_key", F.col("_lo").cast("bigint").alias("_lo"))) \
        .unionByName(isl.select(F.col("_hi").alias("_at"), F.lit(2).alias("_kind"), F.lit(0).cast("bigint").alias("_one"),
                                "_key", F.col("_lo").cast("bigint").alias("_lo")))
    counted = Lineage(points.sparkSession, 1).cut(
        ordered_scan(events, ["_at", "_kind"], "_one", "_n", "sum", [], True), force=True)
    covers = counted.where(F.col("_kind") != 1).groupBy("_key", "_lo").agg(
        F.max(F.when(F.col("_kind") == 0, F.col("_n"))).alias("_before"),
        F.max(F.when(F.col("_kind") == 2, F.col("_n"))).alias("_upto")).where(F.col("_before") < F.col("_upto"))
    pieces = covers.select("_key", "_upto", F.explode(F.sequence(
        F.col("_before") + 1, F.col("_upto"), F.lit(PIECE).cast("bigint"))).alias("_from")).repartition("_from", "_upto")
    numbers = pieces.select(*[F.col(f"_key.{k}").alias(k) for k in keys], F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_upto"), F.col("_from") + PIECE - 1))).alias("_n"))
    numbered = counted.where(F.col("_kind") == 1).select("_n", F.col("_at").alias(p))
    return numbers.join(numbered, "_n").select(*keys, p)
