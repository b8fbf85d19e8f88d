"""Ordered scans (running sum / max / min) that never funnel into one task.

A window ordered over a whole table, or over one hot key, is evaluated by a
single task.  With ``split=True`` the rows are range-partitioned by (keys,
order) instead, into as many parts as the session has shuffle partitions:

1. the range-partitioned rows are written once with their part number, so the
   input is evaluated for the bounds and for the write, and never again;
2. a window *inside* each (key, part) gives the local running value;
3. one total per (key, part), and a window over those totals, give the carry
   into each part that continues a key.  A part continues at most one key, so
   the carries are no more rows than parts, and they are broadcast.

The bounds are sampled over the whole (keys, order) tuple, so a hot key and
many rows on one order value split as well.  NULL keys are a group of their
own; NULL order values stand where the sort order of the column puts them
(first when ascending), in the window and in the partitioning alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.plans.loops import Lineage

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def ordered_scan(df: DataFrame, order: list[str | Column], value: str | Column,
                 out: str, agg: str = "sum", keys: list[str] = (),
                 split: bool = False, exclusive: bool = False) -> DataFrame:
    """Add ``out`` = running ``agg`` of ``value`` in ``order`` within ``keys``.

    ``exclusive`` excludes the current row (NULL when nothing precedes).
    With ``split``, the two-level plan above is used (it runs jobs while it is
    built); without it, a plain window partitioned by ``keys`` (fine when keys
    are many and small).
    """
    return ordered_scans(df, order, [(value, out, agg)], keys, split, exclusive)


def ordered_scans(df: DataFrame, order: list[str | Column], specs: list[tuple],
                  keys: list[str] = (), split: bool = False,
                  exclusive: bool = False) -> DataFrame:
    """Several running aggregates ``(value, out, agg)`` over one ordering,
    sharing one range partitioning and one pass over the totals."""
    keys = list(keys)
    end = -1 if exclusive else Window.currentRow
    specs = [((F.col(v) if isinstance(v, str) else v), o, a) for v, o, a in specs]
    if not split:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
        return df.select("*", *[_AGG[a](v).over(w).alias(o) for v, o, a in specs])

    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    types = {o: df.select(_AGG[a](v)).schema[0].dataType for v, o, a in specs}
    ranged = df.select("*", *[v.alias(f"_val_{o}") for v, o, a in specs]) \
        .repartitionByRange(n_parts, *keys, *order).withColumn("_part", F.spark_partition_id())
    ranged = Lineage(spark, 1).cut(ranged, force=True)
    w_loc = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = ranged.select("*", *[_AGG[a](f"_val_{o}").over(w_loc).alias(f"_loc_{o}") for v, o, a in specs])
    totals = ranged.groupBy(*keys, "_part").agg(*[_AGG[a](f"_val_{o}").alias(f"_tot_{o}") for v, o, a in specs])
    w_off = Window.partitionBy(*keys).orderBy("_part")
    carry = totals.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_part").alias("_into"),
        F.row_number().over(w_off).alias("_nth"),
        *[_AGG[a](f"_tot_{o}").over(w_off.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_off_{o}")
          for v, o, a in specs]).where(F.col("_nth") > 1).drop("_nth")
    same = F.col("_part") == F.col("_into")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key{i}"))
    joined = local.join(F.broadcast(carry), same, "left")   # at most n_parts rows
    outs = []
    for v, o, a in specs:
        off, loc = F.col(f"_off_{o}"), F.col(f"_loc_{o}")
        if a == "sum":
            combined = F.when(off.isNull() & loc.isNull(), F.lit(None)).otherwise(
                F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0)))
        elif a == "max":
            combined = F.greatest(off, loc)
        else:
            combined = F.least(off, loc)
        outs.append(combined.cast(types[o]).alias(o))
    return joined.select(*df.columns, *outs)
