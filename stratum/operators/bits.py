"""Bit-set operators on BIGINT masks.

Bits are set with ``shiftleft(1L, i)``, never through DOUBLE powers.  A bitmap
of any length is rows of ``(word_no, mask)`` with ``WORD_BITS`` bits each.  The
minimum-XOR-subset search visits at most 2^bits XOR states per group instead of
2^masks subsets: as a table for narrow masks, else breadth-first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import bit, int_div
from stratum.plans import Lineage, spread

WORD_BITS = 63


def mask_from_text(df: DataFrame, text: str, chars: str, keep: list[str], word: str = "word_no",
                   out: str = "mask") -> DataFrame:
    """Bit i of the bitmap is set where character i (0-based) of ``text`` is in ``chars``.

    One row per ``WORD_BITS`` characters, without a shuffle: character i is bit
    i % 63 of word i div 63.  An empty or NULL text has no rows.
    """
    letters = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), ""), lambda ch: ch != "")
    n_words = F.ceil(F.size("_letters") / WORD_BITS).cast("int")

    def mask(w: Column) -> Column:
        flags = F.transform(F.slice("_letters", w * WORD_BITS + 1, F.lit(WORD_BITS)), lambda ch, i: F.when(
            ch.isin(*list(chars)), bit(i)).otherwise(F.lit(0).cast("bigint")))
        return F.aggregate(flags, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseOR(b))

    masks = F.transform(F.sequence(F.lit(0), n_words - 1), mask)
    return df.select(*keep, letters.alias("_letters")).where(F.size("_letters") > 0) \
        .select(*keep, F.posexplode(masks).alias("_w", out)) \
        .select(*keep, F.col("_w").cast("bigint").alias(word), out)


def mask_from_positions(df: DataFrame, keys: list[str], position: str, word: str = "word_no",
                        out: str = "mask") -> DataFrame:
    """Per group, the bitmap with bit ``position`` set for every row, as ``(word_no, mask)``
    (``bit_or`` combines map-side; repeated positions set the bit once).  NULL positions set
    nothing; a negative one is an error."""
    at = F.col(position).cast("bigint")
    checked = F.when(at < 0, F.raise_error(F.lit("mask_from_positions: negative position"))).otherwise(at)
    rows = df.select(*keys, checked.cast("bigint").alias("_at")).where(F.col("_at").isNotNull())
    return rows.groupBy(*keys, int_div("_at", WORD_BITS).alias(word)).agg(
        F.bit_or(bit(F.col("_at") % WORD_BITS)).alias(out))


def xor_fold(df: DataFrame, keys: list[str], mask: str, out: str = "xor") -> DataFrame:
    """XOR of all masks per group."""
    return df.groupBy(*keys).agg(F.bit_xor(mask).alias(out))


NEVER = 1 << 30
NARROW = 10                  # bits of the masks that a table of all XOR values is kept for
TABLE_CELLS = 1 << 20        # cells of the tables that a task holds at a time


def _table_search(narrow: int, cells: int, never: int):
    """Rows (group, presses) of batches (group, span, masks, targets); -1 where the masks are too wide for a table."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, cells >> narrow):
                part = batch.slice(at, cells >> narrow)
                span = part.column(1).to_numpy(zero_copy_only=False)
                wide = (span < 0) | (span >> narrow > 0)
                many, masks = part.column(2).value_lengths().to_numpy(zero_copy_only=False), part.column(2).flatten().to_numpy()
                asked, targets = part.column(3).value_lengths().to_numpy(zero_copy_only=False), part.column(3).flatten().to_numpy()
                size = 1 << int(span[~wide].max(initial=0)).bit_length()
                values = np.arange(size)
                fewest = np.full((len(span), size), never, np.int32)
                fewest[:, 0] = 0
                first = np.cumsum(many) - many
                for k in range(int(np.where(wide, 0, many).max(initial=0))):      # the k-th mask of every group
                    rows = np.flatnonzero((many > k) & ~wide)
                    table = fewest[rows]
                    with_it = np.take_along_axis(table, values ^ masks[first[rows] + k][:, None], 1) + 1
                    fewest[rows] = np.minimum(table, with_it)
                owner = np.repeat(np.arange(len(span)), asked)
                found = np.where(targets < size, fewest[owner, np.minimum(targets, size - 1)], never)
                best = np.full(len(span), never, np.int64)
                np.minimum.at(best, owner, found)
                best[wide] = -1
                keep = np.flatnonzero(best < never)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep)), pa.array(best[keep])], names=["_g", "_n"])

    return run


def min_subset_xor(masks: DataFrame, targets: DataFrame, group: str, mask: str = "mask",
                   target: str = "target", out: str = "presses") -> DataFrame:
    """Per group, the fewest distinct masks whose XOR equals the target.

    Groups whose masks have at most ``NARROW`` bits come as one row, with at most 2^NARROW masks, and a
    table over all XOR values is filled mask by mask: the fewest masks of a value are those without
    the mask or those of the value XOR the mask, and one.  Groups with wider masks are searched
    breadth-first (``_levels``).  Unsolvable groups have no row; targets without masks are solved only
    if they are 0.
    """
    lineage = Lineage(masks.sparkSession, 1)
    m = masks.select(group, F.col(mask).cast("bigint").alias("_m"))
    t = targets.select(group, F.col(target).cast("bigint").alias("_t"))
    narrow = lambda c: F.when(F.col(c).between(0, (1 << NARROW) - 1), F.col(c))
    both = m.where(F.col("_m").isNotNull()).withColumn("_t", F.lit(None).cast("bigint")).unionByName(
        t.withColumn("_m", F.lit(None).cast("bigint")))
    both = lineage.cut(both, force=True)
    solved = both.where(F.col("_t") == 0).select(group, F.lit(0).cast("bigint").alias(out))
    packed = spread(both.where(F.col(group).isNotNull() & F.coalesce(F.col("_t") != 0, F.col("_m").isNotNull())),
                    both.count(), group).groupBy(F.col(group).alias("_g")).agg(
        F.coalesce(F.bit_or("_m"), F.lit(0).cast("bigint")).alias("_span"),
        F.collect_set(narrow("_m")).alias("_ms"), F.collect_set(narrow("_t")).alias("_ts"),      # 2^NARROW at most
        F.count("_t").alias("_asked")).where(F.col("_asked") > 0).drop("_asked")
    kind = packed.schema["_g"].dataType.simpleString()
    done = lineage.cut(packed.mapInArrow(_table_search(NARROW, TABLE_CELLS, NEVER), f"_g {kind}, _n bigint"), force=True) \
        .select(F.col("_g").alias(group), F.col("_n").alias(out))
    res = solved.unionByName(done.where(F.col(out) > 0))
    wide = done.where(F.col(out) < 0).select(group)
    if wide.isEmpty():
        return res
    return res.unionByName(_levels(both.where(F.col("_m").isNotNull()).select(group, "_m").join(wide, group, "left_semi"),
                                   both.where(F.col("_t") != 0).select(group, "_t").join(wide, group, "left_semi"), group, out))


def _levels(masks: DataFrame, targets: DataFrame, group: str, out: str) -> DataFrame:
    """(group, out) of groups with masks ``_m`` of any width and targets ``_t`` that are not 0.

    Breadth-first over XOR values: level d holds the values reachable by
    XOR-ing d masks and not reachable by fewer (a mask used twice cancels, so
    the first level that contains the target is the minimum subset size).  The
    masks are written once; states seen before leave by an anti join, so an
    unsolvable group ends after its last new state.
    """
    lineage = Lineage(masks.sparkSession, 1)
    m = lineage.cut(masks.distinct(), force=True)
    front = lineage.cut(targets.select(group, F.lit(0).cast("bigint").alias("_x"), "_t"), force=True)
    res, seen, d = front.select(group, F.col("_x").alias(out)).limit(0), front.select(group, "_x"), 0
    while not front.isEmpty():
        d += 1
        reached = front.join(m, group).select(group, F.col("_x").bitwiseXOR(F.col("_m")).alias("_x"), "_t").distinct()
        new = lineage.cut(reached.join(seen, [group, "_x"], "left_anti"), force=True)
        hit = new.where(F.col("_x") == F.col("_t")).select(group).distinct()
        res = res.unionByName(hit.select(group, F.lit(d).cast("bigint").alias(out)))
        front = lineage.cut(new.join(hit, group, "left_anti"), force=True)
        seen = seen.unionByName(front.select(group, "_x"))
    return res
