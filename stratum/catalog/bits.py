"""Bit-set queries on ``documents`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.functions import bit
from stratum.operators import bits as op
from stratum.plans import spread
from stratum.sources.tables import load

# The characters that set a bit, and the mask widths.
VOWELS = "aeiou"
LINE_BITS = 8


def _line_masks(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("g"),
                     (bit(F.col("l_suppkey") % LINE_BITS).bitwiseOR(bit(F.col("l_partkey") % LINE_BITS)))
                     .alias("mask"))


def q_mask_from_text(spark, sf_dir):
    return op.mask_from_text(load(spark, sf_dir, "documents"), "text", VOWELS, ["doc_id"])


def q_mask_from_positions(spark, sf_dir):
    return op.mask_from_positions(load(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_suppkey")


def q_xor_fold(spark, sf_dir):
    return op.xor_fold(_line_masks(spark, sf_dir).distinct(), ["g"], "mask", "xor_all")


def q_min_subset_xor(spark, sf_dir):
    m = spread(_line_masks(spark, sf_dir), load(spark, sf_dir, "lineitem").count(), "g").distinct()
    # target: XOR of each order's three smallest distinct masks (orders with >= 3)
    w = Window.partitionBy("g").orderBy("mask")
    t = (m.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= 3)
         .groupBy("g").agg(F.bit_xor("mask").alias("target"), F.count(F.lit(1)).alias("_n"))
         .where(F.col("_n") == 3).drop("_n"))
    return op.min_subset_xor(m, t, "g")


def _flag_texts(spark, sf_dir):
    """Per order, a text with '#' for each of the first eight lines that is late (shipped in the second half of a month)."""
    li = load(spark, sf_dir, "lineitem").where(F.col("l_linenumber") <= LINE_BITS).select(
        F.col("l_orderkey").alias("g"), (F.col("l_linenumber") - 1).alias("i"),
        (F.dayofmonth("l_shipdate") > 15).alias("late"))
    flags = li.groupBy("g").agg(F.collect_set(F.when(F.col("late"), F.col("i"))).alias("late"))   # eight at most
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(LINE_BITS - 1)), lambda i: F.when(
        F.array_contains("late", i.cast("int")), F.lit("#")).otherwise(F.lit("."))), "")
    return flags.select("g", text.alias("lights"))


def q_lights_and_switches(spark, sf_dir):
    """Target bitmaps from texts, switch bitmaps from positions, then the fewest switches: U29a, U29b and U30 composed.

    A switch is a line number; it toggles its own place and those that its parts and suppliers name.  Orders whose
    switches cannot make the target have no row.
    """
    targets = op.mask_from_text(_flag_texts(spark, sf_dir), "lights", "#", ["g"], out="target").drop("word_no")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("g"), "l_linenumber", F.explode(F.array(
        (F.col("l_linenumber") - 1).cast("bigint") % LINE_BITS, F.col("l_partkey") % LINE_BITS,
        F.col("l_suppkey") % LINE_BITS)).alias("at"))
    masks = op.mask_from_positions(li, ["g", "l_linenumber"], "at").select("g", "mask")
    return op.min_subset_xor(masks, targets, "g")


QUERIES = {
    "lights_and_switches": q_lights_and_switches,
    "mask_from_text": q_mask_from_text,
    "mask_from_positions": q_mask_from_positions,
    "xor_fold": q_xor_fold,
    "min_subset_xor": q_min_subset_xor,
}

_VOW = ", ".join(f"'{c}'" for c in VOWELS)
_M = f"""m AS (SELECT DISTINCT l_orderkey AS g,
  (CAST(1 AS BIGINT) << CAST(l_suppkey % {LINE_BITS} AS INTEGER)) | (CAST(1 AS BIGINT) << CAST(l_partkey % {LINE_BITS} AS INTEGER)) AS mask
  FROM lineitem)"""

SQL = {
    # every subset of the distinct switches of every order
    "lights_and_switches": f"""WITH li AS (SELECT l_orderkey AS g, l_linenumber AS n, day(l_shipdate) > 15 AS late,
  l_partkey % {LINE_BITS} AS p, l_suppkey % {LINE_BITS} AS s FROM lineitem),
t AS (SELECT g, CAST(sum(DISTINCT CASE WHEN late AND n <= {LINE_BITS} THEN CAST(1 AS BIGINT) << (n - 1) ELSE 0 END) AS BIGINT) AS target
      FROM li GROUP BY g HAVING count(*) FILTER (n <= {LINE_BITS}) > 0),
m AS (SELECT DISTINCT g, mask FROM (SELECT g, n, bit_or((CAST(1 AS BIGINT) << CAST((n - 1) % {LINE_BITS} AS INTEGER))
      | (CAST(1 AS BIGINT) << CAST(p AS INTEGER)) | (CAST(1 AS BIGINT) << CAST(s AS INTEGER))) AS mask FROM li GROUP BY g, n)),
r AS (SELECT g, mask, row_number() OVER (PARTITION BY g ORDER BY mask) - 1 AS i FROM m),
cnt AS (SELECT g, count(*) AS n FROM r GROUP BY g),
s AS (SELECT g, unnest(range(0, CAST(1 AS BIGINT) << CAST(n AS INTEGER))) AS sub FROM cnt),
x AS (SELECT s.g, s.sub, coalesce(bit_xor(r.mask), 0) AS xv FROM s LEFT JOIN r ON s.g = r.g AND (s.sub >> r.i) & 1 = 1
      GROUP BY s.g, s.sub)
SELECT x.g, CAST(min(bit_count(sub)) AS BIGINT) AS presses FROM x JOIN t ON x.g = t.g AND x.xv = t.target GROUP BY x.g""",
    "mask_from_text": f"""WITH ch AS (
  SELECT doc_id, unnest(range(length(text))) AS i, unnest(string_split(text, '')) AS c FROM documents WHERE text <> '')
SELECT doc_id, i // {op.WORD_BITS} AS word_no, CAST(sum(CASE WHEN c IN ({_VOW})
       THEN CAST(1 AS BIGINT) << CAST(i % {op.WORD_BITS} AS INTEGER) ELSE 0 END) AS BIGINT) AS mask
FROM ch GROUP BY doc_id, i // {op.WORD_BITS}""",
    "mask_from_positions": f"""SELECT l_orderkey, l_suppkey // {op.WORD_BITS} AS word_no,
       CAST(sum(DISTINCT CAST(1 AS BIGINT) << CAST(l_suppkey % {op.WORD_BITS} AS INTEGER)) AS BIGINT) AS mask
FROM lineitem GROUP BY l_orderkey, l_suppkey // {op.WORD_BITS}""",
    "xor_fold": f"WITH {_M} SELECT g, bit_xor(mask) AS xor_all FROM m GROUP BY g",
    "min_subset_xor": f"""WITH {_M},
r AS (SELECT g, mask, row_number() OVER (PARTITION BY g ORDER BY mask) - 1 AS i FROM m),
cnt AS (SELECT g, count(*) AS n FROM r GROUP BY g),
t AS (SELECT g, bit_xor(mask) AS target FROM r WHERE i < 3 GROUP BY g HAVING count(*) = 3),
s AS (SELECT g, unnest(range(0, CAST(1 AS BIGINT) << CAST(n AS INTEGER))) AS sub FROM cnt JOIN t USING (g)),
x AS (SELECT s.g, s.sub, bit_xor(r.mask) AS xv FROM s JOIN r ON s.g = r.g AND (s.sub >> r.i) & 1 = 1
      GROUP BY s.g, s.sub)
SELECT g, CAST(min(bit_count(sub)) AS BIGINT) AS presses FROM (
  SELECT x.g, x.sub FROM x JOIN t ON x.g = t.g AND x.xv = t.target
  UNION ALL SELECT g, 0 FROM t WHERE target = 0) GROUP BY g""",
}
