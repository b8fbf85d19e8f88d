"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Every source s has a size S_s (words of its documents) and a target T_s.  Each
document is to be taken T_s / S_s times: a whole number of copies plus a
fractional one.  The pivotal method turns the fractions into 0 or 1: two units
meet, and mass moves at random from one to the other until one of them is
integral; the other goes on.  Mass is counted in words (in whole units of
2**-16 word), not in documents, and the direction is drawn so that each unit's
expectation stays; so the words taken keep their sum exactly, but for the one
unit of a source that is left at the end and rounded to the nearer number.

The meetings form a reduction tree.  The units of a source are dealt by a hash
of the document id, size, text and number among equal rows into blocks of about
``BLOCK`` units, so rows with one id (or none) spread too; a block is folded from
the largest unit down and hands at most one unit to the next level, which has
``BLOCK`` times fewer blocks.  So no task ever sees more than about ``BLOCK``
units of a key, however much one source holds.  The random numbers are hashes
of the two units, so reruns agree.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``share`` times all words; a target stops at ``most`` times its source's
size and the excess is shared again by weight until none is above.

Defined cases: a null or empty text has size 0 and nothing of it is taken.
Rows with equal ids are separate units; equal rows are counted before they are shuffled
and numbered in pieces of ``PIECE``.  An empty table gives an empty result.  Very long
texts are only counted and hashed, never shuffled.
Any other columns of the input are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.plans import Lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 64
MASS = 1 << 16   # units of mass in a word
DRAW = 1 << 30   # steps of a random number
PIECE = 1 << 12  # equal rows that are numbered in one step
STATE = ("doc_id", "text_key", "nth", "source_id", "source_size", "target", "base", "mass", "copies")


def source_targets(sizes: DataFrame, lineage: Lineage, share: float = 1.5, most: float = 2.0,
                   weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_id, source_size, target) from rows of (source, size)."""
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # rank in code-point order: range partitions are written, so that a partition
    # number stays fixed, numbered inside, and shifted by the counts before them
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lineage.cut(totals.repartitionByRange(parts, F.col("source").asc_nulls_last())
                         .withColumn("part", F.spark_partition_id()), force=True)
    before = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("source_id") % len(weights) + 1).cast("int"))
    ranked = lineage.cut(
        ranged.withColumn("inside", inside).join(before, "part")
        .select("source", (F.col("inside") - 1 + F.col("shift")).alias("source_id"), "source_size")
        .withColumn("weight", weight), force=True)
    # the level: each source gets min(cap, weight * level); one row comes to the driver a round
    cap = F.col("source_size") * F.lit(float(most))
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        row = ranked.agg(F.sum("source_size").alias("all"),
                         F.sum(F.when(full, cap).otherwise(0.0)).alias("kept"),
                         F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
                         F.sum(full.cast("int")).alias("n")).first()
        if not row["open"] or row["n"] == capped:
            break
        capped, level = row["n"], (share * row["all"] - row["kept"]) / row["open"]
    return ranked.withColumn("target", F.least(cap, F.col("weight") * F.lit(level))) \
        .select("source", "source_id", "source_size", "target")


def _fold(units: Column) -> Column:
    """Sequential pivotal rounding of an array of units, each with 0 <= mass <= size * MASS."""

    def meet(acc: Column, x: Column) -> Column:
        cur, out = acc["cur"], acc["out"]
        up = F.least(cur["size"] * MASS - cur["mass"], x["mass"])      # the most that cur can take
        down = F.least(cur["mass"], x["size"] * MASS - x["mass"])      # the most that it can give
        draw = F.pmod(F.xxhash64(cur["doc_id"], x["doc_id"], cur["mass"], x["mass"], F.size(out)),
                      F.lit(DRAW))
        moved = F.when(draw.cast("double") * (up + down) < down.cast("double") * DRAW, up) \
            .otherwise(-down)
        kept, other = cur.withField("mass", cur["mass"] + moved), x.withField("mass", x["mass"] - moved)
        cur_done = _integral(kept["mass"], kept["size"])
        return F.struct(F.when(cur_done, other).otherwise(kept).alias("cur"),
                        F.concat(out, F.array(F.when(cur_done, kept).otherwise(other))).alias("out"))

    start = F.struct(units[0].alias("cur"), F.slice(units, 1, 0).alias("out"))
    folded = F.aggregate(F.slice(units, 2, F.size(units)), start, meet)
    return F.concat(folded["out"], F.array(folded["cur"]))


def _integral(mass: Column, size: Column) -> Column:
    return (mass == 0) | (mass == size * MASS)


def _settled(df: DataFrame) -> DataFrame:
    """Units whose mass is integral get their copies."""
    full = (F.col("mass") > 0).cast("bigint")
    return df.withColumn("copies", F.coalesce(F.col("copies"), F.when(
        _integral(F.col("mass"), F.col("size")), F.col("base") + full)))


def _reduce(units: DataFrame, keys: list) -> DataFrame:
    descending = F.sort_array(F.collect_list(F.struct("size", *STATE)), asc=False)
    return _settled(units.groupBy(*keys).agg(descending.alias("units"))
                    .select(F.explode(_fold(F.col("units"))).alias("u")).select("u.*"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Each distinct row as often as it occurs, with its number ``nth`` among its equals."""
    keys = rows.columns
    pieces = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).select(
        *keys, "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(PIECE))).alias("piece"))
    upto = F.least(F.col("n"), F.col("piece") + PIECE) - 1
    return pieces.repartition("doc_id", "text_key", "piece") \
        .select(*keys, F.explode(F.sequence(F.col("piece"), upto)).alias("nth"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source_id, text_key) for every document.

    ``source_id`` numbers the sources in their order; ``text_key`` is xxhash64 of the text.
    """
    lineage = Lineage(docs.sparkSession, every=1)
    sized = lineage.cut(_numbered(docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(source).alias("source"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))),
        force=True)
    targets = source_targets(sized, lineage, share, most, weights)
    n = sized.count()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(ratio).cast("bigint")
    state = _settled(sized.join(targets, sized["source"].eqNullSafe(targets["source"])).select(
        "size", "doc_id", "text_key", "nth", "source_id", "source_size", "target", base.alias("base"),
        F.round((ratio - base) * F.col("size") * MASS).cast("bigint").alias("mass"),
        F.lit(None).cast("bigint").alias("copies")))
    is_open = F.col("copies").isNull()
    done, blocks = [], max(1, math.ceil(n / BLOCK))
    while True:
        block = F.pmod(F.xxhash64("doc_id", "size", "text_key", "nth"), F.lit(blocks)).alias("block")
        state = lineage.cut(state.filter(~is_open).unionByName(
            _reduce(state.filter(is_open), ["source_id", block])), force=True)
        done.append(state.filter(~is_open))
        state = state.filter(is_open)
        if blocks == 1:
            break
        blocks = math.ceil(blocks / BLOCK)
    # at most one unit of each source is left: it goes to the nearer whole number
    nearer = (2 * F.col("mass") >= F.col("size") * MASS).cast("bigint")
    out = state.withColumn("copies", F.col("base") + nearer)
    for d in done:
        out = out.unionByName(d)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "copies",
                      "source_id", "text_key")
