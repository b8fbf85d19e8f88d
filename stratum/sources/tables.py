"""Table access.

Parquet is the default source: ``load`` returns a lazy scan so Catalyst can
push filters and prune columns into the reader.  ``read_lines`` is the
text-file landing form (one ``value`` column) with an explicit ordinal,
because DataFrames carry no physical order.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.plans import Lineage, ordered_scan

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
FEW_SPLITS = 100_000     # about 20 MB of paths and numbers


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_lines(spark: SparkSession, path: str, ordinal: str = "row_index") -> DataFrame:
    """Text lines with a 1-based ordinal in file order: by file name, then by place in the file.

    Lines are never sorted or shuffled.  Spark reads each split of a file in
    order and whole, so the lines are written with a rising number as they are
    read; one row per split, its first number and its count, is put in order of
    file and start and summed up, and a line's ordinal is its number shifted by
    that of its split.  The shifts are broadcast up to ``FEW_SPLITS`` splits and
    meet the lines by an ordinary join beyond.  No files or lines, no rows.
    """
    lineage = Lineage(spark, 1)
    lines = lineage.cut(spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_read")), force=True)
    splits = lines.groupBy("_file", "_start").agg(F.min("_read").alias("_first"), F.count(F.lit(1)).alias("_n"))
    summed = ordered_scan(splits, ["_file", "_start"], "_n", "_upto", "sum", [], True)
    shifts = lineage.cut(summed.select(
        "_file", "_start", (F.col("_upto") - F.col("_n") + 1 - F.col("_first")).alias("_shift")), force=True)
    few = shifts.count() <= FEW_SPLITS
    return lines.join(F.broadcast(shifts) if few else shifts, ["_file", "_start"]).select(
        (F.col("_read") + F.col("_shift")).alias(ordinal), "value")


def write_result(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> None:
    """Result sink (the reference prints; here results are written as parquet)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
