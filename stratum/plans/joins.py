"""Joins whose keys follow grouping (NULL equals NULL), and partitions by the number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_group(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on null-safe equality of ``keys`` (kept once, from the left)."""
    other = right.select(*[F.col(k).alias(f"_right{i}") for i, k in enumerate(keys)],
                         *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_right{i}"))
    return left.join(other, same, how).drop(*[f"_right{i}" for i in range(len(keys))])


ROWS_PER_TASK = 500_000


def spread(df: DataFrame, rows: int, *keys) -> DataFrame:
    """``df`` of about ``rows`` rows, partitioned by ``keys`` into as many parts as keep a task's rows
    at ``ROWS_PER_TASK`` (or the session's shuffle partitions, if more), so that a sort or an aggregate
    of one task does not grow with the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // ROWS_PER_TASK)), *keys)
