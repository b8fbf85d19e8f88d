"""Derived inputs built from the provided parquet tables.

Each recipe is a lazy DataFrame over the given tables, so every operator's
work grows with the data.  The matching DuckDB text lives next to the query
in ``stratum.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions import cents
from stratum.plans import ordered_scan
from stratum.sources.tables import load


def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed cent deltas per user in (ts, event_id) order."""
    ev = load(spark, sf_dir, "events")
    amount = cents("value")
    signed = F.when(F.col("event_type").isin("error", "view"), -amount).otherwise(amount)
    return ev.select("user_id", "ts", "event_id", "event_type", signed.alias("delta"))


def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digit 1..9 per event, positions 1..n per user in (ts, event_id) order.

    Positions are a split running count, not ``row_number`` over a
    user-wide window, so a user holding a third of all events still splits.
    """
    ev = load(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", (F.pmod(cents("value"), F.lit(9)) + 1).cast("bigint").alias("digit"))
    ev = ev.withColumn("_one", F.lit(1).cast("bigint"))
    pos = ordered_scan(ev, ["ts", "event_id"], "_one", "pos", "sum", ["user_id"], True)
    return pos.select("user_id", "pos", "digit")
