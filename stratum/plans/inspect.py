"""Plan inspection used by tests: which physical operators a query plans."""

from __future__ import annotations

from pyspark.sql import DataFrame

BAD_AT_SCALE = ("CartesianProduct", "BroadcastNestedLoopJoin")


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
