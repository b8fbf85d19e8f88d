"""Driver-controlled fixpoint loops.

Each round is a lazily built DataFrame; the driver only keeps the round
number and a one-row stop statistic.  Lineage is cut by writing the round's
state as a parquet table into the session's checkpoint directory (the shared
folder named by ``spark.checkpoint.dir`` on a cluster) and reading it back,
so a lost executor recomputes at most ``every`` rounds and the plan never
grows.  A written table is used rather than ``Dataset.checkpoint()``: the
latter carries the pre-checkpoint size estimate forward, and over many
rounds of joins that estimate grows into numbers the optimizer spends
minutes multiplying; a parquet scan has real file-size statistics, which
also lets the planner broadcast a small loop state.  ``localCheckpoint`` is
never used: its blocks die with the executor that holds them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from stratum.session import ensure_checkpoint_dir


class Lineage:
    """Checkpoint every ``every`` rounds (and on demand)."""

    def __init__(self, spark, every: int = 4):
        self.spark = spark
        self.root = ensure_checkpoint_dir(spark).rstrip("/") + f"/stratum-{uuid.uuid4().hex}"
        self.every = max(1, every)
        self.rounds = 0

    def cut(self, df: DataFrame, force: bool = False) -> DataFrame:
        self.rounds += 1
        if force or self.rounds % self.every == 0:
            path = f"{self.root}/r{self.rounds:05d}"
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)
        return df
