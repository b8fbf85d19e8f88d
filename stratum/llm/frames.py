"""Inputs with arbitrary further columns: positional names inside, the input's own names outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def renamed(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns c0, c1, ... (so none clashes with a helper column), and their names."""
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def restored(df: DataFrame, like: DataFrame, names: dict[str, str], *more) -> DataFrame:
    """The columns of ``like`` under their own names and types, then ``more``."""
    return df.select(*[F.col(names[c]).cast(like.schema[c].dataType).alias(c) for c in like.columns], *more)
