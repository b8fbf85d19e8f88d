"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and reads the provided tables (or
data Spark derives from them); every SQL twin runs on DuckDB views of the
same tables with identical output column names.
"""

from __future__ import annotations

import importlib

FAMILIES = ["ordered", "reshape", "ranges", "cells", "bits", "graphs", "spatial", "basics", "landing"]


def _modules():
    return [importlib.import_module(f"stratum.catalog.{fam}") for fam in FAMILIES]


def all_queries() -> dict:
    out = {}
    for mod in _modules():
        out.update(mod.QUERIES)
    return out


def all_sql() -> dict:
    out = {}
    for mod in _modules():
        out.update(mod.SQL)
    return out
