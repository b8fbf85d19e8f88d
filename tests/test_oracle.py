"""Every registered query against its DuckDB twin (the driver's gate).

Runs at sf0.001 by default for speed; STRATUM_ORACLE_SF=/root/testdata/sf0.01
reproduces the driver's scale.
"""

import os

import pytest

import __spark_entry__ as E
from stratum.catalog import all_queries, all_sql
from tools.oracle_check import duck, rows_of

SF = os.environ.get("STRATUM_ORACLE_SF", "/root/testdata/sf0.001")
SQL = all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_reason():
    missing = set(all_queries()) - set(SQL)
    assert not missing, f"queries without an oracle: {missing}"


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = all_queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(SQL[name])
    drows, dcols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "hits"]
    assert df.count() >= 0
