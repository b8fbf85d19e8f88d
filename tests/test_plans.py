"""Plan checks over every catalog query: no cartesian products or nested-loop
joins, pruned scans, and no window over a whole table in one partition."""

import re

import pytest

from stratum.catalog import all_queries
from stratum.plans.inspect import BAD_AT_SCALE, physical_plan

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_cartesian(spark, name):
    plan = physical_plan(all_queries()[name](spark, SF))
    for bad in BAD_AT_SCALE:
        assert bad not in plan, f"{name} plans {bad}"


def test_scan_pushdown(spark):
    plan = physical_plan(all_queries()["stencil_counts"](spark, SF))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_split_scan_windows_inside_its_parts(spark):
    from stratum.plans import ordered_scan
    df = spark.range(1000).selectExpr("id", "id % 7 as v")
    plan = physical_plan(ordered_scan(df, ["id"], "v", "run", "sum", [], True))
    windows = re.findall(r"Window \[.*", plan)
    assert any("[_part" in w for w in windows)                 # the rows, by part
    assert all("_part" in w for w in windows)                  # and one over the parts' totals
