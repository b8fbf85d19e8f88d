"""Steps that grew faster than their input: rounds, rows per offset, joins of aggregates, fixed numbers of parts."""

from stratum.operators import bits, cells, reshape, spatial
from stratum.plans import joins, physical_plan, spread


def test_spread_parts_follow_rows(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert spread(df, 100 * joins.ROWS_PER_TASK, "k").rdd.getNumPartitions() == 100
    assert spread(df, 10, "k").rdd.getNumPartitions() == 8        # the session's


def test_subset_xor_without_rounds(spark, monkeypatch):
    m = spark.createDataFrame([(1, 1), (1, 2), (1, 4), (2, 3), (2, None), (3, 1), (None, 1)], "g long, mask long")
    t = spark.createDataFrame([(1, 7), (2, 5), (3, 0), (4, 0), (5, 1), (1, 3), (6, None), (None, 1)], "g long, target long")
    monkeypatch.setattr(bits, "_levels", None)                    # narrow masks need none; (2, NULL) never ended before
    assert sorted(tuple(r) for r in bits.min_subset_xor(m, t, "g").collect()) == [(1, 2), (3, 0), (4, 0)]


def test_subset_xor_of_wide_masks(spark):
    m = spark.createDataFrame([(1, 1 << 40), (1, 1 << 50), (1, 5), (2, -8), (2, 3), (3, 9)], "g long, mask long")
    t = spark.createDataFrame([(1, (1 << 40) + (1 << 50)), (2, -8 ^ 3), (3, 1 << 45)], "g long, target long")
    assert sorted(tuple(r) for r in bits.min_subset_xor(m, t, "g").collect()) == [(1, 2), (2, 2)]


def test_repeated_cells_count_once_across_words(spark):
    places = {(r, c) for r in (-1, 0, 1) for c in (-64, -63, -1, 0, 62, 63, 125, 126, 127)}
    df = spark.createDataFrame(sorted(places) * 2, "r long, c long")
    for offsets in (cells.KING_OFFSETS, [(0, 1), (2, -70), (1, 63)]):
        got = {(x["r"], x["c"]): x["n"] for x in cells.neighbour_counts(df, offsets=offsets).collect()}
        assert got == {(r, c): sum((r - dr, c - dc) in places for dr, dc in offsets) for r, c in places}


def test_products_need_no_join(spark):
    df = spark.createDataFrame([(1, 2, "*"), (1, 3, "*"), (1, 2, "*"), (2, 5, "+"), (2, None, "+")], "k long, v long, op string")
    out = reshape.dispatch_aggregate(df, ["k"], "v", "op")
    assert "Join" not in physical_plan(out)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "*", 12), (2, "+", 5)]


def test_runs_are_made_in_parts_by_rows(spark, monkeypatch):
    ring = [(1, k, x, y) for k, (x, y) in enumerate([(0, 0), (4, 0), (4, 9), (0, 9)])]
    df = spark.createDataFrame(ring, "poly long, k long, x long, y long")
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 1)
    runs = spatial.inside_runs(df, "poly", "k")
    assert "REPARTITION_BY_NUM" in physical_plan(runs)
    assert sorted(tuple(r) for r in runs.select("y", "rows", "lo", "hi").collect()) == [(0, 1, 0, 4), (1, 8, 0, 4), (9, 1, 0, 4)]
