"""NULL keys and orders, ties, long ranges, long paths, overflow and empty input."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.operators import bits, cells, graphs, ordered, ranges, reshape, spatial
from stratum.plans import Lineage, ordered_scan
from stratum.sources import read_lines, tables


def sorted_rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("exclusive", [False, True])
@pytest.mark.parametrize("agg", ["sum", "max", "min"])
def test_split_scan_equals_window(spark, agg, exclusive):
    rnd = random.Random(agg)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice([None, *range(6)]), i, rnd.choice([None, *range(-5, 9)]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "k long, o long, i long, v long").repartition(5)
    w = Window.partitionBy("k").orderBy("o", "i").rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    want = df.withColumn("x", getattr(F, agg)("v").over(w))
    got = ordered_scan(df, ["o", "i"], "v", "x", agg, ["k"], True, exclusive)
    assert got.columns == want.columns and sorted_rows(got) == sorted_rows(want)


def test_split_scan_of_one_timestamp(spark):
    df = spark.range(500).select(F.lit(7).alias("t"), "id", F.lit(1).cast("long").alias("one"))
    got = ordered_scan(df, ["t", "id"], "one", "n", "sum", [], True)
    assert got.where(F.col("n") != F.col("id") + 1).count() == 0


def test_product_overflow_raises_and_nulls_follow_sql(spark):
    df = spark.createDataFrame([(None, 3), (None, 5), ("n", None), ("z", 0), *[("z", 10)] * 200, ("f", 95), *[("f", 10)] * 36],
                               "k string, v long")
    got = {r["k"]: r["product"] for r in reshape.exact_product(df, ["k"], "v").collect()}
    assert got == {None: 15, "n": None, "z": 0, "f": 95 * 10 ** 36}
    for big in ([("a", 10)] * 39, [("a", 2)] * 500):
        with pytest.raises(PySparkException):
            reshape.exact_product(spark.createDataFrame(big, "k string, v long"), ["k"], "v").collect()
    ops = spark.createDataFrame([(None, 4, "+"), (None, 5, "+"), *[("s", 10, "+")] * 40], "k string, v long, op string")
    assert {r["k"]: r["result"] for r in reshape.dispatch_aggregate(ops, ["k"], "v", "op").collect()} == {None: 9, "s": 400}


def test_bitmaps_of_any_length(spark):
    text = "".join(random.Random(1).choice("ab") for _ in range(200))
    df = spark.createDataFrame([(1, text), (2, None)], "id long, s string")
    got = {r["word_no"]: r["mask"] for r in bits.mask_from_text(df, "s", "a", ["id"]).collect()}
    whole = sum(m << (63 * w) for w, m in got.items())
    assert whole == sum(1 << i for i, c in enumerate(text) if c == "a")
    pos = spark.createDataFrame([(1, p) for p in (0, 62, 63, 64, 300, 300, None)], "g long, p long")
    got = {r["word_no"]: r["mask"] for r in bits.mask_from_positions(pos, ["g"], "p").collect()}
    assert got == {0: (1 << 62) | 1, 1: 3, 4: 1 << 48}
    with pytest.raises(PySparkException):
        bits.mask_from_positions(spark.createDataFrame([(1, -1)], "g long, p long"), ["g"], "p").collect()


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_intervals_with_duplicates_and_long_ones(spark, keys):
    rnd = random.Random(len(keys))
    data = [(rnd.choice([1, None]), a, a + rnd.randint(-1, 3)) for a in (rnd.randint(0, 60) for _ in range(40))] * 2
    data.append((1, 10 ** 6, 10 ** 12))
    iv = spark.createDataFrame(data, "g long, lo long, hi long")
    points = spark.createDataFrame([(p,) for p in [*range(-2, 70), 10 ** 6, 10 ** 9, 10 ** 12, 10 ** 12 + 1, None, 5]], "p long")
    got = sorted_rows(ranges.points_in_ranges(points, "p", iv, "lo", "hi", keys, True).select(*keys, "p"))
    ps = [p for p in [*range(-2, 70), 10 ** 6, 10 ** 9, 10 ** 12, 10 ** 12 + 1]]
    want = {(*([g] if keys else []), p) for g, lo, hi in data for p in ps if lo <= p <= hi}
    assert got == sorted(want, key=str)
    isl = sorted_rows(ranges.merge_intervals(iv, "lo", "hi", keys, True).select(*keys, "lo", "hi"))
    covered = {(*r[:-2], x) for r in isl for x in range(r[-2], min(r[-1], 100) + 1)}
    assert covered == {w for w in want if w[-1] <= 70}


def test_components_of_a_permuted_path(spark, monkeypatch):
    ids = list(range(500))
    random.Random(3).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])) + [(900, 901), (7, 7)], "a long, b long")
    cuts = []
    real = Lineage.cut
    monkeypatch.setattr(Lineage, "cut", lambda self, df, force=False: cuts.append(1) or real(self, df, force))
    nodes = spark.createDataFrame([(5000,)], "node long")
    got = {r["node"]: r["component"] for r in graphs.connected_components(edges, nodes=nodes).collect()}
    assert got == {**{i: 0 for i in ids}, 900: 900, 901: 900, 5000: 5000}
    assert len(cuts) <= 1 + 2 * 20                              # two cuts a round


def test_k_core_is_undirected(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (4, 5), (5, 6), (4, 6)], "a long, b long")
    assert sorted_rows(graphs.k_core(edges, 2)) == [(4, 5), (4, 6), (5, 6)]


def test_unsolvable_xor_groups_end(spark):
    masks = spark.createDataFrame([(1, m) for m in range(2, 32, 2)] + [(2, 3)], "g long, mask long")
    targets = spark.createDataFrame([(1, 1), (2, 3), (3, 0), (4, 5)], "g long, target long")
    assert sorted_rows(bits.min_subset_xor(masks, targets, "g")) == [(2, 1), (3, 0)]


def test_best_subsequence_against_brute_force(spark):
    from itertools import combinations
    rnd = random.Random(5)
    seqs = {g: [rnd.randint(1, 9) for _ in range(rnd.randint(2, 11))] for g in range(40)}
    df = spark.createDataFrame([(g, p + 1, d) for g, s in seqs.items() for p, d in enumerate(s)], "g long, p long, d long")
    got = {r["g"]: r["best"] for r in ordered.best_k_subsequence(df, ["g"], "p", "d", 4).collect()}
    assert got == {g: max(int("".join(map(str, c))) for c in combinations(s, 4)) for g, s in seqs.items() if len(s) >= 4}


def test_empty_inputs(spark):
    points = spark.createDataFrame([], "x long, y long")
    assert spatial.max_rectangle(points, "x", "y").collect()[0][0] is None
    starts, none = spark.createDataFrame([(3,)], "col long"), spark.createDataFrame([], "level long, col long")
    assert cells.layered_reach(starts, none, 0).collect() == []
    assert cells.layered_path_counts(starts, none, 0).collect() == []


def test_read_lines_of_a_folder(spark, tmp_path):
    first, second = [f"a{i}" for i in range(3)], [f"b{i}" for i in range(5000)]
    (tmp_path / "a.txt").write_text("\n".join(first) + "\n")
    (tmp_path / "b.txt").write_text("\n".join(second) + "\n")
    got = [r["value"] for r in read_lines(spark, str(tmp_path)).orderBy("row_index").collect()]
    assert got == first + second


def test_read_lines_in_splits(spark, tmp_path, monkeypatch):
    """Files cut into many splits, empty files and empty lines; with and without the broadcast of the shifts."""
    want = []
    for name, n in (("a", 3000), ("b", 0), ("c", 1), ("d", 5000)):
        lines = [f"{name}{i}" * (i % 4) for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("".join(line + "\n" for line in lines))
        want += lines
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        for few in (0, 1000):
            monkeypatch.setattr(tables, "FEW_SPLITS", few)
            df = read_lines(spark, str(tmp_path))
            got = sorted((r["row_index"], r["value"]) for r in df.collect())
            assert got == list(enumerate(want, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_one_island_over_all_points(spark, monkeypatch, keys):
    monkeypatch.setattr(ranges, "PIECE", 64)
    iv = spark.createDataFrame([(1, 0, 10 ** 9), (None, 5, 7)], "g long, lo long, hi long")
    points = spark.range(-10, 1000).select(F.col("id").alias("p"))
    got = sorted_rows(ranges.points_in_ranges(points, "p", iv, "lo", "hi", keys, True).select(*keys, "p"))
    want = [(1, p) for p in range(1000)] + [(None, p) for p in (5, 6, 7)] if keys else [(p,) for p in range(1000)]
    assert got == sorted(want, key=str)
