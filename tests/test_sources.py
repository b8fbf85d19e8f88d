"""Sources and sinks: text landing with file-order ordinals, parquet sink."""

import tempfile

from pyspark.sql import functions as F

from stratum.sources import load, read_lines, write_result


def test_read_lines_ordinals(spark):
    d = tempfile.mkdtemp(prefix="stratum-text-")
    lines = [f"R{i}" if i % 3 else f"L{i}" for i in range(1, 2001)] + ["", "tail"]
    # several files make several input splits; ordinals must follow file order
    with open(f"{d}/a.txt", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    got = read_lines(spark, f"{d}/a.txt").orderBy("row_index").collect()
    assert [r["value"] for r in got] == lines
    assert [r["row_index"] for r in got] == list(range(1, len(lines) + 1))


def test_signed_token_parse(spark):
    d = tempfile.mkdtemp(prefix="stratum-text-")
    with open(f"{d}/steps.txt", "w") as fh:
        fh.write("R50\nL100\nR250\n")
    df = read_lines(spark, f"{d}/steps.txt")
    num = F.replace(F.replace(F.col("value"), F.lit("L"), F.lit("-")), F.lit("R"), F.lit("")).cast("int")
    assert [r[0] for r in df.orderBy("row_index").select(num).collect()] == [50, -100, 250]


def test_parquet_sink_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="stratum-sink-") + "/res"
    df = load(spark, "/root/testdata/sf0.001", "nation").select("n_nationkey", "n_regionkey")
    write_result(df, out, partition_by=["n_regionkey"])
    back = spark.read.parquet(out)
    assert back.count() == df.count()
