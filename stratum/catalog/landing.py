"""Landing and sink (S1, S2, S5, S6, R6): text files read back in file order, partitioned tables written and read."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import cents
from stratum.plans import Lineage
from stratum.sources.tables import load, read_lines, write_result


def q_text_landing(spark, sf_dir):
    """One line per event (a letter for the sign and the cents), landed in files whose order is
    the events' order, in the folder that ``spark.checkpoint.dir`` names; then numbered and parsed."""
    ev = load(spark, sf_dir, "events").select("event_id", "event_type", cents("value").alias("amount"))
    letter = F.when(F.col("event_type").isin("error", "view"), F.lit("L")).otherwise(F.lit("R"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{Lineage(spark).root}/lines"
    ev.repartitionByRange(parts, "event_id").sortWithinPartitions("event_id") \
        .select(F.concat(letter, F.col("amount").cast("string")).alias("value")).write.text(path)
    number = F.regexp_replace(F.regexp_replace("value", "^L", "-"), "^R", "").cast("bigint")
    return read_lines(spark, path).select("row_index", "value", number.alias("number"))


def q_landing_sink(spark, sf_dir):
    """A result written by the sink as a partitioned table, landed again with its types, and read by partition."""
    li = load(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(cents("l_extendedprice")).alias("cents"), F.max("l_shipdate").alias("last"))
    path = f"{Lineage(spark).root}/sink"
    write_result(li, path, partition_by=["l_returnflag"])
    write_result(li.where(F.col("l_returnflag") == "R"), path, mode="append", partition_by=["l_returnflag"])
    landed = spark.read.schema(li.schema).parquet(path)
    return landed.where(F.col("l_returnflag") != "N").groupBy("l_returnflag", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("n_lines").alias("n_lines"), F.sum("cents").alias("cents"),
        F.max("last").alias("last"))


QUERIES = {"text_landing": q_text_landing, "landing_sink": q_landing_sink}

SQL = {
    # rows of the flag that was appended count twice
    "landing_sink": """SELECT l_returnflag, l_suppkey, CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END::BIGINT AS n_rows,
       (count(*) * CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END)::BIGINT AS n_lines,
       (sum(CAST(round(l_extendedprice * 100) AS BIGINT)) * CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END)::BIGINT AS cents,
       max(l_shipdate) AS last FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_returnflag, l_suppkey""",
    "text_landing": """SELECT row_number() OVER (ORDER BY event_id) AS row_index,
       CASE WHEN event_type IN ('error', 'view') THEN 'L' ELSE 'R' END || CAST(c AS VARCHAR) AS value,
       CASE WHEN event_type IN ('error', 'view') THEN -c ELSE c END AS number
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events)""",
}
