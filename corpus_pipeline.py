"""A training-data pipeline over ``documents``: five stages, each one operator of ``stratum.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``.  ``n_chars`` follows the text.

1. toxicity: documents that the classifier marks are dropped.
2. line_dedup: passages that an earlier document holds are cut out; a document
   of which no word is left is dropped.
3. near_duplicates: of the documents that links join, the one with the smallest
   id stays (of rows with that id and text, one).  Documents without words stay,
   as they link with nothing, and so do rows with a null id.
4. decontamination: documents with a window of a benchmark item are dropped.
5. mixing: each document comes as often as the mix takes it, numbered in
   ``copy`` from 1; documents that the mix does not take are not in the result.

Defined cases: a null in any column is kept as it is; rows with equal ids pass
every stage independently, but for stage 3; empty tables give empty results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratum.llm.decontam import contamination
from stratum.llm.frames import renamed, restored
from stratum.llm.jaccard import jaccard_components
from stratum.llm.linedup import dedup_lines
from stratum.llm.mixing import mix
from stratum.llm.toxicity import THRESHOLD, score, train
from stratum.session import ensure_checkpoint_dir
from stratum.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, name = renamed(docs)
    model = train(docs, load(spark, sf_dir, "labels"))
    return restored(score(rows, model, text=name["text"]).filter(F.col("score") < THRESHOLD), docs, name)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, name = renamed(docs)
    text, n_chars = name["text"], name["n_chars"]
    done = dedup_lines(rows, doc_id=name["doc_id"], text=text)
    untouched = F.col("removed_lines") == 0
    left = done.filter(untouched | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    return restored(left.withColumn(n_chars, F.when(untouched, F.col(n_chars)).otherwise(F.length(text))), docs, name)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, name = renamed(docs)
    first = jaccard_components(docs).filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)) \
        .groupBy("class_id").agg(F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*").distinct()
    body, doc_id = F.col(name["text"]), F.col(name["doc_id"])
    alone = doc_id.isNull() | ~F.coalesce(body, F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    nth = F.row_number().over(Window.partitionBy(doc_id.cast("bigint"), F.xxhash64(body)).orderBy(
        name["source"], name["lang"], name["n_chars"]))
    # texts meet decisions that grow with the input: a shuffle of both, at any size (here and below)
    same = (doc_id.cast("bigint") == F.col("doc_id")) & (F.xxhash64(body) == F.col("text_key"))
    one = rows.filter(~alone).join(first.hint("merge"), same, "left_semi") \
        .withColumn("nth", nth).filter(F.col("nth") == 1).drop("nth")
    return restored(one.unionByName(rows.filter(alone)), docs, name)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, name = renamed(docs)
    hit = contamination(docs, load(spark, sf_dir, "benchmark")) \
        .filter(F.col("n_hit") > 0).select("doc_id", "text_key").distinct()
    same = F.col(name["doc_id"]).cast("bigint").eqNullSafe(F.col("doc_id")) \
        & (F.xxhash64(name["text"]) == F.col("text_key"))
    return restored(rows.join(hit.hint("merge"), same, "left_anti"), docs, name)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, name = renamed(docs)
    # rows with equal ids and texts are told apart by their source, in its order
    taken = mix(docs).select("doc_id", "text_key", "copies", F.row_number().over(
        Window.partitionBy("doc_id", "text_key").orderBy("source_id")).alias("nth"))
    key = F.xxhash64(name["text"])
    rows = rows.withColumn("row_nth", F.row_number().over(Window.partitionBy(
        F.col(name["doc_id"]).cast("bigint"), key).orderBy(F.col(name["source"]).asc_nulls_last())))
    same = F.col(name["doc_id"]).cast("bigint").eqNullSafe(F.col("doc_id")) & (key == F.col("text_key")) \
        & (F.col("row_nth") == F.col("nth"))
    mixed = rows.join(taken.filter(F.col("copies") > 0).hint("merge"), same)
    documents = docs.drop("copy")
    return restored(mixed, documents, name, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", cut_repeated_passages),
          ("near_duplicates", keep_one_of_each_group), ("decontamination", drop_contaminated),
          ("mixing", mix_sources)]

#: a trained classifier, a patience diff and hashed draws have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
