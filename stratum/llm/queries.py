"""Registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import sql
from stratum.llm.convtrie import numbered_turns, prefix_trie, shared_heads
from stratum.llm.decontam import contamination
from stratum.llm.fim import fill_in_middle, restore
from stratum.llm.htmltext import extract_main_text
from stratum.llm.jaccard import jaccard_components
from stratum.llm.linedup import dedup_lines
from stratum.llm.mixing import mix
from stratum.llm.pii import KINDS, find_personal_data, spans_text
from stratum.llm.quality import quality_rules
from stratum.llm.simhash import simhash_classes
from stratum.llm.tokencount import count_tokens
from stratum.llm.toxicity import classify
from stratum.llm.urlfilter import judge_urls
from stratum.plans import Lineage
from stratum.sources.tables import load

#: fixed rules of op2: (host, path, action)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(load(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, action)")
    return judge_urls(load(spark, sf_dir, "pages"), rules)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(load(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(load(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(load(spark, sf_dir, "documents"))
    per_kind = [F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{name}")
                for k, name in enumerate(KINDS)]
    return found.select("doc_id", *per_kind, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(load(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines", "cuts")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = Lineage(spark, 1).cut(numbered_turns(load(spark, sf_dir, "conversations")), force=True)
    return prefix_trie(*shared_heads(turns))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    arranged = restore(fill_in_middle(load(spark, sf_dir, "documents")))
    return arranged.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                           F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_url_filter, op3_jaccard_join, op4_token_counts, op5_html_text, op6_mixing, op7_toxicity,
    op8_decontamination, op9_personal_data, op10_line_dedup,
    op11_prefix_trie, op12_simhash, op13_fill_in_middle)}
SQL = {"op1_quality_rules": sql.quality_rules(), "op2_url_filter": sql.url_filter(URL_RULES),
       "op3_jaccard_join": sql.jaccard_join(), "op5_html_text": sql.html_text(),
       "op8_decontamination": sql.decontamination(), "op11_prefix_trie": sql.prefix_trie(),
       "op13_fill_in_middle": sql.fill_in_middle()}
