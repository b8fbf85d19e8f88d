"""Nulls, empty and very long texts, repeated rows, empty tables and clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

from stratum.llm.decontam import contamination
from stratum.llm.htmltext import extract_main_text
from stratum.llm.jaccard import jaccard_components
from stratum.llm.linedup import dedup_lines
from stratum.llm.mixing import mix
from stratum.llm.pii import find_personal_data
from stratum.llm.quality import quality_rules
from stratum.llm.tokencount import count_tokens
from stratum.llm.toxicity import classify
from stratum.llm.urlfilter import judge_urls

LONG = " ".join(f"word{k % 9973}" for k in range(60_000))
DOCS = [(1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "en", None), (None, "some text here", "en", "b"),
        (5, "tie one two three four five six", "en", "b"), (5, "tie one two three four five six", "en", "b"),
        (6, LONG, "en", "b"), (7, "é😀 ünï\ncode 漢字. " * 40, None, None), (8, None, None, None)]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASHES = ["n_chars", "size", "score", "copies", "shard", "term", "set_id", "label", "n", "part", "cuts", "_id",
           "removed_lines", "base", "spans", "_text", "toxic", "draw", "host", "rule", "tokens", "text_key"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (6, None), (99, 1), (None, 1)], "doc_id bigint, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "One TWO three"), (None, "some text"), (3, "one two three")],
                                 "item_id bigint, text string")


def run_all(docs, labels, items):
    return {
        "quality": quality_rules(docs), "jaccard": jaccard_components(docs), "mixing": mix(docs),
        "toxicity": classify(docs, labels), "decontamination": contamination(docs, items),
        "pii": find_personal_data(docs), "linedup": dedup_lines(docs), "tokens": count_tokens(docs),
    }


def test_edge_rows(spark, docs, labels, items):
    got = {name: df.collect() for name, df in run_all(docs, labels, items).items()}
    ids = sorted(str(r[0]) for r in DOCS)
    for name in set(got) - {"tokens"}:
        assert sorted(str(r["doc_id"]) for r in got[name]) == ids, name
    by = {name: {r["doc_id"]: r for r in rows} for name, rows in got.items()}
    assert by["quality"][1]["n_words"] == 0 and by["quality"][1]["base_failed"] and not by["quality"][1]["kept"]
    assert by["quality"][6]["n_words"] == 60_000
    assert by["jaccard"][2]["n_shingles"] == 0 and by["jaccard"][2]["component_id"] == 2
    assert by["jaccard"][None]["component_id"] is None and by["jaccard"][None]["n_shingles"] == 1
    assert by["jaccard"][5]["component_id"] == 5
    assert by["mixing"][1]["size"] == 0 and by["mixing"][1]["taken"] == 0
    assert by["decontamination"][5]["n_hit"] == 3 and by["decontamination"][5]["item_ids"] == ["3"]
    assert by["decontamination"][None]["n_hit"] == 2 and by["decontamination"][None]["n_items"] == 0
    assert by["decontamination"][3]["n_words"] == 0
    assert by["pii"][1]["spans"] == []
    assert by["linedup"][1]["text"] is None and by["linedup"][6]["text"] == LONG
    assert all(0 <= r["score"] <= 1 for r in got["toxicity"])
    assert not by["toxicity"][None]["held_out"]
    empty = [r for r in got["tokens"] if r["doc_id"] == 2]
    assert [(r["section"], r["n_tokens"]) for r in empty] == [(0, 0)]


def test_empty_tables(spark, docs, labels, items):
    for name, df in run_all(docs.limit(0), labels, items).items():
        assert df.collect() == [], name


def test_without_labels_and_items(spark, docs, labels, items):
    assert max(r["score"] for r in classify(docs, labels.limit(0)).collect()) < 1e-6
    assert {r["n_hit"] for r in contamination(docs, items.limit(0)).collect()} == {0}


def test_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "no scheme", "<p>x"), (None, "http://A.net", "<p>" * 3000 + "deep"),
            (4, "http://a.net/", "<article><p>same"), (4, "http://a.net/", "<article><p>same")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string") \
        .withColumns({c: F.lit("x") for c in ("text", "host", "path", "rule", "n_chars", "short", "action")})
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, action string")
    judged = sorted(tuple(str(x) for x in r) for r in judge_urls(pages, rules).collect())
    assert judged == [("1", "", "", "None", "allow"), ("2", "", "", "None", "allow"), ("3", "", "", "None", "allow"),
                      ("4", "a.net", "/", "net/", "block"), ("4", "a.net", "/", "net/", "block"),
                      ("None", "a.net", "", "None", "allow")]
    assert {r["verdict"] for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), rules).collect() == []
    texts = sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in extract_main_text(pages).collect())
    assert texts == [("1", "", 0), ("2", "", 0), ("3", "x", 1), ("4", "same", 4), ("4", "same", 4), ("None", "deep", 4)]
    assert extract_main_text(pages.limit(0)).collect() == []
