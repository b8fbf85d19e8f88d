"""The registered queries: against their SQL on sf0.001, and the pipeline end to end."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from stratum.llm.queries import QUERIES, SQL
from stratum.sources.tables import load
from tools.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(SQL[name])
    want, columns = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, want)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op") and n[2].isdigit()) \
        == list(range(1, 14))
    assert "pipeline" in E.queries() and len(corpus_pipeline.STAGES) == 5


def test_pipeline(spark):
    docs = load(spark, SF, "documents")
    columns = docs.columns
    counts, state = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, SF).cache()
        assert state.columns == columns, name
        assert state.schema.simpleString() == docs.schema.simpleString(), name
        counts.append(state.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    texts = state.filter(F.length("text") > 0)
    assert texts.count() == texts.select("text").distinct().count()            # no exact copy is left
    assert state.filter(F.col("n_chars") != F.length("text")).count() == 0
    last = corpus_pipeline.run(spark, SF)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    mixed = last.agg(F.sum(words)).first()[0]
    assert mixed == pytest.approx(1.5 * state.agg(F.sum(words)).first()[0], rel=0.2)
    assert last.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2


def test_pipeline_on_odd_rows(spark):
    rows = [(1, None, "en", "a", None), (None, "null id text", None, None, 12), (2, "", "en", None, 0),
            (3, "same words for both of them here", "en", "a", 32), (3, "same words for both of them here", "en", "a", 32),
            (4, "same words for both of them here", "en", "b", 32)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame in (docs, docs.limit(0)):
        state = frame
        for name, stage in corpus_pipeline.STAGES:
            state = stage(spark, state, SF).cache()
            if name == "near_duplicates":
                assert sorted(str(r["doc_id"]) for r in state.collect()) == (["1", "2", "3", "None"] if frame is docs else [])
        assert state.columns == [*docs.columns, "copy"]


def test_near_duplicates_keep_rows_and_not_ids(spark):
    """Equal ids with other texts: the copy goes, the unique text stays."""
    import corpus_pipeline
    a, b = "one two three four five six seven", "alpha beta gamma delta epsilon zeta eta"
    rows = [(3, b), (5, b), (5, a), (6, ""), (6, ""), (None, a), (7, a), (8, a + " " + b), (8, a + " " + b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in got) == sorted(
        [("3", b), ("5", a), ("6", ""), ("6", ""), ("None", a), ("8", a + " " + b)])
