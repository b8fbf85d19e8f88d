"""Worksheets against a reading of the text by hand."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stratum.operators import reshape


def by_hand(lines, down):
    """Answers of the problems of one sheet, (problem, op, result)."""
    *body, ops = lines
    if not down:
        values = [line.split() for line in body]
        out = []
        for p, op in enumerate(ops.split()):
            numbers = [int(v[p]) for v in values if p < len(v)]
            out.append((p + 1, op, numbers))
    else:
        wide = max(map(len, lines))
        body, ops = [line.ljust(wide) for line in body], ops.ljust(wide)
        out = []
        for c in range(wide):
            if ops[c] != " ":
                out.append((len(out) + 1, ops[c], []))
            text = "".join(line[c] for line in body).replace(" ", "")
            if out and text:
                out[-1][2].append(int(text))
    return {(p, op, math.prod(n) if op == "*" else sum(n)) for p, op, n in out if n}


def sheet_of(rnd):
    widths = [rnd.randint(1, 4) for _ in range(rnd.randint(1, 6))]
    body = [" ".join(rnd.choice((str.ljust, str.rjust))(str(rnd.randint(1, 10 ** w - 1)), w) for w in widths)
            for _ in range(rnd.randint(1, 5))]
    return [line.rstrip() for line in body] + [" ".join(rnd.choice("*+").ljust(w) for w in widths).rstrip()]


def frame(spark, sheets):
    rows = [(k, n * 10, line) for k, lines in sheets.items() for n, line in enumerate(lines)]
    return spark.createDataFrame(rows, "sheet string, row long, line string").repartition(4)


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["sheet"], set()).add((r["problem"], r["op"], int(r["result"])))
    return got


def test_worksheets(spark):
    rnd = random.Random(6)
    sheets = {f"s{k}": sheet_of(rnd) for k in range(60)}
    df = frame(spark, sheets)
    assert answers(reshape.worksheet_rows(df, "sheet", "row", "line")) == {k: by_hand(v, False) for k, v in sheets.items()}
    assert answers(reshape.worksheet_columns(df, "sheet", "row", "line")) == {k: by_hand(v, True) for k, v in sheets.items()}


def test_rotated_lines(spark):
    df = frame(spark, {"a": ["12 345", " 3   6", "*  +"]})
    got = [r["line"] for r in reshape.rotate_worksheet(df, "sheet", "row", "line").orderBy("row").collect()]
    assert got == ["1 3", "23 4", "1 56", "* +"]          # the first problem is filled up with 1


def test_edges_of_worksheets(spark):
    rows = [(None, 1, "1"), ("a", None, "7"), ("a", 1, None), ("a", 2, "2 3"), ("a", 3, "+ *"),
            ("only", 1, "+"), ("empty", 1, ""), ("empty", 2, "+")]
    df = spark.createDataFrame(rows, "sheet string, row long, line string")
    for f in (reshape.worksheet_rows, reshape.worksheet_columns):
        assert answers(f(df, "sheet", "row", "line")) == {"a": {(1, "+", 2), (2, "*", 3)}}
        assert f(df.where(F.lit(False)), "sheet", "row", "line").count() == 0


def test_numbers_longer_than_a_bigint(spark):
    """A column of 20 lines is a number of 20 digits; a product of two such columns still fits at 38 digits."""
    sheets = {"sum": ["98 7"] * 20 + ["+  *"], "product": ["99 1"] * 19 + ["*  +"], "few": ["12 3"] * 3 + ["*  +"]}
    got = answers(reshape.worksheet_columns(frame(spark, sheets), "sheet", "row", "line"))
    assert got == {k: by_hand(v, True) for k, v in sheets.items()}
    wide = {"rows": ["9" * 38 + " -" + "9" * 19, "0 " + "1" * 20, "+ +"], "times": ["1" * 20, "7", "*"]}
    assert answers(reshape.worksheet_rows(frame(spark, wide), "sheet", "row", "line")) == {k: by_hand(v, False) for k, v in wide.items()}


@pytest.mark.parametrize("lines", [["1.5", "2", "+"], ["1" * 20 + ".5", "2", "+"], ["9" * 39, "+"], ["9" * 20, "9" * 20, "*"]])
def test_what_is_no_integer_or_does_not_fit_is_an_error(spark, lines):
    with pytest.raises(PySparkException):
        reshape.worksheet_rows(frame(spark, {"a": lines}), "sheet", "row", "line").collect()


def test_an_order_of_twenty_lines(spark, tmp_path):
    """The query's own sheets: 20 lines of one order, answers by hand from the text."""
    from stratum.catalog.reshape import q_worksheet_columns, worksheets
    rows = [(o, 999_999, 1099, 2, 9.0, 0.09) for o in (4, 6) for _ in range(20)] + [(5, 7, 9, 3, 50.0, 0.1)] * 3
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                                "l_discount double").write.parquet(str(tmp_path / "lineitem.parquet"))
    sheets = {}
    for r in worksheets(spark, str(tmp_path)).orderBy("sheet", "row").collect():
        sheets.setdefault(r["sheet"], []).append(r["line"])
    assert answers(q_worksheet_columns(spark, str(tmp_path))) == {k: by_hand(v, True) for k, v in sheets.items()}
