"""Reshaping queries on ``conversations``, ``documents``, ``lineitem``, ``orders``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.functions import nonempty_split
from stratum.operators import reshape as op
from stratum.sources.tables import load

# Fixed parameters: priorities whose daily values multiply (identity 1);
# the others add (identity 0).
PRODUCT_PRIORITIES = ("1-URGENT", "2-HIGH")

SHEET_WIDTHS = (2, 3, 2, 2)    # fixed parameter: the places of a worksheet's numbers

NL = "\n"


def _conv_tokens(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    return op.tokens(conv, "text", ["conv_id", "turn"])


def q_transpose_tokens(spark, sf_dir):
    return op.transpose_tokens(_conv_tokens(spark, sf_dir), ["conv_id"], "turn", "pos", "token")


def q_column_text(spark, sf_dir):
    return op.ordered_concat(_conv_tokens(spark, sf_dir), ["conv_id", "pos"], "token", "turn",
                             " ", "column_text")


def q_pack_rows(spark, sf_dir):
    return op.ordered_concat(_conv_tokens(spark, sf_dir), ["conv_id", "turn"], "token", "pos",
                             " ", "line")


def _doc_lines(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return op.split_rows(docs, "text", NL, ["doc_id"], item="line", pos="line_no",
                         drop_empty=False)


def q_text_split(spark, sf_dir):
    lines = _doc_lines(spark, sf_dir).where(F.col("line") != "")
    return lines.select(
        "doc_id", "line_no",
        F.size(nonempty_split(F.trim("line"), op.BLANKS)).cast("bigint").alias("n_words"),
        F.split_part(F.col("line"), F.lit(" "), F.lit(1)).alias("first_word"))


def q_text_sections(spark, sf_dir):
    lines = _doc_lines(spark, sf_dir)
    # split: one very long document is spread over many tasks
    sec = op.group_by_breaks(lines, ["doc_id"], ["line_no"], F.col("line") == "", split=True)
    return (sec.where(F.col("line") != "").groupBy("doc_id", "section")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.length("line")).cast("bigint").alias("n_chars")))


def _factors(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", (F.floor("l_quantity") % 10 + 1).cast("bigint").alias("v"))


def q_grouped_product(spark, sf_dir):
    return op.exact_product(_factors(spark, sf_dir), ["l_orderkey"], "v", "product")


def q_dispatch_aggregate(spark, sf_dir):
    f = _factors(spark, sf_dir).withColumn(
        "op", F.when(F.col("l_orderkey") % 2 == 1, F.lit("*")).otherwise(F.lit("+")))
    return op.dispatch_aggregate(f, ["l_orderkey"], "v", "op", "result")


def q_densify(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01")).cast("bigint").alias("day_idx"))
    values = o.groupBy("priority", "day_idx").agg(F.count(F.lit(1)).alias("n"))
    groups = o.select("priority").distinct()
    bounds = o.select(F.min("day_idx").alias("lo"), F.max("day_idx").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    default = F.when(F.col("priority").isin(*PRODUCT_PRIORITIES), F.lit(1)).otherwise(F.lit(0))
    out = op.densify(values, groups, "priority", lo, hi, "day_idx", "n", default.cast("bigint"))
    return out.select("priority", "day_idx", F.col("value").cast("bigint").alias("value"))


def worksheets(spark, sf_dir):
    """Per order, its lines as rows of four numbers of fixed width, to the right or left in their
    places by line number, and a last row with the operators of the four."""
    li = load(spark, sf_dir, "lineitem")
    put = lambda v, w: F.when(F.col("l_linenumber") % 2 == 0, F.rpad(v.cast("bigint").cast("string"), w, " ")) \
        .otherwise(F.lpad(v.cast("bigint").cast("string"), w, " "))
    numbers = F.concat_ws(" ", *[put(v, w) for v, w in zip(
        (F.col("l_quantity"), F.col("l_partkey") % 1000, F.col("l_suppkey") % 100, F.round(F.col("l_discount") * 100)),
        SHEET_WIDTHS)])
    body = li.select(F.col("l_orderkey").alias("sheet"), numbers.alias("line"), "l_linenumber")
    nth = F.row_number().over(Window.partitionBy("sheet").orderBy("l_linenumber", "line")).cast("bigint")   # lines of one order
    even = F.col("sheet") % 2 == 0
    times = lambda flag: F.when(flag, F.lit("*")).otherwise(F.lit("+"))
    signs = [F.rpad(sign, w, " ") for sign, w in zip((times(even), F.lit("+"), times(~even), F.lit("+")), SHEET_WIDTHS)]
    last = li.groupBy(F.col("l_orderkey").alias("sheet")).agg((F.count(F.lit(1)) + 1).alias("row")) \
        .select("sheet", "row", F.concat_ws(" ", *signs).alias("line"))
    return body.select("sheet", nth.alias("row"), "line").unionByName(last)


def q_worksheet_rows(spark, sf_dir):
    return op.worksheet_rows(worksheets(spark, sf_dir), "sheet", "row", "line")


def q_worksheet_columns(spark, sf_dir):
    return op.worksheet_columns(worksheets(spark, sf_dir), "sheet", "row", "line")


QUERIES = {
    "worksheet_rows": q_worksheet_rows,
    "worksheet_columns": q_worksheet_columns,
    "transpose_tokens": q_transpose_tokens,
    "column_text": q_column_text,
    "pack_rows": q_pack_rows,
    "text_split": q_text_split,
    "text_sections": q_text_sections,
    "grouped_product": q_grouped_product,
    "dispatch_aggregate": q_dispatch_aggregate,
    "densify": q_densify,
}

_TOK = """tok AS (
  SELECT conv_id, turn, token, pos FROM (
    SELECT conv_id, turn, unnest(toks) AS token, CAST(unnest(range(1, len(toks) + 1)) AS BIGINT) AS pos
    FROM (SELECT conv_id, turn, string_split_regex(trim(text), ' +') AS toks FROM conversations))
  WHERE token <> '')"""

_LINES = """lines AS (
  SELECT doc_id, unnest(parts) AS line, CAST(unnest(range(1, len(parts) + 1)) AS BIGINT) AS line_no
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))"""

_FACTORS = """f AS (SELECT l_orderkey, CAST(floor(l_quantity) AS BIGINT) % 10 + 1 AS v FROM lineitem)"""

# the four numbers of every line, with their field's number, operator and digits in place
_SHEET = """l AS (SELECT l_orderkey AS sheet, l_linenumber AS n, list_value(CAST(l_quantity AS BIGINT), l_partkey % 1000,
       l_suppkey % 100, CAST(round(l_discount * 100) AS BIGINT)) AS nums FROM lineitem),
f AS (SELECT sheet, n, nums, unnest(range(1, 5)) AS problem FROM l),
cell AS (SELECT sheet, n, nums, problem, nums[problem] AS num, list_extract([2, 3, 2, 2], problem) AS w,
       CASE WHEN problem = 1 + 2 * (sheet % 2) THEN '*' ELSE '+' END AS op FROM f)"""
_ANSWER = """CASE WHEN op = '*' THEN CAST(list_reduce(list(CAST(v AS HUGEINT)), lambda a, x: a * x) AS DECIMAL(38,0))
       ELSE CAST(sum(v) AS DECIMAL(38,0)) END AS result"""
_PRODUCT = "CAST(list_reduce(list(CAST(v AS HUGEINT)), lambda a, x: a * x) AS DECIMAL(38,0))"

_PRIOS = ", ".join(f"'{p}'" for p in PRODUCT_PRIORITIES)

SQL = {
    "transpose_tokens": f"WITH {_TOK} SELECT conv_id, pos, turn, token FROM tok",
    "column_text": f"""WITH {_TOK}
SELECT conv_id, pos, string_agg(token, ' ' ORDER BY turn) AS column_text, count(*) AS n_items
FROM tok GROUP BY conv_id, pos""",
    "pack_rows": f"""WITH {_TOK}
SELECT conv_id, turn, string_agg(token, ' ' ORDER BY pos) AS line, count(*) AS n_items
FROM tok GROUP BY conv_id, turn""",
    "text_split": f"""WITH {_LINES}
SELECT doc_id, line_no,
       CAST(len(list_filter(string_split_regex(trim(line), ' +'), lambda t: t <> '')) AS BIGINT) AS n_words,
       split_part(line, ' ', 1) AS first_word
FROM lines WHERE line <> ''""",
    "text_sections": f"""WITH {_LINES},
s AS (SELECT doc_id, line, SUM(CASE WHEN line = '' THEN 1 ELSE 0 END)
        OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
      FROM lines)
SELECT doc_id, CAST(section AS BIGINT) AS section, count(*) AS n_lines, CAST(SUM(length(line)) AS BIGINT) AS n_chars
FROM s WHERE line <> '' GROUP BY doc_id, section""",
    "grouped_product": f"""WITH {_FACTORS}
SELECT l_orderkey, {_PRODUCT} AS product FROM f GROUP BY l_orderkey""",
    "worksheet_rows": f"""WITH {_SHEET}
SELECT sheet, CAST(problem AS BIGINT) AS problem, op, {_ANSWER} FROM (SELECT sheet, problem, op, num AS v FROM cell) GROUP BY sheet, problem, op""",
    # digits taken out of each number by its place, no text lines
    "worksheet_columns": f"""WITH {_SHEET},
t AS (SELECT *, CAST(num AS VARCHAR) AS txt FROM cell),
d AS (SELECT sheet, n, nums, problem, op, unnest(range(1, w + 1)) AS col, txt, w FROM t),
c AS (SELECT sheet, problem, op, col, n, nums,
      substr(CASE WHEN n % 2 = 0 THEN rpad(txt, CAST(w AS INTEGER), ' ') ELSE lpad(txt, CAST(w AS INTEGER), ' ') END, CAST(col AS INTEGER), 1) AS ch FROM d),
ln AS (SELECT sheet, n, nums, string_agg(CASE WHEN n % 2 = 0 THEN rpad(txt, CAST(w AS INTEGER), ' ') ELSE lpad(txt, CAST(w AS INTEGER), ' ') END, ' ' ORDER BY problem) AS line
      FROM (SELECT DISTINCT sheet, n, nums, problem, txt, w FROM t) GROUP BY sheet, n, nums),
v AS (SELECT sheet, problem, op, col, CAST(string_agg(ch, '' ORDER BY c.n, line) AS BIGINT) AS v
      FROM c JOIN ln USING (sheet, n, nums) WHERE ch <> ' ' GROUP BY sheet, problem, op, col)
SELECT sheet, CAST(problem AS BIGINT) AS problem, op, {_ANSWER} FROM v GROUP BY sheet, problem, op""",
    "dispatch_aggregate": f"""WITH {_FACTORS}
SELECT l_orderkey, CASE WHEN l_orderkey % 2 = 1 THEN '*' ELSE '+' END AS op,
       CASE WHEN l_orderkey % 2 = 1 THEN {_PRODUCT} ELSE CAST(SUM(v) AS DECIMAL(38,0)) END AS result
FROM f GROUP BY l_orderkey""",
    "densify": f"""WITH o AS (
  SELECT o_orderpriority AS priority, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day_idx
  FROM orders),
b AS (SELECT min(day_idx) AS lo, max(day_idx) AS hi FROM o),
v AS (SELECT priority, day_idx, count(*) AS n FROM o GROUP BY priority, day_idx),
g AS (SELECT priority, unnest(range(lo, hi + 1)) AS day_idx FROM (SELECT DISTINCT priority FROM o), b)
SELECT g.priority, CAST(g.day_idx AS BIGINT) AS day_idx,
       CAST(coalesce(v.n, CASE WHEN g.priority IN ({_PRIOS}) THEN 1 ELSE 0 END) AS BIGINT) AS value
FROM g LEFT JOIN v ON g.priority = v.priority AND g.day_idx = v.day_idx""",
}
