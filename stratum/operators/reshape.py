"""Text-to-table reshaping and grouped folds.

Text is split with JVM-side ``split``/``posexplode``; positions are 1-based.
Folds that the reference emulated by recursion (products, ordered string
concatenation) are grouped aggregates here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.plans import Lineage, spread

BLANKS = " +"  # runs of blanks separate tokens (the reference squeezes them)


def split_rows(df: DataFrame, text: str, pattern: str, keep: list[str],
               item: str = "item", pos: str = "pos", drop_empty: bool = True) -> DataFrame:
    """One row per delimited piece with its 1-based position.

    Positions count every piece (also empty ones), so they match the text;
    ``drop_empty`` then removes empty pieces ('' never yields rows).
    """
    out = df.select(*keep, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), pattern))
                    .alias("_p", item))
    out = out.withColumn(pos, (F.col("_p") + 1).cast("bigint")).drop("_p")
    return out.where(F.col(item) != "") if drop_empty else out


def tokens(df: DataFrame, text: str, keep: list[str], item: str = "token",
           pos: str = "pos") -> DataFrame:
    """R7 + R1 + R3: trimmed text, blank runs squeezed, one row per token."""
    trimmed = df.select(*keep, F.trim(F.col(text)).alias("_t"))
    return split_rows(trimmed, "_t", BLANKS, keep, item, pos)


def transpose_tokens(tok: DataFrame, group: list[str], row: str, pos: str, item: str) -> DataFrame:
    """Ragged rows -> column-wise long form ``(group, pos, row, item)``."""
    return tok.select(*group, pos, row, item)


def ordered_concat(df: DataFrame, group: list[str], value: str, order: str, sep: str,
                   out: str) -> DataFrame:
    """Concatenate ``value`` per group in ``order``."""
    agg = F.expr(f"listagg(`{value}`, '{sep}') WITHIN GROUP (ORDER BY `{order}`)")
    return df.groupBy(*group).agg(agg.alias(out), F.count(F.lit(1)).alias("n_items"))


MAX_FACTORS = 126     # 2**127 is above DECIMAL(38,0): more factors >= 2 cannot fit


def _integer(df: DataFrame, value: str) -> Column:
    """``value`` as a BIGINT, or as a DECIMAL(38,0) where it is text, whose integers may be longer than a BIGINT."""
    if df.schema[value].dataType.simpleString() != "string":
        return F.col(value).cast("bigint")
    longer = (F.length(value) > 18) & F.col(value).rlike(r"^[+-]?[0-9]+$")
    return F.when(longer, F.col(value).cast("decimal(38,0)")).otherwise(F.col(value).cast("bigint").cast("decimal(38,0)"))


def _products(df: DataFrame, keys: list[str], value: str, wanted: Column, extra: list[Column]) -> DataFrame:
    """Per group: ``_prod`` where ``wanted`` (an expression over the aggregates ``extra``) holds.

    Values are counted per (keys, value) once, map-side combined.  A group's
    product is 0 with a zero, NULL without values, and else the product of at
    most MAX_FACTORS counted factors; more of them, or a product beyond
    DECIMAL(38,0), is an error and never a NULL.
    """
    v, n = F.col("_v"), F.col("_c")
    counts = df.groupBy(*keys, _integer(df, value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"), *extra[:1])
    rest = extra[1:]
    big = F.coalesce(F.abs("_v") >= 2, F.lit(False))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(big.desc(), "_v"))
    # one aggregate in the partitions of the window: no second shuffle, and no join of two aggregates
    both = counts.withColumn("_rank", rank).groupBy(*keys).agg(
        F.count("_v").alias("_values"), F.count_if(v == 0).alias("_zeros"),
        F.sum(F.when(v < 0, n).otherwise(0)).alias("_negs"),
        F.sum(F.when(big, n).otherwise(0)).alias("_factors"),
        F.collect_list(F.when(big & (F.col("_rank") <= MAX_FACTORS + 1),
                              F.struct(F.abs("_v").alias("a"), n.alias("n")))).alias("_list"), *rest)
    one, dec = F.lit(1).cast("decimal(38,0)"), "decimal(38,0)"
    too_big = F.raise_error(F.lit("a product is too large for DECIMAL(38,0)")).cast(dec)
    size = F.aggregate("_list", one, lambda acc, f: F.when(f["n"] == 1, (acc * f["a"]).cast(dec)).otherwise(
        F.aggregate(F.sequence(F.lit(1).cast("bigint"), f["n"]), acc, lambda p, _: (p * f["a"]).cast(dec))))
    sign = F.when(F.col("_negs") % 2 == 1, F.lit(-1)).otherwise(F.lit(1))
    prod = (F.when(~wanted | (F.col("_values") == 0), F.lit(None))
            .when(F.col("_zeros") > 0, F.lit(0).cast(dec))
            .when(F.col("_factors") > MAX_FACTORS, too_big)
            .otherwise((F.coalesce(size, too_big) * sign).cast(dec)))
    return both.withColumn("_prod", prod.cast(dec))


def exact_product(df: DataFrame, keys: list[str], value: str, out: str = "product") -> DataFrame:
    """Exact integer product per group as DECIMAL(38,0); an overflow raises."""
    keys = list(keys)
    res = _products(df, keys, value, F.lit(True), [])
    return res.select(*keys, F.col("_prod").alias(out))


def dispatch_aggregate(df: DataFrame, keys: list[str], value: str, op: str,
                       out: str = "result") -> DataFrame:
    """Per group, the product or the sum of ``value`` as chosen by ``op``.

    ``op`` holds '*' or '+' and must be constant within a group.
    """
    keys = list(keys)
    dec = "decimal(38,0)"
    total = F.sum(F.col("_v").cast(dec) * F.col("_c")).cast(dec).alias("_sum")
    res = _products(df, keys, value, F.col(op) == "*", [F.max(op).alias(op), F.max(op).alias(op), total])
    return res.select(*keys, op, F.when(F.col(op) == "*", F.col("_prod"))
                      .otherwise(F.col("_sum")).cast(dec).alias(out))


def densify(values: DataFrame, groups: DataFrame, group: str, lo: Column, hi: Column,
            position: str, value: str, default: Column, out: str = "value") -> DataFrame:
    """Complete (group x position) grid, missing cells get ``default``.

    ``lo``/``hi`` are scalar-subquery columns bounding the position domain;
    each group row explodes its own position range, so no cross join is
    planned.  ``default`` may refer to the group columns.
    """
    grid = groups.select("*", F.explode(F.sequence(lo, hi)).alias(position))
    joined = grid.join(values, [group, position], "left")
    return joined.select(group, position, F.coalesce(F.col(value), default).alias(out))


def group_by_breaks(df: DataFrame, keys: list[str], order: list, is_break: Column,
                    out: str = "section", split: bool = False) -> DataFrame:
    """Section number = running count of break records, per key."""
    from stratum.operators.ordered import delimiter_groups
    return delimiter_groups(df, order, is_break, keys=keys, out=out, split=split)


# ---------------------------------------------------------------------------
# Worksheets: the lines of a sheet are rows of numbers, its last line holds the
# operator of every problem.  ``sheets`` has rows of (sheet, row, line).
# ---------------------------------------------------------------------------


def footer_split(sheets: DataFrame, sheet: str, row: str, line: str) -> tuple[DataFrame, DataFrame]:
    """(body, footer): the lines before each sheet's last one, and the last ones.

    The last rows are an aggregate, and the body meets it by an equi join; a tie on the last
    row counts as one footer, the largest text.  Sheets and rows that are NULL are left out.
    """
    known = sheets.select(sheet, row, F.coalesce(line, F.lit("")).alias(line)) \
        .where(F.col(sheet).isNotNull() & F.col(row).isNotNull())
    known = Lineage(sheets.sparkSession, 1).cut(known, force=True)     # read several times, made once
    footer = known.groupBy(sheet).agg(F.max(F.struct(row, line)).alias("_f")).select(sheet, "_f.*")
    body = known.join(footer.select(sheet, F.col(row).alias("_last")), sheet).where(F.col(row) < F.col("_last"))
    return body.drop("_last"), footer


def worksheet_rows(sheets: DataFrame, sheet: str, row: str, line: str, out: str = "result") -> DataFrame:
    """Numbers stand side by side, one problem a column of tokens.

    Token p of the footer is the operator ('*' or '+') of the p-th tokens of all other lines.
    Returns ``(sheet, problem, op, out)``; an operator without numbers has no row.  A number has up to
    38 digits.  A token that is no integer is an error, as is a number, sum or product beyond DECIMAL(38,0).
    """
    body, footer = footer_split(sheets, sheet, row, line)
    op = tokens(footer, line, [sheet], "op", "problem")
    values = transpose_tokens(tokens(body, line, [sheet, row], "_v", "problem"), [sheet], row, "problem", "_v")
    n = body.agg(F.sum(F.size(F.split(F.trim(line), BLANKS)))).first()[0] or 0
    values = spread(values, n, sheet, "problem")      # the join and all aggregates are made in these parts
    return dispatch_aggregate(values.join(op, [sheet, "problem"]), [sheet, "problem"], "_v", "op", out)


def rotate_worksheet(sheets: DataFrame, sheet: str, row: str, line: str) -> DataFrame:
    """The sheet whose numbers are the columns of ``sheets``, as lines again.

    1. A problem begins at each operator of the footer, and the column before it is blank: the
       problem of a column is the running count of operators (of one line, as wide as the sheet).
    2. A column's characters, joined from top to bottom without blanks, are a number.
    3. Problems with fewer columns than the widest of their sheet are filled up with the
       operator's identity ('1' or '0').
    4. The n-th numbers of all problems are line n of the new sheet; the footer is its last line.

    Columns without characters and characters before the first operator are left out, and so is
    an operator without numbers: the footer that is returned holds the others, so that places agree.
    """
    from stratum.operators.ordered import delimiter_groups
    body, footer = footer_split(sheets, sheet, row, line)
    board = body.select(sheet, row, F.posexplode(F.split(F.rtrim(line), "")).alias("col", "_ch")) \
        .where(~F.col("_ch").isin("", " "))
    lineage = Lineage(sheets.sparkSession, 1)
    n = body.agg(F.sum(F.length(F.replace(line, F.lit(" "), F.lit(""))))).first()[0] or 0
    board = spread(board, n, sheet, "col")
    wide = body.where(F.length(F.rtrim(line)) > 0).groupBy(sheet).agg(F.max(F.length(F.rtrim(line)) - 1).alias("_wide"))
    marks = footer.join(wide, sheet).select(sheet, F.posexplode(F.split(
        F.rpad(line, F.greatest(F.length(line), (F.col("_wide") + 1).cast("int")), F.lit(" ")), "")).alias("col", "_ch")) \
        .where(F.col("_ch") != "")
    marks = delimiter_groups(spread(marks, n, sheet), ["col"], F.col("_ch") != " ", [sheet], out="problem") \
        .withColumn("op", F.max(F.when(F.col("_ch") != " ", F.col("_ch"))).over(Window.partitionBy(sheet, "problem"))) \
        .where(F.col("problem") > 0).drop("_ch")
    numbers = ordered_concat(board, [sheet, "col"], "_ch", row, "", "_v").join(marks, [sheet, "col"])
    numbers = lineage.cut(numbers.select(F.struct(sheet, "problem").alias("_of"), "op", "col", "_v"), force=True)
    n = numbers.count()
    nth = F.row_number().over(Window.partitionBy("_of").orderBy("col"))
    numbers = lineage.cut(spread(numbers, n, "_of").select("_of", "op", nth.alias("nth"), "_v"), force=True)
    problems = spread(numbers, n, "_of").groupBy("_of").agg(F.max("op").alias("op"), F.max("nth").alias("_n"))
    most = problems.groupBy(F.col(f"_of.{sheet}").alias(sheet)).agg(F.max("_n").alias("_most"))
    problems = lineage.cut(problems.withColumn(sheet, F.col(f"_of.{sheet}")).join(most, sheet).select("_of", "op", "_most"),
                           force=True)
    filled = densify(spread(numbers.drop("op"), n, "_of", "nth"), problems, "_of", F.lit(1), F.col("_most"), "nth", "_v",
                     F.when(F.col("op") == "*", F.lit("1")).otherwise(F.lit("0")), "_v")
    cells = filled.select(F.col(f"_of.{sheet}").alias(sheet), F.col("nth").cast("bigint").alias(row),
                          F.col("_of.problem").alias("_p"), "_v")
    ops = problems.select(F.col(f"_of.{sheet}").alias(sheet), (F.col("_most") + 1).cast("bigint").alias(row),
                          F.col("_of.problem").alias("_p"), F.col("op").alias("_v"))
    return ordered_concat(spread(cells.unionByName(ops), 2 * n, sheet, row), [sheet, row], "_v", "_p", " ", line).drop("n_items")


def worksheet_columns(sheets: DataFrame, sheet: str, row: str, line: str, out: str = "result") -> DataFrame:
    """The composed chain: numbers are read down the columns, then as ``worksheet_rows``."""
    return worksheet_rows(rotate_worksheet(sheets, sheet, row, line), sheet, row, line, out)
