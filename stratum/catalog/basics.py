"""One small query per built-in operator row of the inventory (S, R, P, J,
A, D, W, T, O families and the scalar functions), each over the provided
tables and each with a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stratum.functions import bit, cents, floor_div, int_div
from stratum.operators import ordered
from stratum.plans import ordered_scan
from stratum.plans.prefix import ordered_scans
from stratum.sources import recipes
from stratum.sources.tables import load

# Priority weights of the inline lookup relation.
PRIORITY_WEIGHTS = [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)]


def q_values_lookup(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    lookup = spark.createDataFrame(PRIORITY_WEIGHTS, "priority string, weight int")
    j = o.join(F.broadcast(lookup), o["o_orderpriority"] == lookup["priority"])  # 5 fixed rows
    return j.groupBy("priority", "weight").agg(F.count(F.lit(1)).alias("n_orders"))


def q_series_expand(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    a, b = F.col("o_orderkey") % 7, F.col("o_custkey") % 9
    up = o.where(a <= b).select(F.explode(F.sequence(a, b)).alias("v"), F.lit("asc").alias("kind"))
    step = F.when(b >= a, F.lit(1)).otherwise(F.lit(-1)).cast("bigint")
    signed = o.select(F.explode(F.sequence(a, b, step)).alias("v"), F.lit("signed").alias("kind"))
    return up.unionByName(signed).groupBy("kind", "v").agg(F.count(F.lit(1)).alias("n"))


def q_series_scalar_bound(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    top = li.select(F.max("l_linenumber")).scalar()
    slots = li.select("l_orderkey").distinct().select(
        "l_orderkey", F.explode(F.sequence(F.lit(1), top)).alias("l_linenumber"))
    missing = slots.join(li.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "left_anti")
    return missing.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n_missing"))


def q_filters(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    cond = ((F.col("l_quantity") > 45) & ((F.col("l_returnflag") == "R") | (F.col("l_linestatus") == "F"))
            & ~(F.col("l_discount") == 0) & F.col("l_tax").isNotNull())
    return li.where(cond).select("l_orderkey", "l_linenumber", "l_partkey")


def q_case_when(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    band = (F.when(F.col("o_totalprice") > 300000, F.lit("high"))
            .when(F.col("o_totalprice") > 100000, F.lit("mid")).otherwise(F.lit(None)))
    inner = F.abs(F.when(F.col("o_orderstatus") == "F", -F.col("o_orderkey")).otherwise(F.col("o_orderkey")))
    return o.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"),
                                             F.sum(inner).cast("bigint").alias("key_sum"))


def _returned_orders(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey")).distinct()


def q_in_flag(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    flagged = o.join(_returned_orders(spark, sf_dir).withColumn("_r", F.lit(1)), "o_orderkey", "left")
    flagged = flagged.withColumn("flag", F.coalesce("_r", F.lit(0)).cast("bigint"))
    run = ordered_scan(flagged, ["o_orderdate", "o_orderkey"], "flag", "running_flags", "sum",
                       ["o_custkey"], True)
    return run.select("o_orderkey", F.col("running_flags").cast("bigint"))


def q_not_in(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    big = load(spark, sf_dir, "lineitem").where(F.col("l_quantity") == 50).select(
        F.col("l_orderkey").alias("o_orderkey")).where(F.col("o_orderkey").isNotNull())
    return (o.join(big, "o_orderkey", "left_anti").groupBy("o_orderstatus")
            .agg(F.count(F.lit(1)).alias("n")))


def q_scalar_subquery(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    top = li.select(F.max("l_quantity")).scalar()
    return li.where(F.col("l_quantity") == top).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


def q_left_default(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey")
    n = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("_n"))
    return c.join(n, "c_custkey", "left").select("c_custkey", F.coalesce("_n", F.lit(0)).alias("n_orders"))


def q_using_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderpriority")
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), "l_returnflag")
    return (li.join(o, "orderkey").groupBy("o_orderpriority", "l_returnflag")
            .agg(F.count(F.lit(1)).alias("n")))


def q_next_row(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey",
                                              F.to_date("o_orderdate").alias("d"))
    prev = ordered.previous_value(o, ["d", "o_orderkey"], "d", "prev_d", keys=["o_custkey"], split=True)
    return prev.select("o_custkey", "o_orderkey",
                       F.datediff("d", "prev_d").cast("bigint").alias("gap_days"))


def q_semi_anti(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    semi = c.join(o, "k", "left_semi").agg(F.lit("with_orders").alias("kind"), F.count(F.lit(1)).alias("n"))
    anti = c.join(o, "k", "left_anti").agg(F.lit("without_orders").alias("kind"), F.count(F.lit(1)).alias("n"))
    return semi.unionByName(anti)


def q_counts(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"),
                                          F.countDistinct("l_partkey").alias("n_parts"))


def q_sums_minmax(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.groupBy("l_linestatus").agg(
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.sum(F.col("l_quantity") * 2 + 1).cast("bigint").alias("qty_expr"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.min("l_shipdate").cast("string").alias("first_ship"))


def q_array_top(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", F.floor("l_quantity").alias("q"),
                                                "l_linenumber", "l_partkey")
    w = Window.partitionBy("l_orderkey").orderBy(F.col("q").desc(), "l_linenumber", "l_partkey")
    top = li.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= 3)  # WindowGroupLimit
    dec = "decimal(38,0)"
    agg = top.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("q"), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)).alias("_t"))
    return agg.select("l_orderkey", F.array_join(F.col("_t").cast("array<string>"), ",").alias("top3"),
                      F.aggregate(F.col("_t"), F.lit(1).cast(dec), lambda acc, x: (acc * x).cast(dec))
                      .alias("top3_product"))


def q_distinct_rows(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


def q_first_per_key(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(
        F.max(F.struct("o_totalprice", F.col("o_orderkey"))).alias("_hi"),
        F.min(F.struct("o_orderdate", "o_orderkey")).alias("_first")).select(
        "o_custkey", F.col("_hi.o_orderkey").alias("top_order"), F.col("_first.o_orderkey").alias("first_order"))


def q_running_parity(spark, sf_dir):
    st = recipes.steps(spark, sf_dir).withColumn(
        "err", (F.col("event_type") == "error").cast("bigint"))
    run = ordered_scan(st, ["ts", "event_id"], "err", "n_err", "sum", ["user_id"], "tb")
    return run.groupBy("user_id").agg(F.count_if(F.col("n_err") % 2 == 1).cast("bigint").alias("n_odd"))


def q_lag_lead(spark, sf_dir):
    st = recipes.steps(spark, sf_dir)
    tot = ordered.running_total(st, ["ts", "event_id"], "delta", 50, ["user_id"], "tb")
    prev = ordered.previous_value(tot, ["ts", "event_id"], "total", "prev", ["user_id"], "tb", default=50)
    return prev.groupBy("user_id").agg(F.sum(F.abs(F.col("total") - F.col("prev"))).cast("bigint")
                                       .alias("total_change"))


def q_numbering(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    o = o.withColumn("_one", F.lit(1).cast("bigint"))
    # W8 global and W10 per-key numbering, both as split running counts
    g = ordered_scans(o, ["o_orderdate", "o_orderkey"], [("_one", "global_seq", "sum")], [], True)
    g = ordered_scans(g, ["o_orderdate", "o_orderkey"], [("_one", "cust_seq", "sum")], ["o_custkey"], True)
    return g.select("o_orderkey", "cust_seq", "global_seq")


def q_topn(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey", "o_totalprice")


def q_set_ops(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nk"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nk"))
    all_rows = c.unionByName(s).agg(F.lit("union_all").alias("kind"), F.count(F.lit(1)).alias("n"))
    dist = c.unionByName(s).distinct().agg(F.lit("union").alias("kind"), F.count(F.lit(1)).alias("n"))
    return all_rows.unionByName(dist)


def q_bit_scalars(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    v = F.shiftright("o_orderkey", 3).bitwiseXOR(F.col("o_custkey").bitwiseAND(F.lit(255)))
    return o.groupBy("o_orderstatus").agg(F.bit_xor(v).alias("x"), F.sum(v).cast("bigint").alias("s"),
                                          F.bit_or(bit(F.col("o_custkey") % 16)).alias("m"))


def q_string_scalars(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        F.replace(F.col("p_name"), F.lit(" "), F.lit("-")).alias("dashed"),
        F.substring("p_name", 1, 5).alias("head5"),
        F.length("p_name").cast("bigint").alias("len"),
        F.repeat(F.substring("p_brand", 7, 2), 2).alias("rep"),
        F.regexp_replace(F.trim("p_type"), " +", "_").alias("type_"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("bt"),
        F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("word2"))


def q_math_scalars(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    x = cents("c_acctbal")
    return c.select("c_custkey", F.abs(x).alias("abs_c"), floor_div(x, 100).alias("floor_100"),
                    (-floor_div(-x, 100)).alias("ceil_100"), F.pmod(x, F.lit(100)).alias("pmod_100"),
                    (x % 100).alias("rem_100"), int_div(x, 100).alias("div_100"),
                    F.least(x, F.lit(0)).alias("least0"), F.greatest(x, F.lit(0)).alias("greatest0"))


def q_signed_tokens(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    amount = cents("value").cast("string")
    token = F.concat(F.when(F.col("event_type").isin("error", "view"), F.lit("L")).otherwise(F.lit("R")), amount)
    num = F.replace(F.replace(token, F.lit("L"), F.lit("-")), F.lit("R"), F.lit("")).cast("bigint")
    return ev.groupBy("user_id").agg(F.sum(num).cast("bigint").alias("net"))


def q_field_extract(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    k = F.regexp_replace(F.split_part(F.col("props"), F.lit(":"), F.lit(2)), "[ }]", "").try_cast("bigint")
    return ev.groupBy("event_type").agg(F.sum(k).cast("bigint").alias("k_sum"),
                                        F.count(k).alias("k_count"))


def q_array_fields(spark, sf_dir):
    """Split to an array and read fixed subscripts (NULL past the end)."""
    p = load(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select("p_partkey", F.get(words, 0).alias("w1"), F.get(words, 2).alias("w3"),
                    F.get(words, 7).alias("w8"), F.size(words).cast("bigint").alias("n_words"))


def q_last_record(spark, sf_dir):
    conv = load(spark, sf_dir, "conversations")
    last = conv.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return conv.join(last, ["conv_id", "turn"]).select("conv_id", "turn", "role",
                                                      F.length("text").cast("bigint").alias("n_chars"))


QUERIES = {
    "values_lookup": q_values_lookup,
    "series_expand": q_series_expand,
    "series_scalar_bound": q_series_scalar_bound,
    "filters": q_filters,
    "case_when": q_case_when,
    "in_flag": q_in_flag,
    "not_in": q_not_in,
    "scalar_subquery": q_scalar_subquery,
    "left_default": q_left_default,
    "using_join": q_using_join,
    "next_row": q_next_row,
    "semi_anti": q_semi_anti,
    "counts": q_counts,
    "sums_minmax": q_sums_minmax,
    "array_top": q_array_top,
    "distinct_rows": q_distinct_rows,
    "first_per_key": q_first_per_key,
    "running_parity": q_running_parity,
    "lag_lead": q_lag_lead,
    "numbering": q_numbering,
    "topn": q_topn,
    "set_ops": q_set_ops,
    "bit_scalars": q_bit_scalars,
    "string_scalars": q_string_scalars,
    "math_scalars": q_math_scalars,
    "signed_tokens": q_signed_tokens,
    "field_extract": q_field_extract,
    "last_record": q_last_record,
    "array_fields": q_array_fields,
}

_W = ", ".join(f"('{p}', {w})" for p, w in PRIORITY_WEIGHTS)
_STEPS = """steps AS (
  SELECT user_id, ts, event_id, event_type,
         CASE WHEN event_type IN ('error', 'view') THEN -CAST(round(value * 100) AS BIGINT)
              ELSE CAST(round(value * 100) AS BIGINT) END AS delta
  FROM events)"""
_C = "CAST(round(c_acctbal * 100) AS BIGINT)"
_FL = lambda x: f"(({x}) - ((({x}) % 100) + 100) % 100) // 100"

SQL = {
    "values_lookup": f"""WITH lk(priority, weight) AS (VALUES {_W})
SELECT priority, weight, count(*) AS n_orders FROM orders JOIN lk ON o_orderpriority = priority GROUP BY priority, weight""",
    "series_expand": """WITH s AS (
  SELECT unnest(range(o_orderkey % 7, o_custkey % 9 + 1)) AS v, 'asc' AS kind FROM orders WHERE o_orderkey % 7 <= o_custkey % 9
  UNION ALL
  SELECT unnest(CASE WHEN o_custkey % 9 >= o_orderkey % 7 THEN range(o_orderkey % 7, o_custkey % 9 + 1)
                     ELSE range(o_orderkey % 7, o_custkey % 9 - 1, -1) END), 'signed' FROM orders)
SELECT kind, v, count(*) AS n FROM s GROUP BY kind, v""",
    "series_scalar_bound": """WITH slots AS (SELECT l_orderkey, unnest(range(1, (SELECT max(l_linenumber) FROM lineitem) + 1)) AS l_linenumber
  FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
missing AS (SELECT * FROM slots s WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = s.l_orderkey AND l.l_linenumber = s.l_linenumber))
SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS n_missing FROM missing GROUP BY l_linenumber""",
    "filters": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_quantity > 45 AND (l_returnflag = 'R' OR l_linestatus = 'F') AND NOT l_discount = 0 AND l_tax IS NOT NULL""",
    "case_when": """SELECT CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE NULL END AS band,
  count(*) AS n, CAST(sum(abs(CASE WHEN o_orderstatus = 'F' THEN -o_orderkey ELSE o_orderkey END)) AS BIGINT) AS key_sum
FROM orders GROUP BY 1""",
    "in_flag": """SELECT o_orderkey, CAST(sum(CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 1 ELSE 0 END)
  OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_flags
FROM orders""",
    "not_in": """SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50) GROUP BY o_orderstatus""",
    "scalar_subquery": """SELECT l_returnflag, count(*) AS n FROM lineitem
WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem) GROUP BY l_returnflag""",
    "left_default": """SELECT c_custkey, coalesce(n, 0) AS n_orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""",
    "using_join": """SELECT o_orderpriority, l_returnflag, count(*) AS n
FROM (SELECT l_orderkey AS orderkey, l_returnflag FROM lineitem) JOIN (SELECT o_orderkey AS orderkey, o_orderpriority FROM orders) USING (orderkey)
GROUP BY o_orderpriority, l_returnflag""",
    "next_row": """SELECT o_custkey, o_orderkey, CAST(date_diff('day', lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey),
  CAST(o_orderdate AS DATE)) AS BIGINT) AS gap_days FROM orders""",
    "semi_anti": """SELECT 'with_orders' AS kind, count(*) AS n FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT 'without_orders', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""",
    "counts": "SELECT l_returnflag, count(*) AS n, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY l_returnflag",
    "sums_minmax": """SELECT l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS qty, CAST(sum(l_quantity * 2 + 1) AS BIGINT) AS qty_expr,
  min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS first_ship
FROM lineitem GROUP BY l_linestatus""",
    "array_top": """WITH r AS (SELECT l_orderkey, CAST(floor(l_quantity) AS BIGINT) AS q,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY floor(l_quantity) DESC, l_linenumber, l_partkey) AS rn FROM lineitem)
SELECT l_orderkey, array_to_string(list(q ORDER BY q DESC), ',') AS top3,
  CAST(list_reduce(list(CAST(q AS HUGEINT)), lambda a, x: a * x) AS DECIMAL(38,0)) AS top3_product
FROM r WHERE rn <= 3 GROUP BY l_orderkey""",
    "distinct_rows": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "first_per_key": """SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS top_order,
  arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order FROM orders GROUP BY o_custkey""",
    "running_parity": f"""WITH {_STEPS},
r AS (SELECT user_id, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_err FROM steps)
SELECT user_id, CAST(count(*) FILTER (WHERE n_err % 2 = 1) AS BIGINT) AS n_odd FROM r GROUP BY user_id""",
    "lag_lead": f"""WITH {_STEPS},
t AS (SELECT user_id, ts, event_id, 50 + sum(delta) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total FROM steps),
l AS (SELECT user_id, total, lag(total, 1, 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM t)
SELECT user_id, CAST(sum(abs(total - prev)) AS BIGINT) AS total_change FROM l GROUP BY user_id""",
    "numbering": """SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cust_seq,
  CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS global_seq FROM orders""",
    "topn": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "set_ops": """SELECT 'union_all' AS kind, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'union', count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier)""",
    "bit_scalars": """SELECT o_orderstatus, bit_xor(xor(o_orderkey >> 3, o_custkey & 255)) AS x,
  CAST(sum(xor(o_orderkey >> 3, o_custkey & 255)) AS BIGINT) AS s,
  bit_or(CAST(1 AS BIGINT) << CAST(o_custkey % 16 AS INTEGER)) AS m FROM orders GROUP BY o_orderstatus""",
    "string_scalars": """SELECT p_partkey, replace(p_name, ' ', '-') AS dashed, substring(p_name, 1, 5) AS head5,
  CAST(length(p_name) AS BIGINT) AS len, repeat(substring(p_brand, 7, 2), 2) AS rep,
  regexp_replace(trim(p_type), ' +', '_', 'g') AS type_, p_brand || '/' || p_type AS bt, split_part(p_name, ' ', 2) AS word2
FROM part""",
    "math_scalars": f"""SELECT c_custkey, abs({_C}) AS abs_c, {_FL(_C)} AS floor_100, -({_FL('-' + _C)}) AS ceil_100,
  (({_C} % 100) + 100) % 100 AS pmod_100, {_C} % 100 AS rem_100,
  CAST(trunc({_C} / 100) AS BIGINT) AS div_100, least({_C}, 0) AS least0, greatest({_C}, 0) AS greatest0 FROM customer""",
    "signed_tokens": """SELECT user_id, CAST(sum(CAST(replace(replace(
  CASE WHEN event_type IN ('error', 'view') THEN 'L' ELSE 'R' END || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR),
  'L', '-'), 'R', '') AS BIGINT)) AS BIGINT) AS net FROM events GROUP BY user_id""",
    "field_extract": """SELECT event_type, CAST(sum(TRY_CAST(regexp_replace(split_part(props, ':', 2), '[ }]', '', 'g') AS BIGINT)) AS BIGINT) AS k_sum,
  count(TRY_CAST(regexp_replace(split_part(props, ':', 2), '[ }]', '', 'g') AS BIGINT)) AS k_count FROM events GROUP BY event_type""",
    "array_fields": """SELECT p_partkey, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[3] AS w3,
  string_split(p_name, ' ')[8] AS w8, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_words FROM part""",
    "last_record": """SELECT c.conv_id, c.turn, c.role, CAST(length(c.text) AS BIGINT) AS n_chars FROM conversations c
JOIN (SELECT conv_id, max(turn) AS turn FROM conversations GROUP BY conv_id) m ON c.conv_id = m.conv_id AND c.turn = m.turn""",
}
