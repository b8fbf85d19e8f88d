"""Graph and pair queries on ``lineitem``, ``documents``, ``customer``, ``supplier``
(U7 k-core, U17, U18, U19, U20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.functions import cents
from stratum.operators import graphs as op
from stratum.operators import neighbours
from stratum.sources.tables import load

# Fixed recipe parameters.
N_PAIRS, TOP_K = 1000, 3


def _supplies(spark, sf_dir):
    """Every part-supplier pair of the order lines, as edges."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("a"),
                     F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("b")).distinct()


def _shared_lines(spark, sf_dir):
    """Each document tied to the first document that holds one of its lines, over all lines."""
    lines = load(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")) \
        .where(F.col("line") != "").select("doc_id", F.xxhash64("line").alias("line")).distinct()
    first = lines.groupBy("line").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1).select("line", "first")
    return lines.join(first, "line").where(F.col("doc_id") > F.col("first")) \
        .select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct()


def _points3(spark, sf_dir, table, prefix):
    t = load(spark, sf_dir, table)
    return t.select(F.col(f"{prefix}_{'custkey' if table == 'customer' else 'suppkey'}").alias("id"),
                    (F.col(f"{prefix}_nationkey").cast("bigint") * 1000).alias("x"),
                    cents(f"{prefix}_acctbal").alias("y"),
                    (F.col(f"{prefix}_{'custkey' if table == 'customer' else 'suppkey'}") * 10).alias("z"))


def q_k_core(spark, sf_dir):
    edges = _supplies(spark, sf_dir)
    parts = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    k = int(parts.agg(F.floor(F.avg("n"))).first()[0] or 0)     # the mean number of suppliers of a part
    return op.degrees(op.k_core(edges, k))


def q_connected_components(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return op.connected_components(_shared_lines(spark, sf_dir), nodes=docs, node="doc_id")


def q_component_product(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return op.top_component_product(
        op.connected_components(_shared_lines(spark, sf_dir), nodes=docs, node="doc_id"), TOP_K)


def q_closest_pairs(spark, sf_dir):
    return neighbours.closest_pairs(_points3(spark, sf_dir, "customer", "c"), "id", ["x", "y", "z"], N_PAIRS)


def q_circuit_product(spark, sf_dir):
    pts = _points3(spark, sf_dir, "customer", "c")
    pairs = neighbours.closest_pairs(pts, "id", ["x", "y", "z"], N_PAIRS)
    labels = op.connected_components(pairs, "i", "j", nodes=pts, node="id")
    return op.top_component_product(labels, TOP_K)


def q_spanning_edge(spark, sf_dir):
    pts = _points3(spark, sf_dir, "supplier", "s")
    top = op.heaviest_edge(neighbours.spanning_tree(pts, "id", ["x", "y", "z"]))
    xs = pts.select("id", "x")
    return (top.join(xs.withColumnRenamed("id", "i").withColumnRenamed("x", "xi"), "i")
            .join(xs.withColumnRenamed("id", "j").withColumnRenamed("x", "xj"), "j")
            .select("i", "j", "d2", (F.col("xi") * F.col("xj")).alias("x_product")))


QUERIES = {
    "k_core": q_k_core,
    "connected_components": q_connected_components,
    "component_product": q_component_product,
    "closest_pairs": q_closest_pairs,
    "circuit_product": q_circuit_product,
    "spanning_edge": q_spanning_edge,
}

_E = """e AS (SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS a, 's' || CAST(l_suppkey AS VARCHAR) AS b FROM lineitem),
k AS (SELECT floor(avg(n)) AS k FROM (SELECT a, count(*) AS n FROM e GROUP BY a))"""
_LINES = """lines AS (SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
u AS (SELECT DISTINCT x.doc_id AS x, y.doc_id AS y FROM lines x JOIN lines y ON x.line = y.line AND x.line <> ''
      AND x.doc_id <> y.doc_id),
reach(node, other) AS (SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, u.y FROM reach r JOIN u ON u.x = r.other),
lab AS (SELECT node, min(other) AS component FROM reach GROUP BY node)"""
_PTS = lambda t, p, key: f"""pts AS (SELECT {p}_{key} AS id, CAST({p}_nationkey AS BIGINT) * 1000 AS x,
  CAST(round({p}_acctbal * 100) AS BIGINT) AS y, {p}_{key} * 10 AS z FROM {t})"""
_PAIRS = """allpairs AS (SELECT a.id AS i, b.id AS j,
  (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2
  FROM pts a JOIN pts b ON a.id < b.id)"""
_TOPPROD = f"""CAST(CASE WHEN count(*) = {TOP_K} THEN list_reduce(list(CAST(size AS HUGEINT)), lambda a, x: a * x) END AS DECIMAL(38,0)) AS product"""

SQL = {
    "k_core": f"""WITH RECURSIVE {_E},
core(rnd, a, b, n_cur, n_prev) AS (
  SELECT 0, a, b, (SELECT count(*) FROM e), (SELECT count(*) FROM e) + 1 FROM e
  UNION ALL
  SELECT rnd, a, b, count(*) OVER (), n_prev FROM (
    SELECT c.rnd + 1 AS rnd, c.a, c.b, c.n_cur AS n_prev,
           count(*) OVER (PARTITION BY c.a) AS da, count(*) OVER (PARTITION BY c.b) AS db
    FROM core c WHERE c.n_cur < c.n_prev)
  WHERE da >= (SELECT k FROM k) AND db >= (SELECT k FROM k)),
final AS (SELECT a, b FROM core WHERE n_cur = n_prev),
ends AS (SELECT a AS node FROM final UNION ALL SELECT b FROM final)
SELECT node, count(*) AS degree FROM ends GROUP BY node""",
    "connected_components": f"WITH RECURSIVE {_LINES} SELECT node AS doc_id, component FROM lab",
    "component_product": f"""WITH RECURSIVE {_LINES},
sizes AS (SELECT component, count(*) AS size FROM lab GROUP BY component ORDER BY size DESC, component LIMIT {TOP_K})
SELECT {_TOPPROD} FROM sizes""",
    "closest_pairs": f"""WITH {_PTS('customer', 'c', 'custkey')}, {_PAIRS}
SELECT i, j, d2 FROM allpairs ORDER BY d2, i, j LIMIT {N_PAIRS}""",
    "circuit_product": f"""WITH RECURSIVE {_PTS('customer', 'c', 'custkey')}, {_PAIRS},
top AS (SELECT i, j FROM allpairs ORDER BY d2, i, j LIMIT {N_PAIRS}),
u AS (SELECT i AS x, j AS y FROM top UNION SELECT j, i FROM top),
reach(node, other) AS (SELECT id, id FROM pts UNION SELECT r.node, u.y FROM reach r JOIN u ON u.x = r.other),
lab AS (SELECT node, min(other) AS component FROM reach GROUP BY node),
sizes AS (SELECT component, count(*) AS size FROM lab GROUP BY component ORDER BY size DESC, component LIMIT {TOP_K})
SELECT {_TOPPROD} FROM sizes""",
    "spanning_edge": f"""WITH RECURSIVE {_PTS('supplier', 's', 'suppkey')},
pairs AS (SELECT a.id AS i, b.id AS j,
  (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2
  FROM pts a JOIN pts b ON a.id <> b.id),
prim(step, visited, ei, ej, ed2) AS (
  SELECT 0, [min(id)], NULL::BIGINT, NULL::BIGINT, NULL::BIGINT FROM pts
  UNION ALL
  SELECT step + 1, list_append(visited, e.j), e.i, e.j, e.d2 FROM prim, LATERAL (
     SELECT i, j, d2 FROM pairs WHERE list_contains(visited, i) AND NOT list_contains(visited, j)
     ORDER BY d2, least(i, j), greatest(i, j) LIMIT 1) e
  WHERE step < (SELECT count(*) FROM pts) - 1),
top AS (SELECT least(ei, ej) AS i, greatest(ei, ej) AS j, ed2 AS d2 FROM prim WHERE step > 0
        ORDER BY ed2 DESC, least(ei, ej) DESC, greatest(ei, ej) DESC LIMIT 1)
SELECT top.i, top.j, top.d2, pa.x * pb.x AS x_product FROM top JOIN pts pa ON pa.id = top.i JOIN pts pb ON pb.id = top.j""",
}
