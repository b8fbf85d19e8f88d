"""Graph operators on edge DataFrames (U7 k-core, U18, U19, U20).

All loops are driver-controlled with a one-row/emptiness stop test and a
checkpoint per round; every round is a handful of joins and aggregates keyed
by node, so a hot node is handled by map-side combining and AQE skew joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.plans import Lineage


def _undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    e = edges.select(F.col(a).alias("_u"), F.col(b).alias("_v"))
    return e.unionByName(e.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))


def degrees(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    ends = edges.select(F.col(a).alias("node")).unionByName(edges.select(F.col(b).alias("node")))
    return ends.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def k_core(edges: DataFrame, k: int, a: str = "a", b: str = "b",
           rounds_per_job: int = 2) -> DataFrame:
    """The k-core -- repeatedly drop nodes of degree < k (with their
    edges) until every remaining node has degree >= k.  Returns the
    surviving edges.  Edges are undirected: both orientations are one edge
    (kept as smaller, larger) and self loops are none.  Low-degree nodes are
    removed by anti joins; the removed set is usually small, so AQE
    broadcasts it."""
    lineage = Lineage(edges.sparkSession, 1)
    e = lineage.cut(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b))
                    .distinct(), force=True)
    while True:
        low = degrees(e, a, b).where(F.col("degree") < k)
        if low.isEmpty():
            return e
        for _ in range(max(1, rounds_per_job)):
            low = degrees(e, a, b).where(F.col("degree") < k).select("node")
            e = (e.join(low.withColumnRenamed("node", a), a, "left_anti")
                 .join(low.withColumnRenamed("node", b), b, "left_anti").select(a, b))
        e = lineage.cut(e, force=True)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         nodes: DataFrame | None = None, node: str = "node") -> DataFrame:
    """``(node, component)`` with component = smallest node id reachable.

    Alternating large-star and small-star: each node's larger neighbours, then
    the node and its smaller neighbours, are tied to the smallest node around.
    Both keep the components and turn them into stars in O(log n) rounds for
    any shape, long paths included.  A node's edges meet only in an aggregate
    (combined before the shuffle) and a join with one row per node, so hubs are
    no hot groups.  The loop ends when a round leaves the edges unchanged.
    ``nodes`` adds isolated nodes; NULL ends and self loops are dropped.
    """
    lineage = Lineage(edges.sparkSession, 1)
    e = lineage.cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
                    force=True)
    ends = e.select(F.col("u").alias("node")).unionByName(e.select(F.col("v").alias("node")))
    if nodes is not None:
        ends = ends.unionByName(nodes.select(F.col(node).alias("node")))

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 30)), F.bit_xor(
            F.xxhash64("v", "u"))).first()

    before = mark(e)
    while before[0]:
        und = _undirected(e, "u", "v")
        low = und.groupBy("_u").agg(F.least(F.min("_v"), F.col("_u")).alias("m"))
        large = und.where(F.col("_v") > F.col("_u")).join(low, "_u") \
            .select(F.col("_v").alias("u"), F.col("m").alias("v")).distinct()
        large = lineage.cut(large, force=True)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("w"), "m").where(F.col("w") != F.col("m")) \
            .unionByName(low.select(F.col("u").alias("w"), "m"))
        e = lineage.cut(small.select(F.col("w").alias("u"), F.col("m").alias("v")).distinct(), force=True)
        after = mark(e)
        if after == before:
            break
        before = after
    return ends.distinct().join(e.select(F.col("u").alias("node"), "v"), "node", "left") \
        .select(F.col("node").alias(node), F.coalesce("v", "node").alias("component"))


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def top_component_product(labels: DataFrame, k: int = 3, out: str = "product") -> DataFrame:
    """Product of the k largest component sizes (NULL with fewer than k).

    Sizes are an aggregate; only the top k (TakeOrderedAndProject) reach the
    final single-row fold.
    """
    top = component_sizes(labels).orderBy(F.col("size").desc(), F.col("component")).limit(k)
    dec = "decimal(38,0)"
    folded = top.agg(F.count(F.lit(1)).alias("_n"),
                     F.aggregate(F.collect_list(F.col("size").cast(dec)), F.lit(1).cast(dec),
                                 lambda acc, x: (acc * x).cast(dec)).alias("_p"))
    return folded.select(F.when(F.col("_n") == k, F.col("_p")).cast(dec).alias(out))


def _resolve_pointers(parent: DataFrame, lineage: Lineage, max_rounds: int = 64) -> DataFrame:
    """Roots of a pointer forest ``(c, p)`` by pointer jumping (p <- p(p)).

    Borůvka picks form a forest whose only cycles are mutual picks; those
    are broken first by making the smaller id the root.
    """
    pp = parent.join(parent.select(F.col("c").alias("p"), F.col("p").alias("_pp")), "p", "left")
    parent = lineage.cut(pp.select("c", F.when((F.col("_pp") == F.col("c")) & (F.col("c") < F.col("p")),
                                               F.col("c")).otherwise(F.col("p")).alias("p")), force=True)
    for _ in range(max_rounds):
        jumped = parent.join(parent.select(F.col("c").alias("p"), F.col("p").alias("_pp")), "p", "left")
        moved = jumped.where(F.col("_pp").isNotNull() & (F.col("_pp") != F.col("p")))
        if moved.isEmpty():
            return parent
        parent = lineage.cut(jumped.select("c", F.coalesce("_pp", "p").alias("p")), force=True)
    raise RuntimeError("pointer jumping did not converge")


def _boruvka(e: DataFrame, comp: DataFrame, lineage: Lineage, max_rounds: int = 64):
    """Borůvka rounds over edges ``(_a, _b, _w)`` from component labels
    ``(node, comp)`` until no edge leaves a component.  Returns the picked
    edges (one DataFrame per round) and the final labels."""
    chosen = []
    for _ in range(max_rounds):
        ce = (e.join(comp.select(F.col("node").alias("_a"), F.col("comp").alias("_ca")), "_a")
              .join(comp.select(F.col("node").alias("_b"), F.col("comp").alias("_cb")), "_b")
              .where(F.col("_ca") != F.col("_cb")))
        ends = (ce.select(F.col("_ca").alias("c"), F.col("_cb").alias("_o"), "_w", "_a", "_b")
                .unionByName(ce.select(F.col("_cb").alias("c"), F.col("_ca").alias("_o"), "_w", "_a", "_b")))
        picks = lineage.cut(ends.groupBy("c").agg(F.min(F.struct("_w", "_a", "_b", "_o")).alias("_e"))
                            .select("c", "_e._w", "_e._a", "_e._b", F.col("_e._o").alias("p")), force=True)
        if picks.isEmpty():
            break
        chosen.append(picks.select("_a", "_b", "_w"))
        roots = _resolve_pointers(picks.select("c", "p"), lineage)
        comp = lineage.cut(comp.join(roots.withColumnRenamed("c", "comp"), "comp", "left")
                           .select("node", F.coalesce("p", "comp").alias("comp")), force=True)
    else:
        raise RuntimeError("the spanning forest did not converge")
    return chosen, comp


def _ordered_edges(edges: DataFrame, i: str, j: str, w: str) -> DataFrame:
    return edges.select(F.least(i, j).alias("_a"), F.greatest(i, j).alias("_b"),
                        F.col(w).alias("_w")).where(F.col("_a") != F.col("_b")).distinct()


def _tree(chosen: list, like: DataFrame, i: str, j: str, w: str) -> DataFrame:
    if chosen:
        tree = chosen[0]
        for c in chosen[1:]:
            tree = tree.unionByName(c)
        tree = tree.distinct()
    else:
        tree = like.select("_a", "_b", "_w").limit(0)
    return tree.select(F.col("_a").alias(i), F.col("_b").alias(j), F.col("_w").alias(w))


def spanning_forest(edges: DataFrame, i: str = "i", j: str = "j", w: str = "d2",
                    max_rounds: int = 64) -> tuple[DataFrame, DataFrame]:
    """U20 core: minimum spanning forest by Borůvka rounds.

    Edges are totally ordered by (w, min(i,j), max(i,j)), so the forest is
    unique.  Each round every component picks its lightest outgoing edge
    (a grouped ``min(struct)``), the picks form a pointer forest over
    components that pointer jumping collapses, and nodes are relabelled --
    at most log2(#nodes) rounds.  Returns ``(tree_edges(i, j, w),
    labels(node, comp))``.
    """
    lineage = Lineage(edges.sparkSession, 1)
    e = lineage.cut(_ordered_edges(edges, i, j, w), force=True)
    comp = lineage.cut(_undirected(e, "_a", "_b").select(F.col("_u").alias("node")).distinct()
                       .select("node", F.col("node").alias("comp")), force=True)
    chosen, comp = _boruvka(e, comp, lineage, max_rounds)
    return _tree(chosen, e, i, j, w), comp.select("node", "comp")


def heaviest_edge(tree: DataFrame, i: str = "i", j: str = "j", w: str = "d2") -> DataFrame:
    """The last edge Kruskal adds: the maximum under the (w, i, j) order."""
    return tree.orderBy(F.col(w).desc(), F.col(i).desc(), F.col(j).desc()).limit(1)


def spanning_edge(edges: DataFrame, i: str = "i", j: str = "j", w: str = "d2") -> DataFrame:
    """The heaviest edge of the minimum spanning forest, one row."""
    tree, _ = spanning_forest(edges, i, j, w)
    return heaviest_edge(tree, i, j, w)
