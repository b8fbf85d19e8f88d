"""Prefix trie of conversations by ROLLUP over positional turn columns.

A node is a distinct sequence of the first d turns (role, text); its members are the
conversations that start with it, and its id is the smallest of them.

1. Turns are numbered in a split ordered scan, and a turn is the 128-bit digest of
   its role and text with its number of words.
2. ``WIDTH`` turns of a conversation make one row of a block, with a column for each
   position.  Longer conversations go on in further rows, keyed by the block's number
   and the node in which the block before it ended.  A node's key is the sum of four
   32-bit hashes of (turn, position) over its path, so a running sum gives the key of
   every block at once, whatever the number of blocks.
3. One ``GROUP BY block, prior, ROLLUP (t1, ..., tWIDTH)`` aggregates all prefixes of
   all blocks together; ``grouping_id`` tells their depth.
4. Each node gives its value, (members - 1) * words, to its smallest member.  A member
   is the smallest of a run of nodes that ends where the conversation ends.  So the
   sum of a subtree is the sum over its members, which a second ROLLUP finds, less
   what its smallest member has from the nodes above, which is a running sum.
   Leaves are counted in the same way.  No node is listed under its ancestors.
5. Ids of the conversations that end in a node are joined in pieces and hashed as a
   sorted stream, so no task holds a list of them.

Hot first turns, conversations and nodes meet only aggregates that combine before
the shuffle, split scans and joins with one row per key on the other side.  The hash
of a node's list is one sequential digest; its pieces are built in many tasks.

Defined cases: null roles and texts are empty; turns are ordered by ``turn``, nulls
first, and equal ones by their digest; repeated rows are turns of their own; rows
with a null conversation are left out; a conversation that is left without turns is a
member of the root alone; an empty table has no root and gives an empty result; very
long texts and conversations are taken whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.plans import Lineage, ordered_scan
from stratum.plans.prefix import ordered_scans

WIDTH = 8
EVERY, SHARES = 20, 4       # conversations of a family, and 1 + the most turns that they share
KEY = ["k0", "k1", "k2", "k3"]
WORD = r"[^\x20\x09-\x0D]+"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """(conv, pos, turn): the turns of every conversation, numbered from 1; a turn is (digest, words)."""
    who, what = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, what), 256)
    turns = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("at"),
        F.struct(F.unhex(F.substring(digest, 1, 32)).alias("digest"),
                 F.regexp_count(what, F.lit(WORD)).alias("words")).alias("turn"), F.lit(1).cast("bigint").alias("one"))
    return ordered_scan(turns, ["at", "turn"], "one", "pos", "sum", ["conv"], True).select("conv", "pos", "turn")


def shared_heads(turns: DataFrame, every: int = EVERY, shares: int = SHARES) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first h turns are replaced by those of the first of their ``every``.

    h is crc32 of the decimal id modulo ``shares``.  Returns the turns (conv, pos, turn) and the
    conversations (conv, n) with their new numbers of turns.
    """
    base = F.col("conv") - F.col("conv") % every
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shares
    heads = turns.filter((F.col("conv") % every == 0) & (F.col("pos") < shares)).groupBy(F.col("conv").alias("base")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "turn"))).alias("head"))     # fewer than ``shares`` turns
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumn("base", base) \
        .join(heads, "base", "left").withColumn("h", h) \
        .withColumn("head", F.filter(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)),
                                     lambda x: x["pos"] <= F.col("h"))) \
        .withColumn("n", F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    given = convs.select("conv", F.explode("head").alias("x")).select("conv", "x.pos", "x.turn")
    kept = turns.join(convs.select("conv", "h", (F.size("head") - F.col("h")).alias("shift")), "conv") \
        .filter(F.col("pos") > F.col("h")).select("conv", (F.col("pos") + F.col("shift")).alias("pos"), "turn")
    return given.unionByName(kept), convs.select("conv", "n")


def _pieces(turn: Column, pos: Column) -> list[Column]:
    """Four 32-bit hashes of a turn at a position; zeros for no turn."""
    low = F.lit(0xFFFFFFFF)
    pos = pos.cast("bigint")
    out = []
    for h in (F.xxhash64(turn["digest"], pos), F.xxhash64(pos, turn["digest"])):
        out += [h.bitwiseAND(low), F.shiftrightunsigned(h, 32)]
    return [F.when(turn.isNull(), F.lit(0)).otherwise(x).cast("bigint") for x in out]


def _ending(width: int) -> list[Column]:
    """The key of the node in which a row of a block ends."""
    place = F.col("block") * width
    each = [_pieces(F.col(f"t{j}"), place + j) for j in range(1, width + 1)]
    return [sum((x[q] for x in each), F.col(k)).alias(k) for q, k in enumerate(KEY)]


def turn_blocks(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(block, k0..k3, conv, t1..twidth): each ``width`` turns of a conversation as one row."""
    at = F.col("pos") - 1
    blocks = turns.groupBy("conv", F.floor(at / width).alias("block")).agg(
        *[F.max(F.when(at % width == j, F.col("turn"))).alias(f"t{j + 1}") for j in range(width)])
    long = turns.join(convs.filter(F.col("n") > width).select("conv"), "conv", "left_semi") \
        .select("conv", "pos", *[x.alias(k) for x, k in zip(_pieces(F.col("turn"), F.col("pos")), KEY)])
    sums = ordered_scans(long, ["pos"], [(k, f"sum_{k}", "sum") for k in KEY], ["conv"], True)
    prior = sums.filter(F.col("pos") % width == 0).select(
        "conv", F.floor(F.col("pos") / width).alias("block"), *[F.col(f"sum_{k}").alias(k) for k in KEY])
    first = blocks.filter(F.col("block") == 0).select("*", *[F.lit(0).cast("bigint").alias(k) for k in KEY])
    return first.unionByName(blocks.filter(F.col("block") > 0).join(prior, ["conv", "block"]))


def rolled_up(blocks: DataFrame, measures: str, width: int = WIDTH) -> DataFrame:
    """``measures`` of every node of every block: (depth, k0..k3, last turn, measures), keyed by the node's key."""
    turns = ", ".join(f"t{j}" for j in range(1, width + 1))
    keys = ", ".join(["block", *KEY])
    every = blocks.sparkSession.sql(
        f"SELECT {keys}, {turns}, grouping_id() AS rolled, {measures} FROM {{blocks}} "
        f"GROUP BY {keys}, ROLLUP({turns})", blocks=blocks)
    length = F.lit(width) - F.bit_count("rolled")
    last = F.element_at(F.array(*[F.col(f"t{j}") for j in range(1, width + 1)]), F.greatest(length, F.lit(1)).cast("int"))
    nodes = every.withColumn("length", length).withColumn("last", last) \
        .filter((F.col("length") > 0) & F.col("last").isNotNull())     # a shorter conversation has no such node
    names = [c for c in every.columns if c not in {"block", "rolled", *KEY, *turns.split(", ")}]
    return nodes.select((F.col("block") * width + F.col("length")).cast("bigint").alias("depth"), *_ending(width),
                        "last", *names)


def _hashed(ends: DataFrame) -> DataFrame:
    """(depth, k0..k3, ends_sha256): sha256 of the ascending, comma-joined ids of each node."""
    node = ["depth", *KEY]
    schema = ", ".join(f"{c} bigint" for c in node)

    def pieces(batches):
        for batch in batches:
            frame = batch.to_pandas()
            out = frame.groupby(node, sort=False).agg(
                first=("conv", "first"), ids=("conv", lambda x: ",".join(map(str, x)))).reset_index()
            yield pa.RecordBatch.from_pandas(out, preserve_index=False)

    def digests(batches):
        now, state, done = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != now:
                    if state:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield out(done)
            done = []
        if state:
            yield out([(*now, state.hexdigest())])

    def out(rows):
        columns = list(zip(*rows)) or [[] for _ in range(len(node) + 1)]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())],
            names=[*node, "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = ends.select(*node, "conv").repartitionByRange(parts, *node, "conv").sortWithinPartitions(*node, "conv")
    return split.mapInArrow(pieces, f"{schema}, first bigint, ids string") \
        .repartition(*node).sortWithinPartitions(*node, "first").mapInArrow(digests, f"{schema}, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row of ``NODE`` columns for each node of the trie of ``turns`` (conv, pos, turn).

    ``convs`` (conv, n) names every conversation, also those without turns, and its number of turns.
    """
    lineage = Lineage(turns.sparkSession, 1)
    node = ["depth", *KEY]
    blocks = lineage.cut(turn_blocks(turns, convs, width), force=True)
    found = lineage.cut(rolled_up(blocks, "count(*) AS n_convs, min(conv) AS conv_id", width), force=True)
    step = _pieces(F.col("last"), F.col("depth"))
    found = found.select(*node, *[(F.col(k) - x).alias(f"up_{k}") for k, x in zip(KEY, step)], "conv_id", "n_convs",
                         ((F.col("n_convs") - 1) * F.col("last.words")).alias("value"))
    children = found.groupBy((F.col("depth") - 1).alias("depth"), *[F.col(f"up_{k}").alias(k) for k in KEY]) \
        .agg(F.count(F.lit(1)).alias("n_children"))
    nodes = found.join(children, node, "left").fillna(0, ["n_children"])
    nodes = lineage.cut(ordered_scan(nodes, ["depth"], "value", "above", "sum", ["conv_id"], True, True), force=True)
    held = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("value").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaf"))
    subtree = rolled_up(blocks.join(held, "conv", "left"),
                        "min(conv) AS conv_id, coalesce(sum(saved), 0) AS saved, coalesce(sum(leaf), 0) AS n_leaves",
                        width).select("conv_id", "depth", "saved", "n_leaves")

    last = blocks.join(convs.withColumnRenamed("n", "depth"), "conv") \
        .filter(F.col("block") == F.floor((F.col("depth") - 1) / width)).select("conv", "depth", *_ending(width))
    turnless = convs.filter(F.col("n") == 0).select("conv", F.lit(0).cast("bigint").alias("depth"),
                                                    *[F.lit(0).cast("bigint").alias(k) for k in KEY])
    ends = lineage.cut(_hashed(last.unionByName(turnless)), force=True)

    # three aggregates of one row each, met in a union
    members = convs.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    below = held.agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("n_leaves"))
    tops = nodes.filter(F.col("depth") == 1).agg(F.count(F.lit(1)).alias("n_children"))
    of_root = members.unionByName(below, allowMissingColumns=True).unionByName(tops, allowMissingColumns=True) \
        .agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("n_convs", "saved", "n_leaves", "n_children")],
             F.max("conv_id").alias("conv_id")).filter(F.col("n_convs") > 0)
    zero = F.lit(0).cast("bigint")
    root = lineage.cut(of_root.select(
        "conv_id", zero.alias("depth"), *[zero.alias(k) for k in KEY], F.lit(None).cast("bigint").alias("parent_conv_id"),
        "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), F.col("saved").alias("saved_tokens")),
        force=True)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"up_{k}") for k in KEY],
                           F.col("conv_id").alias("parent_conv_id")) \
        .unionByName(root.select(F.lit(1).cast("bigint").alias("depth"), *[F.col(k).alias(f"up_{k}") for k in KEY],
                                 F.col("conv_id").alias("parent_conv_id")))
    whole = nodes.join(subtree, ["conv_id", "depth"]).join(parents, ["depth", *[f"up_{k}" for k in KEY]]) \
        .select("conv_id", *node, "parent_conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("saved") - F.coalesce("above", F.lit(0))).alias("saved_tokens"))
    result = whole.unionByName(root).join(ends, node, "left").fillna({"ends_sha256": hashlib.sha256(b"").hexdigest()})
    return result.select(*[F.col(c).cast("string" if c == "ends_sha256" else "bigint").alias(c) for c in NODE])
