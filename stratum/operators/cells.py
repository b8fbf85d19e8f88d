"""Sparse-grid and layered-graph operators (U6, U7 grid form, U15, U16).

Grids are long DataFrames of occupied cells ``(r, c)``.  Neighbour counts
go by words of 63 columns of a row: a word is sent to the words next to
it, and a ``groupBy(row, word)`` meets at most nine bitmaps for king moves.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions import bit, floor_div
from stratum.plans import Lineage

BLOCK_LEVELS, BLOCK_WIDTH = 8, 1 << 13   # levels and columns that one task of a layered propagation advances
WORD_BITS = 63                           # columns of a grid row that one word holds
PEEL_BITS = 32                           # the same where words must lie within the squares of a peel
# Fixed offsets: the eight king-move neighbours of a cell.
KING_OFFSETS = [(-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)]


def _offset_array(offsets) -> Column:
    """S3: an inline constant relation as an array of structs (no join)."""
    return F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"))
                     for dr, dc in offsets])


def cell_words(cells: DataFrame, r: str = "r", c: str = "c", bits: int = WORD_BITS) -> DataFrame:
    """The occupied cells as bitmaps of ``bits`` columns, ``(r, w, mask)``: bit i of word w is column ``w * bits + i``.

    Repeated cells set their bit once.  A NULL column has a word of its own, NULL, with bit 0."""
    return cells.groupBy(F.col(r).cast("bigint").alias("r"), floor_div(F.col(c).cast("bigint"), bits).alias("w")).agg(
        F.bit_or(F.coalesce(bit(F.pmod(F.col(c).cast("bigint"), F.lit(bits))), F.lit(1).cast("bigint"))).alias("mask"))


def word_cells(mask: Column, bits: int = WORD_BITS) -> Column:
    """The places of the bits that are set, one row each."""
    return F.explode(F.filter(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: _has(mask, i)))


def cell_rows(words: DataFrame, bits: int = WORD_BITS) -> DataFrame:
    """The cells ``(r, c)`` of ``cell_words``."""
    return words.select("r", "w", word_cells(F.col("mask"), bits).alias("_i")).select(
        "r", (F.col("w") * bits + F.col("_i")).alias("c"))


def _has(mask: Column, at) -> Column:
    return F.call_function("shiftright", mask, at).bitwiseAND(F.lit(1)) == 1


def _lanes(offsets, bits: int) -> dict:
    """(row step, word step) -> the bits of a word from which an offset makes this step."""
    lanes = {}
    for dr, dc in offsets:
        for i in range(bits):
            step = (dr, (i + dc) // bits)
            lanes[step] = lanes.get(step, 0) | (1 << i)
    return lanes


def _way_array(lanes: dict) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(dr).alias("dr"), F.lit(dw).alias("dw"),
                              F.lit(reach).cast("bigint").alias("reach"))
                     for k, ((dr, dw), reach) in enumerate(lanes.items())])


def neighbour_counts(cells: DataFrame, r: str = "r", c: str = "c",
                     offsets=KING_OFFSETS) -> DataFrame:
    """``(r, c, n)`` = occupied neighbours of every occupied cell.

    Cells go in words of ``WORD_BITS`` columns (``cell_words``).  A word is sent to the words that its
    cells' offsets reach, at most as many as there are row offsets and two more each, and a cell's
    count is read from the bitmaps that came to its word: no row per cell and offset is made.
    Repeated cells count once.
    """
    full = (1 << WORD_BITS) - 1
    lanes = {(0, 0): full} | _lanes(offsets, WORD_BITS)
    lanes[0, 0] = full
    names = {step: f"_m{k}" for k, step in enumerate(lanes)}
    words = cell_words(cells, r, c)
    # a NULL column is next to itself at any offset, as NULL + offset is NULL
    sent = F.when(F.col("w").isNull(), F.lit(full)).otherwise(F.col("mask"))
    ways = F.filter(_way_array(lanes), lambda way: F.col("w").isNull() | (F.col("mask").bitwiseAND(way["reach"]) != 0))
    moved = words.select("r", "w", "mask", sent.alias("_sent"), F.explode(ways).alias("_way")).select(
        (F.col("r") + F.col("_way.dr")).alias("r"), (F.col("w") + F.col("_way.dw")).alias("w"),
        F.col("_way.k").alias("k"), F.when(F.col("_way.k") == 0, F.col("mask")).alias("own"), F.col("_sent").alias("mask"))
    met = moved.groupBy("r", "w").agg(F.max("own").alias("own"), *[
        F.coalesce(F.max(F.when(F.col("k") == k, F.col("mask"))), F.lit(0).cast("bigint")).alias(names[step])
        for k, step in enumerate(lanes)]).where(F.col("own").isNotNull())
    at = F.col("_i")
    n = F.lit(0).cast("bigint")
    for dr, dc in offsets:      # the cell that reaches place i by dc stands at i - dc
        for dw in sorted({(i + dc) // WORD_BITS for i in range(WORD_BITS)}):
            place = at - dc + dw * WORD_BITS
            n = n + F.when(place.between(0, WORD_BITS - 1) & _has(F.col(names[dr, dw]), place), 1).otherwise(0)
    return met.select("*", word_cells(F.col("own")).alias("_i")).select(
        F.col("r").alias(r), (F.col("w") * WORD_BITS + at).alias(c), n.cast("bigint").alias("n"))


def peel(cells: DataFrame, k: int, r: str = "r", c: str = "c", offsets=KING_OFFSETS,
         rounds_per_job: int = 4) -> DataFrame:
    """U7 (grid): repeatedly remove occupied cells with fewer than ``k``
    occupied neighbours; return the surviving cells ``(r, c)``.

    Counts are computed once, then maintained incrementally: a round emits
    decrements only from the cells it removes (a small shuffle), and the
    survivors meet them in a join that AQE turns into a broadcast when the
    decrement set is small, so late rounds do not reshuffle the grid.
    ``rounds_per_job`` rounds are chained lazily between checkpoints (a
    round after the fixpoint is a no-op, so overshooting is harmless); the
    stop test is an emptiness check for cells still below ``k``.
    """
    spark = cells.sparkSession
    lineage = Lineage(spark, 1)
    state = lineage.cut(neighbour_counts(cells.select(r, c).distinct(), r, c, offsets), force=True)
    neg = [(-dr, -dc) for dr, dc in offsets]
    while True:
        if state.where(F.col("n") < k).isEmpty():
            return state.select(r, c)
        for _ in range(max(1, rounds_per_job)):
            gone = state.where(F.col("n") < k)
            dec = (gone.select(F.explode(_offset_array(neg)).alias("_o"), r, c)
                   .select((F.col(r) - F.col("_o.dr")).alias(r), (F.col(c) - F.col("_o.dc")).alias(c))
                   .groupBy(r, c).agg(F.count(F.lit(1)).alias("_d")))
            state = (state.where(F.col("n") >= k).join(dec, [r, c], "left")
                     .select(r, c, (F.col("n") - F.coalesce(F.col("_d"), F.lit(0))).cast("bigint")
                             .alias("n")))
        state = lineage.cut(state, force=True)


def _local_peel(k: int, offsets, bits: int):
    """Per-tile peel in numpy: the cells of own words are peeled to a local fixpoint,
    those of halo words count as present and are never removed."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        word, place = np.nonzero(pdf["mask"].to_numpy(np.int64)[:, None] >> np.arange(bits) & 1)
        own = pdf["own"].to_numpy()[word]
        r = pdf["r"].to_numpy(np.int64)[word]
        c = pdf["w"].to_numpy(np.int64)[word] * bits + place
        reach = 1 + max([abs(d) for o in offsets for d in o], default=0)
        width = int(c.max() - c.min()) + 1 + 2 * reach
        key = (r - r.min() + reach) * width + (c - c.min() + reach)
        order = np.argsort(key, kind="stable")
        skey, n = key[order], len(key)
        nbrs = []
        for dr, dc in offsets:
            probe = key + dr * width + dc
            pos = np.minimum(np.searchsorted(skey, probe), n - 1)
            nbrs.append(np.where(skey[pos] == probe, order[pos], n))      # n stands for no cell
        nb = np.stack(nbrs, axis=1)
        alive = np.append(np.ones(n, bool), False)
        todo = np.flatnonzero(own)
        while True:
            left = alive[nb[todo]].sum(axis=1) >= k
            if left.all():
                break
            alive[todo[~left]] = False
            todo = todo[left]
        gone = np.flatnonzero(own & ~alive[:n])
        return pd.DataFrame({"r": r[gone], "w": pdf["w"].to_numpy(np.int64)[word[gone]], "mask": np.int64(1) << place[gone]}) \
            .groupby(["r", "w"], as_index=False).sum()

    return run


TILE = ("lv", "tr", "tc")
COARSEST = 24       # times that a square may double its side


def _square(level, r: str = "r", c: str = "c") -> list[Column]:
    return [F.shiftright(r, level).alias("tr"), F.shiftright(c, level).alias("tc")]


def base_level(limit: int) -> int:
    return int(math.log2(max(1, limit))) // 2


def tile_map(cells: DataFrame, limit: int, n: Column | None = None) -> tuple[int, DataFrame]:
    """(base level, tiles of the base squares ``(br, bc, lv, tr, tc)``) for cells ``(r, c)``.

    Tiles are squares of side 2**lv on nested grids.  A base square holds at
    most ``limit`` places, so no tile has more cells than that on any shape; a
    sparse square belongs to the largest square around it that still holds no
    more than ``limit`` cells.  The counts are made by one aggregate over the
    base squares, each of which stands in ``COARSEST`` + 1 nested ones.  ``n`` counts
    the cells of rows that stand for several.
    """
    base = base_level(limit)
    squares = cells.groupBy(*_square(base)).agg((F.count(F.lit(1)) if n is None else n).alias("n"))
    up = F.explode(F.sequence(F.lit(0), F.lit(COARSEST))).alias("up")
    nested = squares.select(F.col("tr").alias("br"), F.col("tc").alias("bc"), "n", up).select(
        "br", "bc", "n", "up", F.expr("shiftright(br, up)").alias("tr"), F.expr("shiftright(bc, up)").alias("tc"))
    light = nested.groupBy("up", "tr", "tc").agg(F.sum("n").alias("n")).where(F.col("n") <= limit).drop("n")
    best = nested.drop("n").join(light, ["up", "tr", "tc"]).groupBy("br", "bc").agg(
        F.max(F.struct("up", "tr", "tc")).alias("t"))
    return base, best.select("br", "bc", (F.col("t.up") + base).alias("lv"), "t.tr", "t.tc")


def peel_blocked(cells: DataFrame, k: int, r: str = "r", c: str = "c", offsets=KING_OFFSETS,
                 cells_per_tile: int = 50_000, max_iter: int = 10_000) -> DataFrame:
    """U7 (grid), block-parallel: same result as ``peel`` in far fewer jobs.

    The grid is cut into square tiles of at most ``cells_per_tile`` cells
    (``tile_map``; fewer where that leaves cores idle).  Each tile gets its own
    cells plus a halo of neighbouring cells from other tiles, and peels its own
    cells to a local fixpoint in one ``applyInPandas`` task, counting halo
    cells as present.  That only ever over-counts neighbours, so every
    local removal is also a removal of the global peel.  The next iteration
    runs only the tiles with a halo cell that was removed; when there is none, no
    surviving cell has fewer than ``k`` surviving neighbours -- the unique
    fixpoint.  Global iterations are the number of times a cascade crosses a
    tile border, not the number of peel rounds.  Cells are stored and shuffled as
    words (``cell_words``) of at most ``PEEL_BITS`` columns.
    """
    spark = cells.sparkSession
    lineage = Lineage(spark, 1)
    bits = PEEL_BITS
    state = lineage.cut(cell_words(cells, r, c, bits), force=True)
    total = state.agg(F.sum(F.bit_count("mask"))).first()[0] or 0
    limit = max(1, min(cells_per_tile, math.ceil(total / spark.sparkContext.defaultParallelism)))
    if base_level(limit) < bits.bit_length() - 1:       # a word lies within one base square
        state, bits = cell_rows(state, bits), 1 << base_level(limit)
        state = lineage.cut(cell_words(state, "r", "c", bits), force=True)
    base, tiles = tile_map(state.withColumn("c", F.col("w") * bits), limit, F.sum(F.bit_count("mask")))
    tiles = lineage.cut(tiles, force=True)
    squares = lambda r, w: [x.alias(n) for x, n in zip(_square(base, r, w * bits), ("br", "bc"))]
    own = lineage.cut(state.select("r", "w", "mask", *squares(F.col("r"), F.col("w"))).join(tiles, ["br", "bc"]).select(
        "r", "w", "mask", *TILE, F.lit(True).alias("own")), force=True)
    # a cell also goes to the tiles of the places next to it; only places in other base squares can be in one
    near = own.select("r", "w", "mask", F.struct(*TILE).alias("_home"), F.explode(_way_array(_lanes(offsets, bits))).alias("_way")) \
        .select("r", "w", F.col("mask").bitwiseAND(F.col("_way.reach")).alias("mask"), "_home", *squares(
            F.col("r") + F.col("_way.dr"), F.col("w") + F.col("_way.dw")))
    br, bc = squares(F.col("r"), F.col("w"))
    halo = lineage.cut(
        near.where((F.col("mask") != 0) & ((F.col("br") != br) | (F.col("bc") != bc)))
        .groupBy("r", "w", "_home", "br", "bc").agg(F.bit_or("mask").alias("mask")).join(tiles, ["br", "bc"])
        .where(F.struct(*TILE) != F.col("_home")).groupBy("r", "w", *TILE).agg(F.bit_or("mask").alias("mask"))
        .select("r", "w", "mask", *TILE, F.lit(False).alias("own")), force=True)

    def without(words: DataFrame, gone: DataFrame) -> DataFrame:
        gone = gone.groupBy("r", "w").agg(F.bit_or("mask").alias("_gone"))
        return words.join(gone, ["r", "w"], "left").withColumn("mask", F.col("mask").bitwiseAND(
            F.bitwise_not(F.coalesce("_gone", F.lit(0).cast("bigint"))))).where(F.col("mask") != 0).drop("_gone")

    removed, last = None, None
    for _ in range(max_iter):
        rows = own.unionByName(halo)
        if last is not None:
            active = halo.join(last.select("r", "w", F.col("mask").alias("_gone")), ["r", "w"]) \
                .where(F.col("mask").bitwiseAND(F.col("_gone")) != 0).select(*TILE).distinct()
            rows = without(rows.join(active, list(TILE), "left_semi"), removed)
        last = lineage.cut(rows.groupBy(*TILE).applyInPandas(_local_peel(k, offsets, bits), "r long, w long, mask long"),
                           force=True)
        if last.isEmpty():
            left = state if removed is None else without(state, removed)
            return cell_rows(left, bits).select(F.col("r").alias(r), F.col("c").alias(c))
        removed = last if removed is None else removed.unionByName(last)
    raise RuntimeError("blocked peel did not converge")


def _advance(n_levels: int, width: int, sums: bool):
    """Advance one block's beams by up to ``n_levels`` levels; rows of the block's own columns."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = key[0] * width
        level, col = group["level"].to_numpy(np.int64), group["col"].to_numpy(np.int64)
        is_beam = group["paths"].notna().to_numpy()
        first = key[1]
        at = col[is_beam]
        paths = np.array([int(v) for v in group["paths"].to_numpy()[is_beam]], object)
        level, col = level[~is_beam], col[~is_beam]
        out = []
        for lv in range(first + 1, first + n_levels + 1):
            hit = np.isin(at, col[level == lv])
            at = np.concatenate((at[~hit], at[hit] - 1, at[hit] + 1))
            if len(at):
                paths = np.concatenate((paths[~hit], paths[hit], paths[hit]))
                order = np.argsort(at, kind="stable")
                at, starts = np.unique(at[order], return_index=True)
                paths = np.add.reduceat(paths[order], starts) if sums else paths[order][starts]
            mine = (at >= own) & (at < own + width)
            out.append(pd.DataFrame({"level": lv, "col": at[mine], "paths": [Decimal(v) for v in paths[mine]]}))
        return pd.concat(out).astype({"level": "int64", "col": "int64"})

    return run


def _propagate(starts: DataFrame, splitters: DataFrame, last_level: int, level: str, col: str, sums: bool,
               block_levels: int, width: int) -> tuple[DataFrame, DataFrame]:
    """((level, col, paths) for levels 0..last_level, distinct splitters); all paths are 1 without ``sums``."""
    if not 0 < block_levels < width:
        raise ValueError("block_levels must be positive and below width")
    lineage = Lineage(starts.sparkSession, 1)
    sp = lineage.cut(splitters.select(F.col(level).cast("bigint").alias("level"), F.col(col).cast("bigint").alias("col"))
                     .where(F.col("col").isNotNull()).distinct(), force=True)
    paths = (F.count(F.lit(1)) if sums else F.lit(1)).cast("decimal(38,0)").alias("paths")
    front = lineage.cut(starts.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("bigint").alias("col"))
                        .agg(paths).select(F.lit(0).cast("bigint").alias("level"), "col", "paths"), force=True)
    levels = [front]
    for first in range(0, last_level, block_levels):
        n = min(block_levels, last_level - first)
        rows = front.unionByName(sp.where(F.col("level").between(first + 1, first + n))
                                 .withColumn("paths", F.lit(None).cast("decimal(38,0)")))
        # a column is sent to every block with a column that it can reach in n levels: one or two
        blocks = F.sequence(floor_div(F.col("col") - n, width), floor_div(F.col("col") + n, width))
        done = lineage.cut(rows.select("*", F.explode(blocks).alias("block"), F.lit(first).alias("first"))
                           .groupBy("block", "first").applyInPandas(
                               _advance(n, width, sums), "level bigint, col bigint, paths decimal(38,0)"), force=True)
        levels.append(done)
        front = done.where(F.col("level") == first + n)
    out = levels[0]
    for done in levels[1:]:
        out = out.unionByName(done)
    return out, sp


def layered_reach(starts: DataFrame, splitters: DataFrame, last_level: int, level: str = "level",
                  col: str = "col", block_levels: int = BLOCK_LEVELS, width: int = BLOCK_WIDTH) -> DataFrame:
    """Level-by-level propagation with branching, set semantics.

    ``starts`` holds the level-0 columns.  A beam arriving at a splitter of
    the next level branches to col-1 and col+1 (one branch event), otherwise
    it continues in its column; beams in one column merge.  Returns
    ``(level, n_beams, n_splits)`` for levels 1..last_level.

    Levels go in blocks: a beam moves at most one column a level, so a range of
    ``width`` columns with ``block_levels`` columns on either side tells all of
    its own beams for ``block_levels`` levels.  One shuffle and one written
    table do for that many levels, and a task holds at most ``width +
    2 * block_levels`` columns of them.  Null columns are left out.  No level,
    no rows.
    """
    hist, sp = _propagate(starts, splitters, last_level, level, col, False, block_levels, width)
    beams = hist.where(F.col("level") > 0).groupBy("level").agg(F.count(F.lit(1)).cast("bigint").alias("n_beams"))
    hits = hist.select((F.col("level") + 1).alias("level"), "col").join(sp, ["level", "col"], "left_semi") \
        .groupBy("level").agg(F.count(F.lit(1)).cast("bigint").alias("n_splits"))
    return beams.join(hits, "level", "left").select(
        "level", "n_beams", F.coalesce("n_splits", F.lit(0).cast("bigint")).alias("n_splits"))


def layered_path_counts(starts: DataFrame, splitters: DataFrame, last_level: int, level: str = "level",
                        col: str = "col", block_levels: int = BLOCK_LEVELS, width: int = BLOCK_WIDTH) -> DataFrame:
    """U16: number of distinct paths reaching each (level, col).

    Same propagation as ``layered_reach`` with sum semantics: a splitter
    sends its incoming count both ways.  Counts are DECIMAL(38,0) (they grow
    exponentially with depth) and more digits are an error.  Returns
    ``(level, col, paths)`` for levels 1..last_level.
    """
    hist, _ = _propagate(starts, splitters, last_level, level, col, True, block_levels, width)
    return hist.where(F.col("level") > 0)
