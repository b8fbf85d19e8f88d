"""SimHash fingerprints and near-duplicate classes by pigeonring filtering.

A fingerprint has a bit set where over half the 64-bit hashes of a text's word
shingles have it.  Two fingerprints link when they differ in at most ``budget``
bits; a document's class is the smallest id that links can reach.

Equal fingerprints are one row from the start.  Their bits are cut into a ring of
``budget`` + 1 segments.  If two fingerprints link, the ring has a segment from which
every chain of the next 1, 2, 3, ... segments stays within its proportional budget
(the pigeonring principle): a chain of l segments differs in at most
floor(l * budget / segments) bits.  So for each start:

1. A fingerprint gives the bits of its first ``chain`` segments as its key, and asks
   for every key that differs from its own within the budgets of the chain's
   prefixes: an equi join finds the candidates.  The chain has two segments, or as
   many as it takes for a key to hold ``BUCKET`` / 4 random fingerprints on average.
2. Candidates must keep the budgets of all longer chains in turn; the last, the
   whole ring, is the full Hamming check.
3. A key that more than ``BUCKET`` fingerprints give is not joined, for its pairs
   would grow with its square.  Fingerprints that give it or ask for it send every
   value within half the budget instead; two that link share such a value, as there
   is one half-way, and each is linked with the smallest id that sent it.  (With an
   odd budget values go one bit further, and meet the smallest id that sent them
   from within the lesser half.)  That makes the same classes from a number of rows that is
   proportional to the fingerprints.  A value is sent by no more fingerprints than
   lie around it (2,081 for a budget of 4).

No cap and no sample: every link is either found or its ends are joined through a
common value.  Classes come from ``connected_components``.

Defined cases: a null or word-free text has the fingerprint zero, linked like any
other; a text of fewer than ``width`` words is one shingle; rows with a null id have
a fingerprint but a null class and no part in links; rows with equal ids are one
node; very long texts are hashed in slices; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm import columnar as C
from stratum.operators.graphs import connected_components
from stratum.plans import Lineage

WIDTH, BUDGET, SEED = 4, 4, 42
BITS = 64
BUCKET = 64            # fingerprints with one key that are joined as pairs
SLICE = 1 << 16        # shingles whose bits are counted at once


def shingle_hashes(text: bytes, width: int = WIDTH, seed: int = SEED) -> np.ndarray:
    """XXH64 of each ``width``-word shingle of a lower-cased text, joined by single spaces."""
    words = text.split()        # the same six bytes as WORD_BYTES
    if not words:
        return np.zeros(0, np.uint64)
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    stops = ends[width - 1:] if len(words) >= width else ends[-1:]
    starts = np.concatenate(([0], ends[:len(stops) - 1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist())),
                       np.uint64, len(stops))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of ``hashes``, as an unsigned number."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        bits = np.unpackbits(hashes[at:at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""
    lower = bytes(C.LOWER)

    def run(batches):
        for batch in batches:
            out = [fingerprint(shingle_hashes(t.as_buffer().to_pybytes().translate(lower) if t.is_valid else b"",
                                              width, seed)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, "doc_id bigint, fp bigint")


def ring(budget: int) -> list[int]:
    """Lengths of the segments of the ring, in bits."""
    m = budget + 1
    return [BITS * (k + 1) // m - BITS * k // m for k in range(m)]


def allowed(length: int, segments: int, budget: int) -> int:
    """Bits in which a chain of ``length`` segments may differ."""
    return length * budget // segments


def chain_masks(sizes: list[int], chain: int, budget: int) -> list[int]:
    """Every difference of a chain of segments (first one highest) that keeps the budgets of its prefixes."""
    total = sum(sizes[:chain])
    ends = np.cumsum(sizes[:chain]).tolist()
    out = []
    for flips in range(allowed(chain, len(sizes), budget) + 1):
        for at in combinations(range(total), flips):
            if all(sum(p < e for p in at) <= allowed(k + 1, len(sizes), budget) for k, e in enumerate(ends)):
                out.append(sum(1 << (total - 1 - p) for p in at))
    return out


def _turned(fp: Column, by: int) -> Column:
    """``fp`` with its bits turned left by ``by``."""
    return fp if by % BITS == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _longs(values) -> Column:
    return F.array(*[F.lit(int(np.uint64(v).astype(np.int64))) for v in values])


def _starts(nodes: DataFrame, budget: int, chain: int, masks: bool) -> DataFrame:
    """(start, key, node, fp): the keys that fingerprints give, or with ``masks`` those that they ask for."""
    sizes, parts = ring(budget), []
    for k in range(len(sizes)):
        turned_sizes = sizes[k:] + sizes[:k]
        key = F.shiftrightunsigned(_turned(F.col("fp"), sum(sizes[:k])), BITS - sum(turned_sizes[:chain]))
        part = nodes.select(F.lit(k).alias("start"), key.alias("key"), "node", "fp")
        if masks:
            mask = F.explode(_longs(chain_masks(turned_sizes, chain, budget))).alias("mask")
            part = part.select("*", mask).withColumn("key", F.col("key").bitwiseXOR(F.col("mask"))).drop("mask")
        parts.append(part)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _within(budget: int, chain: int) -> Column:
    """Whether ``fp`` and ``other`` keep the budgets of all chains longer than ``chain`` from ``start``, shortest first."""
    sizes, test = ring(budget), None
    for k in range(len(sizes)):
        turned_sizes = sizes[k:] + sizes[:k]
        diff = _turned(F.col("fp").bitwiseXOR(F.col("other")), sum(sizes[:k]))
        keeps = F.lit(True)
        for length in range(chain + 1, len(sizes) + 1):
            bits = F.shiftrightunsigned(diff, BITS - sum(turned_sizes[:length])) if length < len(sizes) else diff
            keeps = keeps & (F.bit_count(bits) <= allowed(length, len(sizes), budget))
        test = F.when(F.col("start") == k, keeps) if test is None else test.when(F.col("start") == k, keeps)
    return test


def links(nodes: DataFrame, lineage: Lineage, budget: int = BUDGET, bucket: int = BUCKET,
          chain: int | None = None) -> DataFrame:
    """(a, b) of ``nodes`` (node, fp; each fp once) whose closure is that of all links."""
    sizes = ring(budget)
    if chain is None:
        bits = max(nodes.count(), 1).bit_length()
        least = bits - max(bucket // 4, 1).bit_length() + 1
        chain = next((k for k in range(2, len(sizes)) if sum(sizes[:k]) >= least), len(sizes) - 1)
    given = _starts(nodes, budget, chain, False)
    asked = _starts(nodes, budget, chain, True)
    hot = lineage.cut(given.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n"))
                      .filter(F.col("n") > bucket).drop("n"), force=True)
    crowded = not hot.isEmpty()
    cold = given.join(hot, ["start", "key"], "left_anti") if crowded else given
    pairs = asked.join(cold.select("start", "key", F.col("node").alias("b"), F.col("fp").alias("other")),
                       ["start", "key"]) \
        .filter((F.col("node") < F.col("b")) & _within(budget, chain)).select(F.col("node").alias("a"), "b").distinct()
    if not crowded:
        return pairs
    around = lineage.cut(asked.join(hot, ["start", "key"], "left_semi").select("node", "fp").distinct(), force=True)
    # every value within half the budget: flip up to so many bits, each at a lower place than the one before
    ball = around.select("node", F.col("fp").alias("value"), F.lit(BITS).alias("below"), F.lit(0).alias("flips"))
    sent = ball
    for flips in range(1, (budget + 1) // 2 + 1):
        ball = ball.filter(F.col("below") > 0).select("node", "value", F.explode(
            F.sequence(F.lit(0), F.col("below") - 1)).alias("below"), F.lit(flips).alias("flips")) \
            .withColumn("value", F.expr("value ^ shiftleft(1L, below)"))
        sent = sent.unionByName(ball)
    least = F.min(F.when(F.col("flips") <= budget // 2, F.col("node"))).over(Window.partitionBy("value"))
    near = sent.select("node", least.alias("a")).filter(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))
    return pairs.unionByName(near.distinct())


def simhash_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                    budget: int = BUDGET, seed: int = SEED, bucket: int = BUCKET,
                    chain: int | None = None) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id) of every row of ``docs``."""
    if not 0 < budget < BITS - 1:
        raise ValueError("budget must be between 1 and 62")
    lineage = Lineage(docs.sparkSession, 1)
    rows = lineage.cut(fingerprints(docs, doc_id, text, width, seed), force=True)
    nodes = lineage.cut(rows.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")),
                        force=True)
    # an id with several texts ties its fingerprints together
    tied = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter(F.col("lo") != F.col("hi")).select("doc_id")
    numbered = nodes.withColumnRenamed("node", "least").withColumn("node", F.monotonically_increasing_id())
    numbered = lineage.cut(numbered, force=True)
    edges = links(numbered.select("node", "fp"), lineage, budget, bucket, chain)
    same = rows.join(tied, "doc_id", "left_semi").join(numbered, "fp").select("doc_id", "node").distinct()
    first = same.groupBy("doc_id").agg(F.min("node").alias("a"))
    edges = edges.unionByName(same.join(first, "doc_id").filter(F.col("node") != F.col("a"))
                              .select("a", F.col("node").alias("b")))
    classes = lineage.cut(connected_components(edges, "a", "b", numbered.select("node"), "node"), force=True)
    named = classes.join(numbered, "node")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_fp = lineage.cut(named.join(smallest, "component").select("fp", "component_id"), force=True)
    return rows.join(of_fp, "fp", "left").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
