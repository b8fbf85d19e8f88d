"""Exact n-gram Jaccard self-join with a token-group matrix.

A document's set holds the hashes of its distinct word ``width``-shingles.  Two
sets link when 100 * |A and B| >= ``percent`` * |A or B|.  The result names for
each document the smallest document id that links can reach.

Equal sets are one class from the start and cost one row each.  Between classes:

1. Screen.  With slack s = n - ceil(percent * n / 100), the 2s + 1 smallest
   hashes of a set form its prefix.  Linked sets share more than the slack of
   the smaller one inside both prefixes, so a set whose prefix meets fewer
   shared tokens links with nothing.  Prefixes are shuffled as blobs by token
   bucket.  A token that several sets of one task hold is settled in that task
   and sent once, so a passage in a third of all documents makes no hot bucket.
2. Groups.  The surviving sets are partitioned into groups of similar sets:
   in each of ``BANDS`` min-hash bands, the most central set of a key leads,
   and a set joins the group of a leader with which it verifiably links.
3. Matrix.  For every token, the groups whose token union holds it.  A set can
   only link outside its group through tokens of at least two groups; if it has
   fewer of them than a link needs, it is done.  Of the others, the tokens in
   the fewest groups (as many as the slack allows, and one) name the
   groups to ask, where they are among the same few of a member; the set of the
   smaller group asks the larger one, and of two small groups the smaller set.
4. Bound and open.  Groups are stored in parts of about ``PART`` sets (of the
   root of their number, if that is more), small groups of similar sets together.  A part's union bounds the overlap of a
   query with each member; only a part that can reach the threshold is opened,
   and its members are compared exactly.  A set is compared only with members
   that no link found so far ties to it, and one link of each such component is
   kept.  Every set first asks one part of each home; its further parts are asked
   only where the links found by then leave a member outside its component.

Pairs inside a group are never listed, so thousands of copies of one text cost
thousands of comparisons, and a task makes fewer links than it has sets.  No step caps candidates; every filter is a necessary
condition of a link, so no link is lost.

Defined cases: a null or word-free text has an empty set, n_shingles 0, links
with nothing and is its own component; a text of fewer than ``width`` words has
one shingle, all of it; a row with a null id has its n_shingles, but a null
component and no part in links; equal rows share their class; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import columnar as C
from stratum.operators.graphs import connected_components
from stratum.plans import Lineage

WIDTH, PERCENT = 5, 80
BANDS, ASKS, PART = 16, 2, 64
BUCKET_BYTES = 8 << 20       # text per token bucket
FLUSH_TOKENS = 1 << 19       # prefix tokens a task holds before it sends them
ASK_TOKENS = 1 << 18         # tokens of queries that meet a group in one task
MAX_SCREEN_BITS = 26         # 8 MB
SETTLED = 0                  # marks a token that is known to be shared


def need(n, percent=PERCENT):
    """Least overlap of a set of n tokens with any set that it links to."""
    return -(-n * percent // 100)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk."""
    start, end, doc = C.spans(C.WORD_BYTES[buf], offs)
    words = C.span_hashes(C.LOWER[buf], start, end)
    edge = np.searchsorted(doc, np.arange(len(offs)))
    first = np.arange(max(0, len(words) - width + 1))
    grams = C.run_hashes(words, first, first + width)
    out = []
    for a, b in zip(edge[:-1], edge[1:]):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            out.append(C.run_hashes(words, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> int:
    """64-bit digest of a sorted set of tokens; never SETTLED."""
    if not len(tokens):
        return -1
    total = np.add.reduce(C.mix(tokens ^ np.uint64(0xA0761D6478BD642F)), keepdims=True)
    return int(C.mix(total ^ np.uint64(len(tokens))).view(np.int64)[0]) or 1


def _sets(batches, column: int, width: int):
    for batch in batches:
        buf, offsets = C.text_bytes(batch.column(column))
        for lo, hi in C.chunks(offsets):
            yield batch.slice(lo, hi - lo), shingle_sets(
                buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width)


def document_classes(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(doc_id, text_key, set_id, n) of every document."""

    def run(batches):
        for part, sets in _sets(batches, 2, width):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "text_key", "set_id", "n"])

    return docs.select(F.col(doc_id).cast("bigint"), F.xxhash64(text), text) \
        .mapInArrow(run, "doc_id bigint, text_key bigint, set_id bigint, n bigint")


def _blobs(tokens: np.ndarray, owners: np.ndarray, buckets: int):
    """Per bucket: (bucket, owners, run lengths, tokens) of pairs that are ordered by owner."""
    bucket = ((tokens & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint32)
    if buckets < 1 << 16:
        bucket = bucket.astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    bucket, tokens, owners = bucket[order], tokens[order], owners[order]
    edge = np.append(C.run_starts(bucket), len(bucket))
    rows = [], [], [], []
    for a, b in zip(edge[:-1], edge[1:]):
        first = C.run_starts(owners[a:b])
        rows[0].append(int(bucket[a]))
        rows[1].append(owners[a:b][first].tobytes())
        rows[2].append(np.diff(np.append(first, b - a)).astype(np.uint32).tobytes())
        rows[3].append(tokens[a:b].tobytes())
    return rows


def _unblob(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    owners = np.frombuffer(b"".join(group["owners"]), np.int64)
    runs = np.frombuffer(b"".join(group["runs"]), np.uint32)
    return np.frombuffer(b"".join(group["tokens"]), np.uint64), np.repeat(owners, runs)


def _distinct_pairs(tokens: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (token, owner) pairs, in token order, of tokens that come more than once."""
    order = np.argsort(tokens)
    tokens, owners = tokens[order], owners[order]
    first = C.run_starts(tokens)
    many = np.repeat(np.diff(np.append(first, len(tokens))) > 1, np.diff(np.append(first, len(tokens))))
    tokens, owners = tokens[many], owners[many]
    order = np.lexsort((owners, tokens))
    tokens, owners = tokens[order], owners[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
    return tokens[new], owners[new]


BLOBS = "bucket bigint, owners binary, runs binary, tokens binary"
_BLOB_NAMES = ["bucket", "owners", "runs", "tokens"]


def _blob_batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int64()), *[pa.array(r, pa.binary()) for r in rows[1:]]], names=_BLOB_NAMES)


def shared_in_prefix(docs: DataFrame, text: str, width: int, percent: int, buckets: int) -> DataFrame:
    """(set_id, shared): how many of a set's prefix tokens other prefixes hold (or more)."""

    def send(held):
        tokens, owners = np.concatenate([t for t, _ in held]), \
            np.repeat(np.array([i for _, i in held], np.int64), [len(t) for t, _ in held])
        held.clear()
        order = np.argsort(tokens, kind="stable")
        first = C.run_starts(tokens[order])
        size = np.diff(np.append(first, len(tokens)))
        local = np.zeros(len(tokens), bool)
        local[order] = np.repeat(size > 1, size)
        counted, n = np.unique(owners[local], return_counts=True)
        known = tokens[order][first[size > 1]]
        yield _blob_batch(_blobs(np.concatenate((known, tokens[~local])),
                                 np.concatenate((np.full(len(known), SETTLED), owners[~local])), buckets))
        if len(counted):      # settled here: these counts only pass through
            yield _blob_batch(([int(counted[0]) % buckets], [counted.tobytes()], [n.astype(np.uint32).tobytes()], [b""]))

    def run(batches):
        held, seen, size = [], set(), 0
        for _, sets in _sets(batches, 0, width):
            for s in sets:
                i = set_id(s)
                if len(s) and i not in seen:
                    seen.add(i)
                    prefix = s[:2 * (len(s) - need(len(s), percent)) + 1]
                    held.append((prefix, i))
                    size += len(prefix)
            if size >= FLUSH_TOKENS:
                yield from send(held)
                held, seen, size = [], set(), 0
        if held:
            yield from send(held)

    def count(group: pd.DataFrame) -> pd.DataFrame:
        passed = group["tokens"].str.len() == 0
        tokens, owners = _distinct_pairs(*_unblob(group[~passed]))
        first = C.run_starts(tokens)
        size = np.diff(np.append(first, len(tokens)))
        settled = np.logical_or.reduceat(owners == SETTLED, first) if len(first) else np.zeros(0, bool)
        shared = np.repeat((size > 1) | settled, size) & (owners != SETTLED)
        ids = np.concatenate((owners[shared], np.frombuffer(b"".join(group.loc[passed, "owners"]), np.int64)))
        n = np.concatenate((np.ones(shared.sum(), np.int64),
                            np.frombuffer(b"".join(group.loc[passed, "runs"]), np.uint32).astype(np.int64)))
        ids, n = summed(ids, n)
        chunk = (ids.view(np.uint64) % np.uint64(chunks)).astype(np.int64)
        order = np.argsort(chunk, kind="stable")
        ids, n, chunk = ids[order], n[order], chunk[order]
        edge = np.append(C.run_starts(chunk), len(chunk))
        return pd.DataFrame([(chunk[a], ids[a:b].tobytes(), n[a:b].tobytes()) for a, b in zip(edge[:-1], edge[1:])],
                            columns=["chunk", "ids", "counts"])

    def summed(ids, n):
        ids, at = np.unique(ids, return_inverse=True)
        return ids, np.bincount(at, n, len(ids)).astype(np.int64)

    def total(group: pd.DataFrame) -> pd.DataFrame:
        ids, n = summed(np.frombuffer(b"".join(group["ids"]), np.int64),
                        np.frombuffer(b"".join(group["counts"]), np.int64))
        return pd.DataFrame({"set_id": ids, "shared": n})

    chunks = -(-buckets // 4)
    return docs.select(text).mapInArrow(run, BLOBS).groupBy("bucket") \
        .applyInPandas(count, "chunk bigint, ids binary, counts binary").groupBy("chunk") \
        .applyInPandas(total, "set_id bigint, shared bigint")


def surviving_sets(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """(set_id, n, tokens, bands) of the chosen documents (doc_id, text_key)."""
    seeds = C.mix(np.arange(1, BANDS + 1, dtype=np.uint64))

    def run(batches):
        for _, sets in _sets(batches, 0, width):
            sets = [s for s in sets if len(s)]
            bands = [[int((C.mix(s ^ seed).min() ^ seed).view(np.int64)) for seed in seeds] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["set_id", "n", "tokens", "bands"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       F.col(text).alias("text"))
    # the list of survivors grows with the input: it is never broadcast, at any size
    return rows.join(chosen.hint("merge"), ["doc_id", "text_key"], "left_semi") \
        .select("text").mapInArrow(run, "set_id bigint, n bigint, tokens binary, bands array<bigint>")


def leaders_to_ask(sets: DataFrame) -> DataFrame:
    """(set_id, leader): the leaders that share most bands with a set, the more central first."""
    bands = sets.select("set_id", F.explode("bands").alias("band")).distinct()
    sizes = bands.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    met = bands.join(sizes, "band")
    central = met.groupBy("set_id").agg(F.sum("size").alias("central"))
    met = met.join(central, "set_id")
    lead = met.groupBy("band").agg(F.max(F.struct("central", "set_id")).alias("lead"))
    votes = met.join(lead, "band").filter(F.col("lead.set_id") != F.col("set_id")) \
        .groupBy("set_id", F.col("lead.set_id").alias("leader")) \
        .agg(F.count(F.lit(1)).alias("votes"), F.first("lead.central").alias("central"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("votes", "central", "leader")), asc=False), 1, ASKS)
    return votes.groupBy("set_id").agg(best.alias("best")) \
        .select("set_id", F.explode("best.leader").alias("leader"))


def new_links(q: pd.DataFrame, m: pd.DataFrame, percent: int) -> tuple[list[int], list[int]]:
    """Links (a, b) between labels that tie the queries to the members of one part.

    The union of the part bounds the overlap; only a part that can qualify is opened.  A query is
    compared with the members outside its component, and a link that joins nothing new is not made.
    """
    out = [], []
    names, codes = np.unique(np.concatenate((q["label"], m["label"])).astype(np.int64), return_inverse=True)
    asking, held = codes[:len(q)], codes[len(q):]            # components so far
    sizes = m["n"].to_numpy(np.int64)
    tokens = np.frombuffer(b"".join(m["tokens"]), np.uint64)
    order = np.argsort(tokens)
    whole = tokens[order], np.repeat(np.arange(len(m)), sizes)[order]
    lengths, blobs, own = q["n"].to_numpy(np.int64), q["tokens"].to_numpy(), codes[:len(q)].copy()
    mine = -1
    for i in np.argsort(asking, kind="stable"):
        apart = held != asking[i]
        left = np.count_nonzero(apart)
        if not left:
            continue
        if asking[i] != mine:
            mine, (tokens, owner), indexed = asking[i], whole, len(m)
        if 2 * left <= indexed:
            keep = apart[owner]
            tokens, owner, indexed = tokens[keep], owner[keep], left
        n, set_tokens = lengths[i], np.frombuffer(blobs[i], np.uint64)
        lo, hi = np.searchsorted(tokens, set_tokens, "left"), np.searchsorted(tokens, set_tokens, "right")
        found = hi > lo
        if found.sum() < need(n, percent):                    # the bound: the part stays shut
            continue
        lo, reps = lo[found], (hi - lo)[found]
        place = np.repeat(lo - np.cumsum(reps) + reps, reps) + np.arange(reps.sum())
        both = np.bincount(owner[place], minlength=len(m))
        linked = apart & (100 * both >= percent * (n + sizes - both))
        while linked.any():
            j = linked.argmax()
            out[0].append(names[own[i]])
            out[1].append(m["label"].iat[j])
            joined = held[j]
            held[held == joined] = mine
            asking[asking == joined] = mine
            linked &= held != mine
    return out


def open_groups(asks: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the labels of queries and of members of the parts they ask (set_id, label, part).

    Labels are joined wherever a link joins them; of the links in a part a spanning forest comes out.
    """
    body = sets.select("set_id", "n", "tokens")
    asks = asks.select("set_id", "label", "part").distinct()
    asked = asks.join(sets.select("set_id", "n"), "set_id").groupBy("part") \
        .agg(F.ceil(F.sum("n") / ASK_TOKENS).cast("int").alias("salts"))
    queries = asks.join(asked, "part").join(body, "set_id") \
        .select("part", F.pmod(F.xxhash64("set_id"), F.col("salts")).cast("int").alias("salt"),
                F.lit(True).alias("asks"), "label", "n", "tokens")
    held = members.select("set_id", "label", "part").distinct().join(asked, "part").join(body, "set_id") \
        .select("part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                F.lit(False).alias("asks"), "label", "n", "tokens")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        q, m = group[group["asks"]], group[~group["asks"]]
        a, b = new_links(q, m, percent) if len(q) and len(m) else ([], [])
        return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})

    return queries.unionByName(held).groupBy("part", "salt").applyInPandas(compare, "a bigint, b bigint")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(set_id, label) after links (a, b) between labels."""
    found = connected_components(links, "a", "b", node="label")
    return labels.join(found, "label", "left").select("set_id", F.coalesce("component", "label").alias("label"))


def first_asks(asks: DataFrame) -> DataFrame:
    """One part of each home for every query; sets of one home begin with different parts."""
    return asks.groupBy("set_id", "label", "home") \
        .agg(F.min_by("part", F.xxhash64("set_id", "part")).alias("part")).select("set_id", "label", "part").distinct()


def asks_left(asks: DataFrame, done: DataFrame, members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The asks not done whose part has a member outside the query's component, and the members, under new labels."""
    members = members.select("set_id", "part").join(labels, "set_id")
    held = members.groupBy("part").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = asks.select("set_id", "part").distinct().join(done.select("set_id", "part"), ["set_id", "part"], "left_anti")
    return left.join(labels, "set_id").join(held, "part") \
        .filter((F.col("low") != F.col("label")) | (F.col("high") != F.col("label"))) \
        .select("set_id", "label", "part"), members


def foreign_tokens(sets: DataFrame, buckets: int) -> DataFrame:
    """(token, n_groups) of the tokens in the unions of at least two groups."""

    def run(batches):
        held, size = [], 0

        def send():
            tokens = np.concatenate([t for t, _ in held])
            groups = np.repeat(np.array([g for _, g in held], np.int64), [len(t) for t, _ in held])
            held.clear()
            order = np.lexsort((tokens, groups))
            tokens, groups = tokens[order], groups[order]
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (groups[1:] != groups[:-1])
            return _blob_batch(_blobs(tokens[new], groups[new], buckets))

        for batch in batches:
            for g, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((np.frombuffer(blob, np.uint64), g))
                size += len(held[-1][0])
                if size >= FLUSH_TOKENS:
                    yield send()
                    held, size = [], 0
        if held:
            yield send()

    def count(group: pd.DataFrame) -> pd.DataFrame:
        tokens, _ = _distinct_pairs(*_unblob(group))
        first = C.run_starts(tokens)
        n = np.diff(np.append(first, len(tokens)))
        return pd.DataFrame({"token": tokens[first[n > 1]].view(np.int64), "n_groups": n[n > 1]})

    return sets.select("label", "tokens").mapInArrow(run, BLOBS).groupBy("bucket") \
        .applyInPandas(count, "token bigint, n_groups bigint")


def open_sets(sets: DataFrame, foreign: DataFrame, percent: int) -> DataFrame:
    """(set_id, label, n, foreign): sets with enough foreign tokens for a link, rarest tokens first."""
    # eight slots to a token, and MAX_SCREEN_BITS at most; a fuller screen lets more rows through, and loses none
    bits = min(max(foreign.count().bit_length() + 3, 16), MAX_SCREEN_BITS)
    shift, packed = 64 - bits, C.screen_of(foreign.select("token"), bits)

    def run(batches):
        screen, held, size = C.screen_bits(packed), [], 0

        def send():
            i, label, n, tokens = zip(*held)
            reps = [len(t) for t in tokens]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(x, np.int64), reps)) for x in (i, label, n)]
                + [pa.array(np.concatenate(tokens).view(np.int64))], names=["set_id", "label", "n", "token"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                for i, label, n, blob in zip(*[c.to_pylist() for c in batch.slice(at, 128).columns]):
                    tokens = np.frombuffer(blob, np.uint64)
                    hit = tokens[screen[tokens >> np.uint64(shift)]]
                    if len(hit) >= need(n, percent):
                        held.append((i, label, n, hit))
                        size += len(hit)
                    if size >= 1 << 15:
                        yield send()
                        held, size = [], 0
        if held:
            yield send()

    rows = sets.select("set_id", "label", "n", "tokens").mapInArrow(
        run, "set_id bigint, label bigint, n bigint, token bigint").join(foreign, "token")
    return rows.groupBy("set_id").agg(
        F.first("label").alias("label"), F.first("n").alias("n"),
        F.array_sort(F.collect_set(F.struct("n_groups", "token"))).alias("foreign")) \
        .filter(F.size("foreign") >= F.ceil(F.col("n") * percent / 100))


def groups_to_ask(opened: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(asks, members): queries (set_id, label, home, part) and the parts (set_id, label, part) that hold the open sets.

    A large group is stored in parts of its own.  Sets of small groups share parts with sets
    that have the same smallest foreign token, so that near misses of one text lie together.
    Of two large groups the smaller asks the larger and small groups ask large ones; among the
    shared parts a set asks for sets that are no smaller.  Parts grow with the root of what they
    hold, so a family of n near misses that no leader holds together has at most sqrt(n) of them.

    Tokens have one order, the rarest first.  The first token that two linked sets share leaves
    each of them room for the whole overlap, so it lies in the prefix of both: with an overlap of
    o, among the first n - o + 1 tokens.  An overlap is at least ``least``, and with a set that is no
    smaller at least ``least_up``.
    """
    sizes = opened.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    sets = opened.join(sizes, "label").withColumn("tokens", F.col("foreign.token"))
    large = F.col("size") >= PART // 2
    home = F.when(large, F.col("label")).otherwise(F.array_min("tokens"))
    sets = sets.withColumn("home", home).withColumn("kind", large.cast("int"))
    held = F.count(F.lit(1))
    rooms = sets.groupBy("kind", "home").agg(F.ceil(held / F.greatest(F.lit(PART), F.sqrt(held))).cast("int").alias("rooms"))
    part = lambda k: F.xxhash64("kind", "home", k)
    sets = sets.join(rooms, ["kind", "home"]) \
        .withColumn("part", part(F.pmod(F.xxhash64("set_id"), F.col("rooms")).cast("int")))
    members = sets.select("set_id", "label", "part")
    least = F.ceil(F.col("n") * percent / 100)
    least_up = F.ceil(F.col("n") * 2 * percent / (100 + percent))
    # the tokens that are not foreign come before all others: they meet no other group
    prefix = lambda o: F.explode(F.slice(
        "tokens", F.lit(1), F.greatest(F.size("tokens") - o + 1, F.lit(0)).cast("int"))).alias("token")
    asking = sets.select("set_id", "label", F.struct("size", "label").alias("own"), prefix(least))
    unions = sets.filter(F.col("kind") == 1).select(
        F.struct("size", "label").alias("group"), "rooms", "kind", "home", prefix(least)).distinct()
    up = asking.join(unions, "token").filter(F.col("group") > F.col("own")) \
        .select("set_id", "label", "kind", "home", "rooms").distinct() \
        .select("set_id", "label", "kind", "home", F.explode(F.sequence(F.lit(0), F.col("rooms") - 1)).alias("k")) \
        .select("set_id", "label", "home", part(F.col("k")).alias("part"))
    small = sets.filter(F.col("kind") == 0)
    shared = small.select("part", "home", "n", F.col("label").alias("other"), prefix(least)).groupBy("part", "home", "token") \
        .agg(F.min("n").alias("shortest"), F.max("n").alias("tallest"), F.min("other").alias("low"), F.max("other").alias("high"))
    foreign = (F.col("low") != F.col("label")) | (F.col("high") != F.col("label"))
    rising = (F.col("tallest") > F.col("n")) | ((F.col("tallest") == F.col("n")) & (F.col("part") >= F.col("own_part")))
    across = small.select("set_id", "label", "n", F.col("part").alias("own_part"), prefix(least_up)).join(shared, "token") \
        .filter(foreign & rising & (F.col("shortest") * percent <= F.col("n") * 100)) \
        .select("set_id", "label", "home", "part").distinct()
    return up.unionByName(across), members


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, set_id, text_key, class_id) of every document.

    ``class_id`` tells classes apart whose ids are the same (rows with equal ids and other texts).
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    spark = docs.sparkSession
    lineage = Lineage(spark, every=1)
    cut = lambda df: lineage.cut(df, force=True)
    known = docs.filter(F.col(doc_id).isNotNull())
    all_docs = cut(document_classes(docs, doc_id, text, width))
    classes = cut(all_docs.filter((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.first("n").alias("n")))
    size = known.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    least = F.ceil(F.col("n") * percent / 100)
    shared = shared_in_prefix(known, text, width, percent, buckets)
    survivors = cut(classes.join(shared, "set_id").filter(
        F.col("shared") >= least - F.ceil(least * percent / 100) + 1).select("rep.doc_id", "rep.text_key"))
    sets = cut(surviving_sets(known, survivors, doc_id, text, width))

    asks = cut(leaders_to_ask(sets))
    leads = asks.select(F.col("leader").alias("set_id"), F.col("leader").alias("label"), F.col("leader").alias("part"))
    alone = sets.select("set_id", F.col("set_id").alias("label")).distinct()
    asks = asks.select("set_id", F.col("set_id").alias("label"), F.col("leader").alias("part"))
    labels = cut(merged(alone, cut(open_groups(asks, leads, sets, percent))))
    grouped = cut(sets.select("set_id", "n", "tokens").join(labels, "set_id"))
    foreign = cut(foreign_tokens(grouped, buckets))
    opened = cut(open_sets(grouped, foreign, percent))
    asks, members = (cut(x) for x in groups_to_ask(opened, percent))
    first = cut(first_asks(asks))
    labels = cut(merged(labels, cut(open_groups(first, members, sets, percent))))
    asks, members = asks_left(asks, first, members, labels)
    labels = cut(merged(labels, cut(open_groups(cut(asks), cut(members), sets, percent)))) \
        .withColumnRenamed("label", "component")

    reps = classes.select("set_id", F.col("rep.doc_id").alias("rep"))
    linked = labels.join(reps, "set_id")
    smallest = linked.groupBy("component").agg(F.min("rep").alias("least"))
    moved = linked.join(smallest, "component").select("set_id", "least", F.col("component").alias("class_id"))
    component = classes.select("set_id", F.col("rep.doc_id").alias("rep")).join(moved, "set_id", "left") \
        .select("set_id", F.coalesce("least", "rep").alias("component"), F.coalesce("class_id", "set_id").alias("class_id"))
    has_id = F.col("doc_id").isNotNull()
    return all_docs.join(component, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(has_id, F.coalesce("component", "doc_id")).alias("component_id"), "set_id", "text_key", "class_id")
