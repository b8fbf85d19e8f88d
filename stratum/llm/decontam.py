"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of ASCII letters and digits and of code points from U+0080 on,
lower-cased in ASCII.  A window is ``window`` consecutive words of a benchmark
item; an item with fewer words, but some, is one window.

The index is a table written by Spark.  Documents are dealt into shards of
about 2 MB of text as they are read; per shard it holds the documents' places
and, for each term, the sorted positions of the term in the shard (documents
are ``GAP`` positions apart, so no phrase runs from one into the next).  Terms
that no benchmark word can equal are left out by a bit screen over the term
hashes; the screen has a fixed size, so it may be sent to all tasks, and a
full one only makes the index larger, never wrong.

A query reads the corpus frequency of its terms from the index, drops windows
with a term that never occurs, and joins each window by its rarest term with
the shards that hold it.  In a shard the window's posting lists, shifted by
each term's offset, are intersected from the shortest on.  With ``slop`` > 0
the terms may stand up to that many positions apart in total, in order
(proximity instead of phrase).  Windows are dealt into blocks, so a task meets
one shard and a bounded part of the benchmark, however large that is.

Defined cases: a null or empty text has no words; a null id stays null, and a
null item id hits words but is not listed; equal rows are separate documents;
an empty benchmark leaves every document clean; an empty corpus gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import columnar as C
from stratum.plans import Lineage

WINDOW = 10
GAP = 1 << 12
SCREEN_BITS = 21
BLOCK_WINDOWS = 50_000
INDEX = ("shard bigint, term bigint, n bigint, positions array<bigint>, doc_ids array<bigint>, text_keys array<bigint>, "
         "lengths array<bigint>")


def _terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of every word."""
    start, end, doc = C.spans(C.ALNUM_BYTES[buf], offs)
    return doc, C.span_hashes(C.LOWER[buf], start, end).view(np.int64)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def _chunked(batches):
    for batch in batches:
        buf, offsets = C.text_bytes(batch.column(1))
        for lo, hi in C.chunks(offsets):
            yield batch.slice(lo, hi - lo), buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def windows_of(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item_id, window_id, terms) for each distinct window of each item."""
    if window >= GAP // 2:
        raise ValueError(f"window must be below {GAP // 2}")

    def run(batches):
        for part, buf, offs in _chunked(batches):
            doc, term = _terms(buf, offs)
            n_words = np.bincount(doc, minlength=part.num_rows)
            n_windows = np.where(n_words >= window, n_words - window + 1, np.minimum(n_words, 1))
            size = np.minimum(n_words, window)
            owner = np.repeat(np.arange(part.num_rows), n_windows)
            first = np.repeat(np.cumsum(n_words) - n_words, n_windows) \
                + np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
            size = size[owner]
            ids = C.run_hashes(term.view(np.uint64), first, first + size).view(np.int64)
            bounds = np.concatenate(([0], np.cumsum(size)))
            within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(owner)), pa.array(ids),
                 _lists(term[np.repeat(first, size) + within], bounds)],
                names=["item_id", "window_id", "terms"])

    return items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text)) \
        .mapInArrow(run, "item_id bigint, window_id bigint, terms array<bigint>") \
        .dropDuplicates(["item_id", "window_id"])


def term_screen(windows: DataFrame) -> np.ndarray:
    """Bits of the terms that occur in a window (2**SCREEN_BITS bits, packed)."""
    return C.screen_of(windows.select(F.explode("terms").alias("t")), SCREEN_BITS)


def positional_index(docs: DataFrame, lineage: Lineage, screen: np.ndarray, doc_id: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """The written index: a row of postings per shard and term, and a row of documents per shard."""

    def run(batches):
        from pyspark import TaskContext
        bits = C.screen_bits(screen)
        shard = TaskContext.get().partitionId() << 32
        names = [c.split()[0] for c in INDEX.split(", ")]
        empty = lambda n: pa.array([None] * n, pa.list_(pa.int64()))
        for part, buf, offs in _chunked(batches):
            doc, term = _terms(buf, offs)
            n_words = np.bincount(doc, minlength=part.num_rows).astype(np.int64)
            begin = np.cumsum(n_words + GAP) - n_words - GAP
            position = begin[doc] + np.arange(len(doc)) - (np.cumsum(n_words) - n_words)[doc]
            kept = bits[term.view(np.uint64) >> np.uint64(64 - SCREEN_BITS)]
            term, position = term[kept], position[kept]
            order = np.argsort(term, kind="stable")
            term, position = term[order], position[order]
            first = C.run_starts(term)
            bounds = np.append(first, len(term))
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([None], pa.int64()), pa.array([part.num_rows], pa.int64()),
                 empty(1), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([part.column(2).to_pylist()], pa.list_(pa.int64())), pa.array([n_words], pa.list_(pa.int64()))], names=names)
            for lo in range(0, len(first), 1 << 12):
                hi = min(lo + (1 << 12), len(first))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, shard)), pa.array(term[first[lo:hi]]),
                     pa.array(np.diff(bounds[lo:hi + 1])),
                     _lists(position[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo]),
                     empty(hi - lo), empty(hi - lo), empty(hi - lo)], names=names)
            shard += 1

    source = docs.select(F.col(doc_id).cast("bigint"), F.col(text), F.xxhash64(text))
    return lineage.cut(source.mapInArrow(run, INDEX), force=True)


def phrase_starts(lists: list[np.ndarray], slop: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) positions of each match of the terms with these posting lists, in order."""
    if slop == 0:
        order = sorted(range(len(lists)), key=lambda k: len(lists[k]))
        starts = lists[order[0]] - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            at = np.searchsorted(lists[k], starts + k)
            at[at == len(lists[k])] = 0
            starts = starts[lists[k][at] == starts + k]
        return starts, starts + len(lists) - 1
    starts = last = lists[0]
    for postings in lists[1:]:           # the nearest next place of each term
        at = np.searchsorted(postings, last, "right")
        fits = at < len(postings)
        starts, last = starts[fits], postings[at[fits]]
        near = last - starts < len(lists) + slop
        starts, last = starts[near], last[near]
    return starts, last


def find_windows(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(shard, doc_no, spans, window_ids): the words hit in each document, and by which windows.

    A match spans fewer words than documents are apart, so ``slop`` is below half of ``GAP``.
    """
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    texts = windows.dropDuplicates(["window_id"]).select("window_id", "terms")
    postings = index.filter(F.col("term").isNotNull())
    frequency = postings.groupBy("term").agg(F.sum("n").alias("frequency"))
    distinct_terms = F.size(F.array_distinct("terms"))
    rarest = texts.select("window_id", "terms", distinct_terms.alias("needed"),
                          F.explode(F.array_distinct("terms")).alias("term")) \
        .join(frequency, "term") \
        .groupBy("window_id").agg(F.min(F.struct("frequency", "term")).alias("rarest"), F.count(F.lit(1)).alias("n"),
                                  F.first("needed").alias("needed"), F.first("terms").alias("terms")) \
        .filter(F.col("n") == F.col("needed")).select("window_id", "terms", F.col("rarest.term").alias("term"))
    blocks = max(1, -(-texts.count() // BLOCK_WINDOWS))
    block = F.pmod(F.xxhash64("window_id"), F.lit(blocks)).alias("block")
    asked = postings.select("shard", "term").join(rarest, "term").select("shard", block, "window_id", "terms")
    needed = asked.select("shard", "block", F.explode("terms").alias("term")).distinct()
    lists = postings.select("shard", "term", "positions").join(needed, ["shard", "term"]) \
        .select("shard", "block", "term", "positions")
    places = index.filter(F.col("term").isNull()).select("shard", "lengths") \
        .join(asked.select("shard", "block").distinct(), "shard")

    def of_kind(df, kind, key, values):
        return df.select("shard", "block", F.lit(kind).alias("kind"), key.alias("key"), F.col(values).alias("values"))

    both = of_kind(places, 0, F.lit(0).cast("bigint"), "lengths") \
        .unionByName(of_kind(lists, 1, F.col("term"), "positions")) \
        .unionByName(of_kind(asked, 2, F.col("window_id"), "terms"))

    def match(group: pd.DataFrame) -> pd.DataFrame:
        shard = group["shard"].iat[0]
        place, posting, asking = (group[group["kind"] == k] for k in range(3))
        known = dict(zip(posting["key"], posting["values"]))
        lengths = np.asarray(place["values"].iat[0], np.int64)
        begin = np.cumsum(lengths + GAP) - lengths - GAP
        found = []
        for window_id, terms in zip(asking["key"], asking["values"]):
            posted = [known.get(t) for t in terms]
            if any(p is None for p in posted):
                continue
            first, last = phrase_starts(posted, slop)
            if len(first):
                doc = np.searchsorted(begin, first, "right") - 1
                found.append((doc, first - begin[doc], last - begin[doc] + 1, np.full(len(doc), window_id)))
        if not found:
            return pd.DataFrame(columns=["shard", "doc_no", "firsts", "stops", "window_ids"], dtype=object)
        doc, first, stop, window = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((stop, first, doc))
        doc, first, stop, window = doc[order], first[order], stop[order], window[order]
        rows, edges = [], np.append(C.run_starts(doc), len(doc))
        for lo, hi in zip(edges[:-1], edges[1:]):
            reach = np.maximum.accumulate(stop[lo:hi])
            cut = np.flatnonzero(np.concatenate(([True], first[lo + 1:hi] > reach[:-1])))
            ends = np.append(reach[cut[1:] - 1], reach[-1])
            rows.append((shard, doc[lo], first[lo:hi][cut], ends, np.unique(window[lo:hi])))
        return pd.DataFrame(rows, columns=["shard", "doc_no", "firsts", "stops", "window_ids"])

    found = both.groupBy("shard", "block").applyInPandas(
        match, "shard bigint, doc_no bigint, firsts array<bigint>, stops array<bigint>, window_ids array<bigint>")
    return found.select("shard", "doc_no", "window_ids", F.arrays_zip(
        F.col("firsts").alias("first"), F.col("stops").alias("stop")).alias("spans"))


def _covered(spans):
    """Number of words in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(spans, start, lambda acc, s: F.struct(
        F.greatest(acc["reach"], s["stop"]).alias("reach"),
        (acc["n"] + F.greatest(s["stop"] - F.greatest(acc["reach"], s["first"]), F.lit(0))).alias("n")),
        lambda acc: acc["n"])


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                  text: str = "text", window: int = WINDOW, slop: int = 0) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, spans, text_key) of every document.

    ``spans`` are word positions (first, stop) that windows occupy; ``item_ids`` are sorted strings;
    ``text_key`` is xxhash64 of the text.
    """
    lineage = Lineage(docs.sparkSession, every=1)
    windows = lineage.cut(windows_of(items, item_id, text, window), force=True)
    index = positional_index(docs, lineage, term_screen(windows), doc_id, text)
    hits = lineage.cut(find_windows(index, windows, slop), force=True)
    spans = hits.groupBy("shard", "doc_no").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    listed = hits.select("shard", "doc_no", F.explode("window_ids").alias("window_id")) \
        .join(windows.select("window_id", "item_id"), "window_id") \
        .filter(F.col("item_id").isNotNull()) \
        .groupBy("shard", "doc_no").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    all_docs = index.filter(F.col("term").isNull()) \
        .select("shard", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "lengths")).alias("doc_no", "d")) \
        .select("shard", F.col("doc_no").cast("bigint").alias("doc_no"), F.col("d.doc_ids").alias("doc_id"),
                F.col("d.text_keys").alias("text_key"), F.col("d.lengths").alias("n_words"))
    none = F.array().cast("array<string>")
    return all_docs.join(spans, ["shard", "doc_no"], "left").join(listed, ["shard", "doc_no"], "left").select(
        "doc_id", "n_words", F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(F.coalesce("item_ids", none)).cast("bigint").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"), "spans", "text_key")
