r"""Personal data by seed patterns and bootstrapped contextual extraction.

Seeds.  Four kinds are found by fixed expressions, leftmost and not
overlapping within a kind: e-mail addresses; IPv4 addresses whose parts are at
most 255; card numbers of 16 to 19 digits that pass Luhn's test; phone numbers
that start with ``+`` and have 8 to 15 digits.

Bootstrapping.  Besides the seeds, every text has candidates: groups of digits
with separators, and words around an ``@``, that no seed expression took and
whose form could be one of the kinds.  A pattern is a kind with the lexical
context of an entity: the two words before it, or the word before and the word
after it.  Seeds and candidates in the same contexts make a graph of patterns
and instances (distinct strings), which Spark scores for ``rounds`` rounds:

* a context is a pattern of each kind in it, whose confidence is the mean, over
  all instances in the context, of their confidence for that kind: strays of
  another kind lower it and do not end it;
* a pattern is used in a round if at least ``min_seeds`` distinct instances of its
  kind that are seeds, or candidates that reached ``min_confidence`` in the round
  before, stand in it (so copies of one text cannot vote twice);
* a candidate's confidence for a kind is that of its best pattern.

Candidates that reach ``min_confidence`` in the last round become spans of
that kind unless they touch a seed.

Only the contexts are shuffled, never texts, and counts per (pattern,
instance) are made distinct before they meet, so a frequent context costs one
row for each distinct string in it.

Defined cases: a null or empty text has no spans; a null id stays null; equal
rows have equal spans; texts without candidates cost nothing beyond the scan;
very long texts are read whole, words of the context at any distance and of any
length; an empty table gives an empty result; other columns are ignored.  Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions import int_div
from stratum.plans import Lineage

KINDS = ("email", "ip", "card", "phone")
# fixed patterns of the four kinds
EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: groups of digits joined by one separator: every ip and card lies in one of these
CLUSTER = re.compile(r"[0-9]++(?:[\x20.-][0-9]++)*+")
WORD = re.compile(r"[^\W\d_]+")
LONG_CONTEXT = 64     # a longer context stands in the written table as its digest
ONE = 10**9           # confidences are whole billionths, so that sums do not depend on their order

MIN_SEEDS, MIN_CONFIDENCE, ROUNDS = 3, 0.8, 3
SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"
FOUND = ("doc_id bigint, text_key bigint, seeds " + SPANS + ", contexts array<struct<kind:int,seed:boolean,"
         "start:bigint,end:bigint,value:string,before2:string,around:string>>")


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_CHARS:
            start -= 1
        host = EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def seed_spans(text: str, clusters: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    ips, cards = [], []
    for a, b in clusters:
        if b - a >= 7 and text.count(".", a, b) >= 3:
            ips += [(1, m.start(), m.end()) for m in IP.finditer(text, a, b)
                    if all(map(_small, m[0].split(".")))]
        if b - a >= 16:
            for m in CARD.finditer(text, a, b):
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    cards.append((2, m.start(), m.end()))
    phones = [(3, m.start(), m.end()) for m in PHONE.finditer(text)
              if 8 <= sum(c.isdigit() for c in m[0]) <= 15] if "+" in text else []
    return [(0, a, b) for a, b in _emails(text)] + ips + cards + phones


def candidate_spans(text: str, clusters: list[tuple[int, int]], seeds: list) -> list[tuple[int, int, int]]:
    """(kind, start, end) of strings that have the form of a kind but are no seeds."""
    taken = sorted((a, b) for _, a, b in seeds)
    out, k = [], 0
    for a, b in clusters:
        if b - a < 7:
            continue
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k < len(taken) and taken[k][0] < b:
            continue
        digits = sum(c.isdigit() for c in text[a:b])
        groups = re.split(r"[ .-]", text[a:b])
        if len(groups) == 4 and text.count(".", a, b) == 3:
            out.append((1, a, b))
        elif 16 <= digits <= 19:
            out.append((2, a, b))
        elif 7 <= digits <= 15:
            out.append((3, a, b))
    at = text.find("@")
    while at >= 0:
        a, b = at, at + 1
        while a > 0 and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        if a < at and at + 1 < b and not any(x < b and a < y for x, y in taken):
            out.append((0, a, b))
        at = text.find("@", b)
    return out


def _key(context: str) -> str:
    return context if len(context) <= LONG_CONTEXT else hashlib.sha256(
        context.encode("utf-8", "surrogatepass")).hexdigest()


def _contexts(text: str, entities: list[tuple[int, bool, int, int]]) -> list[dict]:
    """The (kind, seed, start, end) entities with the words around them, at any distance."""
    if not entities:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    out = []
    for kind, seed, a, b in entities:
        k, j = bisect_left(starts, a), bisect_right(ends, b)
        left = [text[starts[i]:min(ends[i], a)].lower() for i in range(max(0, k - 2), k)]
        right = text[max(starts[j], b):ends[j]].lower() if j < len(ends) else None
        out.append({"kind": kind, "seed": seed, "start": a, "end": b, "value": text[a:b],
                    "before2": _key(" ".join(left)) if len(left) == 2 else None,
                    "around": _key(f"{left[-1]} _ {right}") if left and right else None})
    return out


def find_entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Seeds of every document, and seeds and candidates with their contexts."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()),
        ("seeds", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("contexts", pa.list_(pa.struct([
            ("kind", pa.int32()), ("seed", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()),
            ("value", pa.string()), ("before2", pa.string()), ("around", pa.string())])))])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                seeds, contexts = [], []
                for t in part.column(2).to_pylist():
                    t = t or ""
                    clusters = [m.span() for m in CLUSTER.finditer(t)]
                    found = seed_spans(t, clusters)
                    seeds.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
                    contexts.append(_contexts(
                        t, [(k, True, a, b) for k, a, b in found]
                        + [(k, False, a, b) for k, a, b in candidate_spans(t, clusters, found)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(seeds, schema.field(2).type),
                     pa.array(contexts, schema.field(3).type)], schema=schema)

    return docs.select(F.col(doc_id).cast("bigint"), F.xxhash64(F.col(text)), F.col(text)) \
        .mapInArrow(run, FOUND)


def bootstrap(found: DataFrame, lineage: Lineage, min_seeds: int = MIN_SEEDS,
              min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text_key, kind, start, end) of the candidates that the patterns accept."""
    occurrences = found.select("doc_id", "text_key", F.explode("contexts").alias("c")).select(
        "doc_id", "text_key", "c.*")
    edges = occurrences.select(
        "kind", "seed", F.xxhash64("value").alias("instance"),
        F.explode(F.array(F.concat(F.lit("2:"), "before2"), F.concat(F.lit("1:"), "around"))).alias("context")) \
        .filter(F.col("context").isNotNull()) \
        .select("kind", "seed", "instance", F.xxhash64("context").alias("pattern")).distinct()
    # a pattern can only matter with enough instances of its kind, and a candidate among them
    seed = F.col("seed")
    kinds = edges.groupBy("pattern", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(~seed, 1)).alias("others"))
    useful = kinds.groupBy("pattern").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("kind", "n", "others")).alias("kinds")) \
        .select("pattern", "total", F.explode("kinds").alias("k")).select("pattern", "total", "k.*") \
        .filter((F.col("n") >= min_seeds) & (F.col("others") > 0)).select("pattern", "kind", "total")
    graph = lineage.cut(edges.join(useful, ["pattern", "kind"]).select(
        "pattern", "total", "kind", "seed", "instance"), force=True)
    # instance confidence: 1 for seeds, and 0 for candidates at first
    belief = graph.filter(F.lit(False)).select("kind", "instance", F.lit(0).cast("bigint").alias("belief"))
    sure = round(min_confidence * ONE)
    for _ in range(rounds):
        held = seed | (F.col("belief") >= sure)
        confidence = graph.join(belief, ["kind", "instance"], "left").groupBy("pattern", "kind").agg(
            int_div(F.sum(F.when(seed, ONE).otherwise(F.coalesce("belief", F.lit(0)))), F.max("total"))
            .alias("confidence"), F.count(F.when(held, 1)).alias("held")).filter(F.col("held") >= min_seeds)
        belief = lineage.cut(graph.filter(~seed).join(confidence, ["pattern", "kind"])
                             .groupBy("kind", "instance").agg(F.max("confidence").alias("belief")), force=True)
    accepted = belief.filter(F.col("belief") >= sure).select("kind", "instance", "belief")
    spots = occurrences.filter(~seed).select(
        "doc_id", "text_key", "kind", "start", "end", F.xxhash64("value").alias("instance"))
    # a string is accepted where it stands, in any context
    return spots.join(accepted, ["kind", "instance"]) \
        .select("doc_id", "text_key", "kind", "start", "end").distinct()


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE,
                       rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, spans): lists of (kind, start, end) by kind, then start."""
    lineage = Lineage(docs.sparkSession, every=1)
    found = lineage.cut(find_entities(docs, doc_id, text), force=True)
    more = bootstrap(found.filter(F.size("contexts") > 0), lineage, min_seeds, min_confidence, rounds) \
        .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    left = found.select("doc_id", "text_key", "seeds")
    same = left["doc_id"].eqNullSafe(more["doc_id"]) & left["text_key"].eqNullSafe(more["text_key"])
    return left.join(more, same, "left").select(
        left["doc_id"], F.col("seeds").alias("base"),
        F.array_sort(F.concat("seeds", F.coalesce("more", F.array().cast(SPANS)))).alias("spans"))


def spans_text(spans):
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
