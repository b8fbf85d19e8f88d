"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (n = 3 to 6, code points, with the
word's two ends marked) of a document's words, lower-cased in ASCII.  A word
is a run of ASCII letters, digits and other code points from U+0080 on.

Training uses at most ``max_train`` labelled rows (those with the smallest hash
of their id, so the choice does not depend on file order); this bounds the
label side of the join, which is broadcast for that reason.  Spark counts each
n-gram's toxic and clean documents over all of these rows.  The ``max_features``
n-grams that tell the classes apart best (by the G-statistic) get the ratio
r = log((toxic + 1) / (n_toxic + 2)) - log((clean + 1) / (n_clean + 2)).
A ridge logistic regression over x = r * [n-gram occurs] is then fitted on at
most ``max_fit`` of the rows; only their feature numbers reach the driver.

Scoring covers every whole text; the model (``max_features`` numbers) travels
in the task closure.  Labels, language, source and id are never inputs.

Defined cases: a null or empty text has no n-grams and gets the score of the
intercept; a null id counts as not held out; labels that are null are ignored;
a document with several labels, and one that occurs several times, trains once
for each; labels without a document are ignored; without labels of both classes every score is the share of toxic labels (0 without labels); equal rows
give equal rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.llm import columnar as C

NGRAMS = (3, 4, 5, 6)
MAX_TRAIN, MAX_FIT, MAX_FEATURES = 20_000, 8_000, 1_024
MIN_DOCS = 5
RIDGE = 0.5
HELD_OUT = (4, 2)     # crc32(id) mod 4 = 2
THRESHOLD = 0.3
SCREEN_BITS = 18


def word_ngrams(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, hash) of every n-gram of the given byte spans, ends marked by ``^`` and ``$``."""
    size = end - start + 2
    at = np.concatenate(([0], np.cumsum(size)))
    text = np.empty(at[-1], np.uint8)
    text[at[:-1]], text[at[1:] - 1] = ord("^"), ord("$")
    body = np.ones(at[-1], bool)
    body[at[:-1]] = body[at[1:] - 1] = False
    within = np.arange(at[-1]) - np.repeat(at[:-1], size) - 1
    text[body] = buf[(np.repeat(start, size) + within)[body]]
    points = np.flatnonzero((text & 0xC0) != 0x80)
    word = np.searchsorted(at, points, "right") - 1
    stop = np.append(points[1:], len(text))
    words, hashes = [], []
    for n in NGRAMS:
        if len(points) < n:
            break
        fits = word[:len(word) - n + 1] == word[n - 1:]
        words.append(word[:len(word) - n + 1][fits])
        hashes.append(C.span_hashes(text, points[:len(points) - n + 1][fits], stop[n - 1:][fits]))
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(words), np.concatenate(hashes)


class Lookup:
    """Numbers of known hashes: a bit screen on the top bits, then a binary search."""

    def __init__(self, known: np.ndarray):
        self.order = np.argsort(known)
        self.known = known[self.order]
        self.screen = np.zeros(1 << SCREEN_BITS, bool)
        self.screen[known >> np.uint64(64 - SCREEN_BITS)] = True

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of known hashes, their numbers)."""
        at = np.flatnonzero(self.screen[hashes >> np.uint64(64 - SCREEN_BITS)])
        k = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        hit = self.known[k] == hashes[at]
        return at[hit], self.order[k[hit]]


def document_features(buf: np.ndarray, offs: np.ndarray, lookup: Lookup | None = None):
    """(document, feature) pairs without repeats: hashes, or numbers of known hashes."""
    low = C.LOWER[buf]
    start, end, doc = C.spans(C.ALNUM_BYTES[buf], offs)
    hashes = C.span_hashes(low, start, end)
    order = np.argsort(hashes)
    first = C.run_starts(hashes[order])
    kind = np.empty(len(order), np.int64)            # number of the distinct word of each word
    kind[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    word, gram = word_ngrams(low, start[order[first]], end[order[first]])
    if lookup is not None:
        at, gram = lookup(gram)
        word = word[at]
    by_word = np.argsort(word, kind="stable")
    word, gram = word[by_word], gram[by_word]
    lo = np.searchsorted(word, np.arange(len(first)))
    many = np.diff(np.append(lo, len(word)))
    used = np.flatnonzero(many[kind] > 0)
    pairs = np.unique(doc[used] * np.int64(len(first) + 1) + kind[used])
    d, k = pairs // (len(first) + 1), pairs % (len(first) + 1)
    reps = many[k]
    place = np.repeat(lo[k], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    d, g = np.repeat(d, reps), gram[place]
    order = np.lexsort((g, d))
    d, g = d[order], g[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[new], g[new]


def _chunked(batches, column: int):
    for batch in batches:
        buf, offsets = C.text_bytes(batch.column(column))
        for lo, hi in C.chunks(offsets):
            yield batch.slice(lo, hi - lo), buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def ngram_counts(train: DataFrame) -> DataFrame:
    """(gram, toxic, clean) documents of each n-gram in rows of (toxic, text)."""

    def run(batches):
        for part, buf, offs in _chunked(batches, 1):
            label = np.asarray(part.column(0).to_pylist(), bool)
            d, g = document_features(buf, offs)
            order = np.argsort(g, kind="stable")
            g, y = g[order], label[d[order]]
            first = C.run_starts(g)
            toxic = np.add.reduceat(y.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(g)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[first].view(np.int64)), pa.array(toxic), pa.array(n - toxic)],
                names=["gram", "toxic", "clean"])

    return train.mapInArrow(run, "gram bigint, toxic bigint, clean bigint") \
        .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_part(k, n):
    return F.when(k > 0, k * F.log(k.cast("double") / n)).otherwise(0.0)


def fit_ridge(d: np.ndarray, k: np.ndarray, y: np.ndarray, ratio: np.ndarray,
              ridge: float = RIDGE) -> tuple[float, np.ndarray]:
    """(intercept, weight per feature) by Newton steps; (d, k) are the document-feature pairs."""
    x = np.zeros((len(y), len(ratio) + 1), np.float64)
    x[:, -1] = 1
    x[d, k] = ratio[k]
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    penalty = np.append(np.full(len(ratio), ridge), 1e-6)

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - z @ y + 0.5 * penalty @ (w * w)

    now = loss(w)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step, size = np.linalg.solve(hess, grad), 1.0
        while (new := loss(w - size * step)) > now and size > 1e-4:
            size /= 2
        if now - new < 1e-6 * max(1.0, now):
            break
        w, now = w - size * step, new
    return float(w[-1]), w[:-1] * ratio


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", max_train: int = MAX_TRAIN, max_fit: int = MAX_FIT,
          max_features: int = MAX_FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """(n-gram hashes, weights, intercept) from labelled rows that are not held out."""
    by_hash = F.xxhash64(doc_id)
    chosen = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))) \
        .select(doc_id, (F.col(label) != 0).alias("toxic"), by_hash.alias("draw")) \
        .orderBy("draw", doc_id, "toxic").limit(max_train)
    rows = docs.select(doc_id, text).join(F.broadcast(chosen), doc_id).select("toxic", text, "draw", doc_id)
    # totals of the same rows as the n-gram counts: labels without a document count nowhere
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("toxic").cast("int")).alias("toxic")).first()
    n_toxic, n_clean = n["toxic"] or 0, n["n"] - (n["toxic"] or 0)
    empty = np.zeros(0, np.uint64), np.zeros(0)
    if not n_toxic or not n_clean:
        share = n_toxic / n["n"] if n["n"] else 0.0
        return *empty, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    a, b = F.col("toxic"), F.col("clean")
    total, t, c = F.lit(float(n["n"])), F.lit(float(n_toxic)), F.lit(float(n_clean))
    gain = (_log_part(a, t * (a + b) / total) + _log_part(b, c * (a + b) / total)
            + _log_part(t - a, t * (total - a - b) / total) + _log_part(c - b, c * (total - a - b) / total))
    best = ngram_counts(rows.select("toxic", text)).filter(a + b >= MIN_DOCS) \
        .select("gram", "toxic", "clean", gain.alias("gain")) \
        .orderBy(F.col("gain").desc(), "gram").limit(max_features).toPandas()
    if best.empty:
        return *empty, float(np.log(n_toxic / n_clean))
    grams = best["gram"].to_numpy(np.int64).view(np.uint64)
    ratio = np.log((best["toxic"].to_numpy(float) + 1) / (n_toxic + 2)) \
        - np.log((best["clean"].to_numpy(float) + 1) / (n_clean + 2))

    def numbers(batches):
        lookup = Lookup(grams)
        for part, buf, offs in _chunked(batches, 1):
            d, k = document_features(buf, offs, lookup)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(d, np.arange(part.num_rows + 1)).astype(np.int32)),
                pa.array(k.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["toxic", "features"])

    fit_ids = chosen.orderBy("draw", doc_id, "toxic").limit(max_fit)
    sample = docs.select(doc_id, text).join(F.broadcast(fit_ids), doc_id).select("toxic", text) \
        .mapInArrow(numbers, "toxic boolean, features array<int>") \
        .groupBy("toxic", "features").count().orderBy("toxic", "features").toPandas()
    y = np.repeat(sample["toxic"].to_numpy(float), sample["count"])
    lists = [np.asarray(f, np.int64) for f, n in zip(sample["features"], sample["count"]) for _ in range(n)]
    d = np.repeat(np.arange(len(lists)), [len(f) for f in lists])
    k = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    if not 0 < y.sum() < len(y):
        return *empty, float(np.log(n_toxic / n_clean))
    intercept, weights = fit_ridge(d, k, y, ratio)
    return grams, weights, intercept


def held_out(doc_id):
    """Rows that no label may be learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text",
          out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row (in place of a column named ``out``)."""
    grams, weights, intercept = model
    keep = [c for c in docs.columns if c != out]
    at = keep.index(text)
    inner = [f"c{k}" for k in range(len(keep))]
    source = docs.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)])
    schema = T.StructType([*source.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches):
        lookup = Lookup(grams) if len(grams) else None
        for part, buf, offs in _chunked(batches, at):
            z = np.full(part.num_rows, intercept)
            if lookup:
                d, k = document_features(buf, offs, lookup)
                z += np.bincount(d, weights[k], part.num_rows)
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], names=[*inner, "score"])

    return source.mapInArrow(run, schema).toDF(*keep, out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **names) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document."""
    model = train(docs, labels, **names)
    rows = docs.select(F.col(names.get("doc_id", "doc_id")).cast("bigint").alias("doc_id"),
                       F.col(names.get("text", "text")).alias("text"))
    return score(rows, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
