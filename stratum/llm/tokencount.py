"""Token counts by offset-mapped attribution.

The text of each document (its ``fields``, joined by a newline) is encoded once
and whole.  The byte lengths of the tokens, summed up, give each token's span;
the sections are spans too (every line with its newline, per field), so the two
sorted lists are interval-joined by binary search.  A token inside one section
counts for it.  A token that crosses a boundary is allocated by ``rule``:

* ``first``: to the section that holds its first byte;
* ``most``:  to the section that holds most of its bytes, the earliest on a tie;
* ``share``: to each section in proportion to its bytes (fractional counts).

The sum over the sections of a document is always its number of tokens.

The vocabulary is a tiktoken rank file; ``vocabulary`` is its path and has to
be readable on every executor.  It is loaded once per Python worker.

Defined cases: a null field counts as empty, and an empty document has one
section (0 of field 0) without tokens; a null id stays null; equal rows give
equal rows; an empty table gives an empty result; other columns are ignored.
Special tokens' strings in a text are ordinary text.  Very long texts are encoded
whole; white space of ``LONG_SPACE`` code points and more is one pre-token but for its
last code point before a word, so it goes to the encoder as a piece of its own.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-token pattern that belongs to the vocabulary
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
           r"|\s+(?!\S)|\s+")
RULES = ("first", "most", "share")
LONG_SPACE = 10_000
# fixed value: the white space of the pattern's \s
SPACE_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_SPACE)
SCHEMA = ("doc_id bigint, field int, section int, start bigint, end bigint, n_tokens {count}, "
          "n_crossing bigint, doc_tokens bigint")
_loaded: dict = {}


def encoder(vocabulary: str):
    """(encode, encode one pre-token, byte length of each token) of a rank file, once per worker."""
    if vocabulary not in _loaded:
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            lengths[rank] = len(piece)
        own = tiktoken.Encoding(os.path.basename(vocabulary), pat_str=PATTERN, mergeable_ranks=ranks,
                                special_tokens={})
        _loaded[vocabulary] = own.encode_ordinary, own._encode_single_piece, lengths
    return _loaded[vocabulary]


def token_ends(text: str, vocabulary: str) -> np.ndarray:
    """Byte offset at which each token of ``text`` ends."""
    encode, encode_piece, lengths = encoder(vocabulary)
    tokens, at = [], 0
    for run in SPACE_RUN.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        tokens += [encode(text[at:run.start()]), encode_piece(text[run.start():stop])]
        at = stop
    tokens.append(encode(text[at:]))
    return np.cumsum(np.concatenate([lengths[np.asarray(t, np.int64)] for t in tokens]))


def attribute(ends: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section and the number of crossing tokens.

    ``ends`` are token ends, ``cuts`` section ends (rising; the last of both is the text's end).
    """
    n = len(cuts)
    if not len(ends):
        return np.zeros(n), 0
    starts = np.concatenate(([0], ends[:-1]))
    a = np.searchsorted(cuts, starts, "right")
    b = np.searchsorted(cuts, ends, "left")
    a, b = np.minimum(a, n - 1), np.minimum(b, n - 1)
    crossing = np.flatnonzero(b > a)
    if rule == "first" or not len(crossing):
        return np.bincount(a, minlength=n).astype(float), len(crossing)
    counts = np.bincount(np.delete(a, crossing), minlength=n).astype(float)
    for t in crossing:
        bounds = np.concatenate(([starts[t]], cuts[a[t]:b[t]], [ends[t]]))
        part = np.diff(bounds)
        if rule == "most":
            counts[a[t] + int(np.argmax(part))] += 1
        else:
            counts[a[t]:b[t] + 1] += part / part.sum()
    return counts, len(crossing)


def sections(fields: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """(whole text, field of each section, byte end of each section)."""
    whole = "\n".join(fields)
    data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
    cuts = np.flatnonzero(data == 10) + 1
    if not len(cuts) or cuts[-1] < len(data):
        cuts = np.append(cuts, len(data))
    field_ends = np.cumsum([len(f.encode("utf-8", "surrogatepass")) + 1 for f in fields])
    return whole, np.minimum(np.searchsorted(field_ends, cuts, "left"), len(fields) - 1), cuts


def count_tokens(docs: DataFrame, doc_id: str = "doc_id", fields: tuple = ("text",), rule: str = "most",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document and section: its span in code points and its tokens.

    ``start`` and ``end`` are code points of the document's joined text.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}, not {rule!r}")
    count = "double" if rule == "share" else "bigint"
    schema = SCHEMA.format(count=count)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            cols = [c.to_pylist() for c in batch.columns[1:]]
            rows: list[tuple] = []
            held = 0
            for i, doc in enumerate(ids):
                whole, field, cuts = sections([c[i] or "" for c in cols])
                ends = token_ends(whole, vocabulary)
                counts, crossing = attribute(ends, cuts, rule)
                if len(whole) == cuts[-1]:
                    points = cuts
                else:
                    data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
                    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[cuts]
                starts = np.concatenate(([0], points[:-1]))
                number = np.arange(len(cuts)) - np.searchsorted(field, field, "left")
                rows.append((np.full(len(cuts), doc if doc is not None else 0), np.full(len(cuts), doc is None),
                             field, number, starts, points, counts, np.full(len(cuts), crossing),
                             np.full(len(cuts), len(ends))))
                held += len(cuts)
                if held >= 1 << 15 or i == len(ids) - 1:
                    c = [np.concatenate(x) for x in zip(*rows)]
                    rows, held = [], 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c[0], pa.int64(), mask=c[1]), pa.array(c[2], pa.int32()),
                         pa.array(c[3], pa.int32()), pa.array(c[4], pa.int64()), pa.array(c[5], pa.int64()),
                         pa.array(c[6]) if rule == "share" else pa.array(c[6].astype(np.int64)),
                         pa.array(c[7], pa.int64()), pa.array(c[8], pa.int64())], names=names)

    return docs.select(F.col(doc_id).cast("bigint"), *fields).mapInArrow(run, schema)
