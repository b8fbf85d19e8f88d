"""Quality rules from repetition: characters inside repeated n-grams and lines.

Words are maximal runs without ASCII white space.  The words of a chunk of
documents are hashed by one prefix hash, n-grams by rolling the hash one word
further, for n = 2 to 10.  An n-gram can only repeat where its two
(n-1)-grams repeat, so each length sorts only what is left of the one before.

A document is rejected by the base rule (fewer than 50 words, or more than half
of the words inside repeated 3-word windows) or when

* a 2-, 3- or 4-gram that occurs at least three times covers more than 20, 18
  or 16 % of the characters of its words, or
* windows of 5, ..., 10 words that equal an earlier window cover more than
  15, 14, 13, 12, 11 or 10 % of them, or
* more than one symbol comes on five words, or
* lines that equal an earlier line make more than half of its lines with a
  word, or hold more than 20 % of those characters.

Defined cases: a null or empty text has no words and fails the base rule; a
null id stays null; equal rows give equal rows; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratum.llm import columnar as C

MIN_WORDS = 50
MAX_REPEAT_WORDS_PCT = 50
TOP_PCT = {2: 20, 3: 18, 4: 16}
DUP_PCT = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
DUP_LINES_PCT, DUP_LINE_CHARS_PCT = 50, 20
TOP_LEAST = 3
SYMBOLS_PER_100_WORDS = 20
SYMBOLS = b"#*$%&|<>"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "dup_line_chars", *[f"top{n}_chars" for n in TOP_PCT], *[f"dup{n}_chars" for n in DUP_PCT]]
SCHEMA = ("doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS[:5])
          + ", base_failed boolean, kept boolean, "
          + ", ".join(f"{c} bigint" for c in COUNTS[5:]))

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True


def _runs(keys: np.ndarray, at: np.ndarray):
    """Repeated keys: (their places, first place of each run or not, run number, run sizes)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    starts = C.run_starts(ordered)
    sizes = np.diff(np.append(starts, len(ordered)))
    many = sizes > 1
    run = np.repeat(np.arange(len(starts)), sizes)
    pick = many[run]
    number = np.cumsum(many) - 1
    first = np.zeros(len(ordered), bool)
    first[starts] = True
    return at[order[pick]], first[pick], number[run[pick]], sizes[many]


def repetition_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of COUNTS for each document of a chunk."""
    n_docs = len(offs) - 1
    total = lambda doc, w=None: np.bincount(doc, w, n_docs).astype(np.int64)
    inside = C.WORD_BYTES[buf]
    start, end, doc = C.spans(inside, offs)
    points = C.code_points(buf)
    chars = points[end] - points[start]
    out = {"n_words": total(doc), "word_chars": total(doc, chars)}
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[buf])))
    out["n_symbols"] = symbols[offs[1:]] - symbols[offs[:-1]]
    salt = C.mix(np.arange(1, n_docs + 1, dtype=np.uint64))

    # lines with a word
    cuts = np.flatnonzero(buf == 10)
    l_start = np.sort(np.concatenate((offs[:-1], cuts + 1)))
    l_end = np.sort(np.concatenate((cuts, offs[1:])))
    l_doc = np.searchsorted(offs, l_end, "left") - 1
    filled = np.concatenate(([0], np.cumsum(inside)))
    with_word = filled[l_end] > filled[l_start]
    l_start, l_end, l_doc = l_start[with_word], l_end[with_word], l_doc[with_word]
    word_points = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(inside & ((buf & 0xC0) != 0x80), out=word_points[1:])
    l_chars = word_points[l_end] - word_points[l_start]
    at, first, _, _ = _runs(C.span_hashes(buf, l_start, l_end) ^ salt[l_doc], np.arange(len(l_doc)))
    again = at[~first]
    out["n_lines"] = total(l_doc)
    out["n_dup_lines"] = total(l_doc[again])
    out["dup_line_chars"] = total(l_doc[again], l_chars[again])

    # n-grams, each length from the repeated ones of the length before
    words = C.span_hashes(buf, start, end)
    upto = np.concatenate(([0], np.cumsum(chars)))
    gram, repeated = words, np.ones(len(words) + 1, bool)
    for n in range(2, max(DUP_PCT) + 1):
        gram = C.extend(gram, words, n)
        at = np.flatnonzero(repeated[:len(gram)] & repeated[1:len(gram) + 1]
                            & (doc[:len(gram)] == doc[n - 1:n - 1 + len(gram)]))
        at, first, run, sizes = _runs(gram[at] ^ salt[doc[at]], at)
        repeated = np.zeros(len(words) + 1, bool)
        repeated[at] = True
        if n in TOP_PCT:
            heads = at[first]
            covered = np.zeros(n_docs, np.int64)
            often = np.where(sizes >= TOP_LEAST, sizes, 0)
            np.maximum.at(covered, doc[heads], often[run[first]] * (upto[heads + n] - upto[heads]))
            out[f"top{n}_chars"] = covered
        if n == 3:
            hit = _covered(at, n, len(words))
            out["n_repeat_words"] = total(doc[hit])
        if n in DUP_PCT:
            hit = _covered(at[~first], n, len(words))
            out[f"dup{n}_chars"] = total(doc[hit], chars[hit])
    return out


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Words inside a window of n words that starts at one of ``at``."""
    step = np.zeros(size + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def verdicts(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept)."""
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_WORDS_PCT * c["n_words"])
    bad = 100 * c["n_symbols"] > SYMBOLS_PER_100_WORDS * c["n_words"]
    bad |= (100 * c["n_dup_lines"] > DUP_LINES_PCT * c["n_lines"]) \
        | (100 * c["dup_line_chars"] > DUP_LINE_CHARS_PCT * c["word_chars"])
    for n, pct in TOP_PCT.items():
        bad |= 100 * c[f"top{n}_chars"] > pct * c["word_chars"]
    for n, pct in DUP_PCT.items():
        bad |= 100 * c[f"dup{n}_chars"] > pct * c["word_chars"]
    return failed, ~failed & ~bad


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document."""

    def run(batches):
        for batch in batches:
            buf, offsets = C.text_bytes(batch.column(1))
            for lo, hi in C.chunks(offsets):
                offs = offsets[lo:hi + 1] - offsets[lo]
                c = repetition_counts(buf[offsets[lo]:offsets[hi]], offs)
                failed, kept = verdicts(c)
                cols = [batch.column(0).slice(lo, hi - lo), *[pa.array(c[k]) for k in COUNTS[:5]],
                        pa.array(failed), pa.array(kept), *[pa.array(c[k]) for k in COUNTS[5:]]]
                yield pa.RecordBatch.from_arrays(
                    cols, names=["doc_id", *COUNTS[:5], "base_failed", "kept", *COUNTS[5:]])

    return docs.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"`{text}` as text").mapInArrow(run, SCHEMA)
