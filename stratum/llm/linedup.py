"""Line dedup by pairwise alignment: common blocks are deleted from the later document.

1. Lines.  A document gives the hashes of its lines (runs of words up to a newline or
   the end of a sentence) of ``LINE_WORDS`` words or more, and, so that a sentence cut
   at the edge of a pasted passage is no obstacle, of content-defined lines: in each
   window of ``min_words`` words the run of half as many with the least hash.  Equal
   windows have equal ones.
2. Pairs.  A line that one document holds proposes nothing: most such lines are left out
   by a screen of the lines that several hold, the others by the aggregate.  A line that several hold
   pairs each later holder with the first one only (ids rise with time), so a line in a
   million documents makes a million pairs and not their square.
3. Slices.  The shared lines of a pair bound the words that can match: no common block
   reaches more than a window beyond them.  Only these words are sent to meet, as
   32-bit hashes, and a slice that many pairs ask for is cut once.
4. Alignment.  Each pair is aligned by patience diff over windows of ``min_words``
   words: windows found once on either side, as far as they rise together, are the
   frame, and each of their runs is extended word by word on both sides into partial
   sentences.  What is left of the later document is aligned again, so swapped and
   doubled passages are found too, until no window of the pair is left.
5. The aligned blocks are deleted from the later document, with the white space that
   follows them.

The first document that holds a passage keeps it, so no text is lost altogether.  A
block that no first holder of any of its lines holds is not found: the test against
all windows of all documents states the recall.  ``removed_lines`` counts the lines
that lose a word.

Defined cases: a null text stays null and an empty one empty; rows with a null id
stay whole and delete nothing; rows with equal ids are not compared with each other;
equal rows lose equal blocks; a document that is a copy as a whole ends up empty; a
very long text is cut in one pass over its bytes, and only its slices meet others; an
empty table gives an empty result.  All columns of the input are kept, whatever their
names; ``text`` is replaced.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import columnar as C
from stratum.llm.frames import renamed, restored
from stratum.plans import Lineage

MIN_WORDS = 30
LINE_WORDS = 12
CHUNK = 1 << 18         # bytes of text hashed at a time: the arrays of a chunk stay in a core's cache
PAGE = 64               # slices begin and end at multiples of so many words
SCREEN_BITS = (16, 26)  # least and most, as powers of two
LINES = "doc_id bigint, text_key bigint, line bigint, pos bigint"
BLOCKS = "doc_id bigint, text_key bigint, first bigint, stop bigint"
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True


def _last_words(buf: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether each word is the last of its line."""
    last = np.ones(len(start), bool)
    last[:-1] = (doc[1:] != doc[:-1]) | _STOP[buf[end[:-1] - 1]]
    before = np.searchsorted(start, np.flatnonzero(buf == 10))      # words before each newline
    last[before[before > 0] - 1] = True
    return last


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The least of each n consecutive entries."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:])


def word_windows(words: np.ndarray, doc: np.ndarray, min_words: int):
    """(first word, anchor) of each window of ``min_words`` words within a document."""
    run = (min_words + 1) // 2
    if len(words) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.arange(len(words) - run + 1)
    least = _least(C.run_hashes(words, first, first + run), min_words - run + 1)
    at = np.flatnonzero(doc[:len(least)] == doc[min_words - 1:])
    return at, C.mix(least[at])     # a least hash is small: mixed, all of its bits serve the screen


def _chunks(batches):
    """(ids, text keys, bytes, offsets) of some documents at a time."""
    for batch in batches:
        buf, offsets = C.text_bytes(batch.column(2))
        for lo, hi in C.chunks(offsets, CHUNK):
            yield (batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                   buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])


def _joined(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges that overlap or touch, given in order, as one."""
    reach = np.maximum.accumulate(stop)
    new = np.flatnonzero(np.concatenate(([True], first[1:] > reach[:-1])))
    return first[new], reach[np.append(new[1:], len(first)) - 1]


def document_lines(keyed: DataFrame, min_words: int, columns: str = LINES, screen: tuple | None = None) -> DataFrame:
    """(doc_id, text_key, line, pos), or some of them: the line hashes of every document and their first words.

    ``screen`` is (packed screen, bits): lines that it does not hold are left out.
    """
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches):
        known = C.screen_bits(screen[0]) if screen else None
        for ids, keys, data, offs in _chunks(batches):
            start, end, doc = C.spans(C.WORD_BYTES[data], offs)
            if not len(start):
                continue
            words = C.span_hashes(data, start, end)
            edge = np.searchsorted(doc, np.arange(len(offs)))
            at, anchor = word_windows(words, doc, min_words)
            new = np.ones(len(at), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[at[1:]] != doc[at[:-1]])
            final = np.flatnonzero(_last_words(data, start, end, doc))
            first = np.concatenate(([0], final[:-1] + 1))
            long = final - first + 1 >= LINE_WORDS
            place = np.concatenate((at[new], first[long]))
            line = np.concatenate((anchor[new], C.mix(C.run_hashes(words, first[long], final[long] + 1))))
            if screen:
                kept = known[line >> np.uint64(64 - screen[1])]
                place, line = place[kept], line[kept]
            of = doc[place]
            made = {"doc_id": lambda: ids.take(pa.array(of)), "text_key": lambda: keys.take(pa.array(of)),
                    "line": lambda: pa.array(line.view(np.int64)), "pos": lambda: pa.array(place - edge[of])}
            yield pa.RecordBatch.from_arrays([made[c]() for c in names], names=names)

    return keyed.mapInArrow(run, columns)


def repeated_lines(keyed: DataFrame, lineage: Lineage, min_words: int) -> DataFrame:
    """The rows of ``document_lines`` whose line several ids hold, and few others.

    Most lines have one holder.  Which do not is found from two numbers a line, so the sums are hashed
    and not sorted; a screen of these lines then keeps the rest out of Arrow, sorts and shuffles.  It has
    eight slots to a line, and a fixed size at most; a fuller one lets more rows through, and loses none.
    """
    shared = lineage.cut(document_lines(keyed, min_words, "line bigint, doc_id bigint").groupBy("line").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter(F.col("least") < F.col("most")).select("line"),
        force=True)
    bits = min(max(shared.count().bit_length() + 3, SCREEN_BITS[0]), SCREEN_BITS[1])
    return lineage.cut(document_lines(keyed, min_words, screen=(C.screen_of(shared, bits), bits)), force=True)


def later_pairs(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, text_key, lo, hi, a_id, a_key, a_lo, a_hi): later documents and first holders of their lines.

    The words [lo, hi) of the one and [a_lo, a_hi) of the other hold every block they share around such lines.
    """
    holder = F.struct("doc_id", "text_key", "pos")
    shared = lines.groupBy("line").agg(F.min(holder).alias("a"), F.max("doc_id").alias("last")) \
        .filter(F.col("a.doc_id") < F.col("last")).drop("last")
    met = lines.join(shared, "line").filter(F.col("doc_id") > F.col("a.doc_id"))
    low = lambda c: F.floor(F.greatest(F.min(c) - min_words, F.lit(0)) / PAGE) * PAGE
    high = lambda c: F.ceil((F.max(c) + 3 * min_words) / PAGE) * PAGE
    return met.groupBy("doc_id", "text_key", F.col("a.doc_id").alias("a_id"), F.col("a.text_key").alias("a_key")).agg(
        low("pos").alias("lo"), high("pos").alias("hi"), low("a.pos").alias("a_lo"), high("a.pos").alias("a_hi"))


def word_slices(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, text_key, lo, hi, words): the words of the ``wanted`` (doc_id, text_key, lo, hi) as 32-bit hashes."""
    hashes = wanted.select(F.xxhash64("doc_id", "text_key").alias("h")).distinct()
    bits = min(max(hashes.count().bit_length() + 3, SCREEN_BITS[0]), SCREEN_BITS[1])
    packed = C.screen_of(hashes, bits)

    def hashed(batches):
        screen = C.screen_bits(packed)
        for batch in batches:
            h = batch.column(3).to_numpy().view(np.uint64)
            for ids, keys, data, offs in _chunks([batch.filter(pa.array(screen[h >> np.uint64(64 - bits)]))]):
                start, end, doc = C.spans(C.WORD_BYTES[data], offs)
                words = (C.span_hashes(data, start, end) >> np.uint64(32)).astype(np.uint32)
                edge = np.searchsorted(doc, np.arange(len(offs)))
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array([words[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())],
                    names=["doc_id", "text_key", "words"])

    # a screen of fixed size keeps documents without a pair out of the shuffle; a full one lets more through
    sent = keyed.select("doc_id", "text_key", "text", F.xxhash64("doc_id", "text_key").alias("h")) \
        .mapInArrow(hashed, "doc_id bigint, text_key bigint, words binary")
    return sent.dropDuplicates(["doc_id", "text_key"]).join(wanted.hint("merge"), ["doc_id", "text_key"]).select(
        "doc_id", "text_key", "lo", "hi",
        F.substring("words", (F.col("lo") * 4 + 1).cast("int"), ((F.col("hi") - F.col("lo")) * 4).cast("int")).alias("words"))


def _rising(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The longest chain of runs (i, j, length), given by j, that rises in i too."""
    tops, ends, back = [], [], []
    for k, (i, _, _) in enumerate(runs):
        at = bisect_left(tops, i)
        back.append(ends[at - 1] if at else -1)
        tops[at:at + 1] = [i]
        ends[at:at + 1] = [k]
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(runs[k])
        k = back[k]
    return chain[::-1]


def aligned_blocks(a: np.ndarray, b: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Ranges (first, stop) of the words of ``b`` in blocks that patience diff aligns with ``a``."""
    if min(len(a), len(b)) < min_words:
        return []
    if np.array_equal(a, b):
        return [(0, len(b))]
    hashes = []
    for x in (a, b):
        first = np.arange(len(x) - min_words + 1)
        hashes.append(C.run_hashes(C.mix(x.astype(np.uint64)), first, first + min_words))
    kinds, place, times = np.unique(hashes[0], return_index=True, return_counts=True)
    at = np.minimum(np.searchsorted(kinds, hashes[1]), len(kinds) - 1)
    left = kinds[at] == hashes[1]           # windows of b that a holds, not yet in a block
    blocks = []
    while left.any():
        todo = np.flatnonzero(left)
        found, nth, many = np.unique(at[todo], return_index=True, return_counts=True)
        once = (many == 1) & (times[found] == 1)
        if once.any():
            found, nth = found[once], nth[once]
        j = todo[nth]                       # without unique windows, the first of a kind meets the first
        order = np.argsort(j)
        j, i = j[order], place[found][order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(i) != 1) | (np.diff(j) != 1))))
        size = np.diff(np.append(new, len(j)))
        for i0, j0, n in _rising(list(zip(i[new].tolist(), j[new].tolist(), size.tolist()))):
            i1, j1 = i0 + n - 1 + min_words, j0 + n - 1 + min_words
            m = min(i0, j0)                 # word by word, to the left and to the right
            same = a[i0 - m:i0] == b[j0 - m:j0]
            wrong = np.flatnonzero(~same)
            j0 -= m - (wrong[-1] + 1 if len(wrong) else 0)
            m = min(len(a) - i1, len(b) - j1)
            wrong = np.flatnonzero(a[i1:i1 + m] != b[j1:j1 + m])
            j1 += wrong[0] if len(wrong) else m
            blocks.append((int(j0), int(j1)))
            left[j0:j1 - min_words + 1] = False
    return blocks


def duplicate_blocks(docs: DataFrame, lineage: Lineage, doc_id: str = "doc_id", text: str = "text",
                     min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, blocks): the ranges of words that each document loses."""
    keyed = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    pairs = lineage.cut(later_pairs(repeated_lines(keyed, lineage, min_words), min_words), force=True)
    held = pairs.select(F.col("a_id").alias("doc_id"), F.col("a_key").alias("text_key"), F.col("a_lo").alias("lo"),
                        F.col("a_hi").alias("hi"))
    wanted = pairs.select("doc_id", "text_key", "lo", "hi").unionByName(held).distinct()
    slices = lineage.cut(word_slices(keyed, lineage.cut(wanted, force=True)), force=True)
    earlier = slices.select(*[F.col(c).alias(f"a_{n}") for c, n in zip(slices.columns, ("id", "key", "lo", "hi", "words"))])
    met = pairs.join(earlier, ["a_id", "a_key", "a_lo", "a_hi"]).drop("a_id", "a_key", "a_lo", "a_hi") \
        .join(slices, ["doc_id", "text_key", "lo", "hi"]).select("doc_id", "text_key", "lo", "words", "a_words")

    def align(batches):
        for batch in batches:
            rows, first, stop = [], [], []
            for k, (lo, b, a) in enumerate(zip(*[batch.column(c).to_pylist() for c in (2, 3, 4)])):
                for x, y in aligned_blocks(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), min_words):
                    rows.append(k)
                    first.append(lo + x)
                    stop.append(lo + y)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(first, pa.int64()), pa.array(stop, pa.int64())],
                names=["doc_id", "text_key", "first", "stop"])

    return met.mapInArrow(align, BLOCKS).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("first", "stop"))).alias("blocks"))


def without_blocks(text: bytes, blocks: list[dict]) -> tuple[bytes, list[list[int]], int]:
    """The text left, the code-point ranges cut, and the number of lines that lose a word."""
    data = np.frombuffer(text, np.uint8)
    start, end, doc = C.spans(C.WORD_BYTES[data], np.array([0, len(data)]))
    first, stop = _joined(np.array([b["first"] for b in blocks]), np.array([b["stop"] for b in blocks]))
    begin, limit = start[first], np.append(start, len(data))[stop]
    points = C.code_points(data)
    pieces = [text[x:y] for x, y in zip([0, *limit.tolist()], [*begin.tolist(), len(text)])]
    line = np.concatenate(([0], np.cumsum(_last_words(data, start, end, doc))))[:-1]
    lost = np.zeros(len(start) + 1, np.int64)
    lost[first] += 1
    lost[stop] -= 1
    lines = len(np.unique(line[np.cumsum(lost)[:-1] > 0]))
    return b"".join(pieces), np.stack((points[begin], points[limit]), 1).tolist(), lines


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` with the new text, and ``removed_lines`` and ``cuts`` (in place of such columns)."""
    lineage = Lineage(docs.sparkSession, every=1)
    blocks = lineage.cut(duplicate_blocks(docs, lineage, doc_id, text, min_words), force=True) \
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("blocks").alias("_blocks"))
    kept = docs.drop("removed_lines", "cuts")
    rows, name = renamed(kept)
    body = F.col(name[text])
    same = (F.col(name[doc_id]).cast("bigint") == F.col("_id")) & (F.xxhash64(body) == F.col("_key"))
    # the list of deletions grows with the input: it is never broadcast, at any size
    joined = rows.join(blocks.hint("merge"), same, "left").drop("_id", "_key")
    schema = joined.select(*rows.columns, F.lit(None).cast("array<array<bigint>>").alias("_cuts"),
                           F.lit(0).cast("bigint").alias("_removed")).schema

    place, names = rows.columns.index(name[text]), schema.names

    def cut(batches):
        for batch in batches:
            texts, cuts, removed = batch.column(place), [], []
            changed = [None] * batch.num_rows
            for k, b in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                out = without_blocks(texts[k].as_buffer().to_pybytes(), b) if b else None
                changed[k] = out[0].decode() if out else None
                cuts.append(out[1] if out else [])
                removed.append(out[2] if out else 0)
            new = pa.array(changed, pa.string())
            columns = list(batch.columns[:-1])
            columns[place] = pa.compute.if_else(new.is_valid(), new, texts.cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(cuts, pa.list_(pa.list_(pa.int64()))), pa.array(removed, pa.int64())],
                names=names)

    return restored(joined.mapInArrow(cut, schema), kept, name, F.col("_removed").alias("removed_lines"),
                    F.col("_cuts").alias("cuts"))
