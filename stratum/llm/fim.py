"""Fill-in-middle transformation as a pyarrow.compute pipeline.

Per Arrow batch, without a loop over rows:

1. A text is split into units (code points) as a list array over the text's own bytes.
2. The lists are flattened, and every unit gets its parent row and its ordinal in it.
3. Two cuts per row give each unit a role: prefix, middle or suffix.
4. The units are filtered by role, and each role's lists are rebuilt.
5. ``binary_join`` joins the units of a list to a piece, and the pieces of a row
   with the sentinels: ``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is
   <S>suffix<P>prefix<M>middle, ``plain`` is the text.

Draws are the first four 8-digit groups of sha256(``seed``:``doc_id``), so reruns
agree and rows need not know each other.  With n units the cuts are the smaller and
the larger of h1 % (n+1) and h2 % (n+1); h3 % 100 >= ``percent`` leaves a text
plain and h4 % 100 < ``spm_percent`` gives the suffix first.

Memory: units are made for about 1 MB of texts at a time (a longer text is a
chunk of its own), and about 40 bytes are held for a unit.

Defined cases: a null text counts as empty; an empty text and a text that holds a
sentinel stay plain, so that ``restore`` is exact; a null id draws as the empty
string; rows with equal ids cut alike; an empty table gives an empty result; very
long texts are cut whole; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import columnar as C

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PERCENT, SPM_PERCENT, SEED = 90, 20, 1
CHUNK_BYTES = 1 << 20
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def check_sentinels(sentinels: list[str]) -> None:
    """Sentinels must be found where they were put: none may overlap another or itself."""
    for i, a in enumerate(sentinels):
        for j, b in enumerate(sentinels):
            if not a or (i != j and a in b) or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels overlap: {a!r}, {b!r}")


def units(texts: pa.Array) -> pa.LargeListArray:
    """The code points of each text, as lists over the text's own bytes."""
    buf, offs = C.text_bytes(texts)
    data = buf[offs[0]:offs[-1]]
    starts = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int64)
    edges = np.searchsorted(starts, offs - offs[0])
    points = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data))
    return pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), points)


def _remainder(x: pa.Array, n: pa.Array) -> pa.Array:
    return pc.subtract(x, pc.multiply(pc.divide(x, n), n))


def _pieces(flat: pa.Array, parents: pa.Array, role: pa.Array, rows: int) -> pa.Array:
    """The units of one role, joined to one piece for each row."""
    chosen, of = flat.filter(role), parents.filter(role).to_numpy()
    lists = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int64()), chosen)
    return pc.binary_join(lists, pa.scalar("", pa.large_string()))


def _joined(*parts) -> pa.Array:
    text = [p if isinstance(p, pa.Array) else pa.scalar(p, pa.large_string()) for p in parts]
    return pc.binary_join_element_wise(*text, pa.scalar("", pa.large_string()))


def arrange(texts: pa.Array, h: list[pa.Array], percent: int, spm_percent: int, sentinels: list[str]) -> dict:
    """The columns of ``SCHEMA`` after ``doc_id`` for some texts and their four draws."""
    texts = texts.fill_null("").cast(pa.large_string())
    lists = units(texts)
    n = pc.list_value_length(lists).cast(pa.int64())
    ends = pc.add(n, 1)
    one, two = _remainder(h[0], ends), _remainder(h[1], ends)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), pc.take(lists.offsets, parents))
    after_low = pc.greater_equal(ordinals, pc.take(low, parents))
    before_high = pc.less(ordinals, pc.take(high, parents))
    prefix = _pieces(flat, parents, pc.invert(after_low), len(texts))
    middle = _pieces(flat, parents, pc.and_(after_low, before_high), len(texts))
    suffix = _pieces(flat, parents, pc.invert(before_high), len(texts))
    plain = pc.or_(pc.equal(n, 0), pc.greater_equal(_remainder(h[2], pa.scalar(100)), percent))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(texts, s))
    spm = pc.less(_remainder(h[3], pa.scalar(100)), spm_percent)
    p, s, m = sentinels
    output = pc.case_when(pc.make_struct(plain, spm), texts, _joined(s, suffix, p, prefix, m, middle),
                          _joined(p, prefix, s, suffix, m, middle))
    nothing = pa.scalar(None, pa.int64())
    return {"n": n, "form": pc.case_when(pc.make_struct(plain, spm), "plain", "spm", "psm"),
            "prefix_chars": pc.if_else(plain, nothing, low),
            "middle_chars": pc.if_else(plain, nothing, pc.subtract(high, low)), "output": output}


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT,
                   spm_percent: int = SPM_PERCENT, seed: int = SEED,
                   sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of ``docs``."""
    check_sentinels(list(sentinels))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]

    def run(batches):
        for batch in batches:
            _, offsets = C.text_bytes(batch.column(1))
            for lo, hi in C.chunks(offsets, CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                out = arrange(part.column(1), [part.column(2 + k) for k in range(4)], percent, spm_percent,
                              list(sentinels))
                out["output"] = out["output"].cast(pa.string())
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0)} | out)

    return docs.select(F.col(doc_id).cast("bigint"), F.col(text).cast("string"), *draws).mapInArrow(run, SCHEMA)


def original(output: pa.Array, form: pa.Array, sentinels: list[str]) -> pa.Array:
    """The texts from which ``output`` was arranged."""
    p, s, m = sentinels
    output = output.cast(pa.large_string())

    def between(head, rest):
        """What follows ``head``, cut at the first ``rest`` and there at the first middle sentinel."""
        body = pc.utf8_slice_codeunits(output, len(head))
        first = pc.split_pattern(body, rest, max_splits=1)
        back = pc.list_element(pc.if_else(pc.equal(pc.list_value_length(first), 2), first,
                                          pa.scalar(["", m], first.type)), 1)
        second = pc.split_pattern(back, m, max_splits=1)
        second = pc.if_else(pc.equal(pc.list_value_length(second), 2), second, pa.scalar(["", ""], second.type))
        return pc.list_element(first, 0), pc.list_element(second, 0), pc.list_element(second, 1)

    prefix, suffix, middle = between(p, s)
    psm = _joined(prefix, middle, suffix)
    suffix, prefix, middle = between(s, p)
    spm = _joined(prefix, middle, suffix)
    return pc.case_when(pc.make_struct(pc.equal(form, "plain"), pc.equal(form, "spm")), output, spm, psm)


def restore(arranged: DataFrame, output: str = "output", form: str = "form", restored: str = "restored",
            sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``arranged`` with the text rebuilt from ``output`` and ``form`` in ``restored`` (in place of such a column)."""
    check_sentinels(list(sentinels))
    kept = arranged.drop(restored)
    schema = kept.select("*", F.lit("").alias(restored)).schema

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            _, offsets = C.text_bytes(batch.column(names.index(output)))
            for lo, hi in C.chunks(offsets):
                part = batch.slice(lo, hi - lo)
                column = original(part.column(names.index(output)), part.column(names.index(form)), list(sentinels))
                yield pa.RecordBatch.from_arrays([*part.columns, column.cast(pa.string())], names=[*names, restored])

    return kept.mapInArrow(run, schema)
