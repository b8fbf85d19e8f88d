"""Vectorised text helpers for Arrow tasks: word spans, rolling hashes, runs.

All of them work on the UTF-8 bytes of many documents at once.  Documents are
taken in chunks of ``CHUNK_BYTES`` (a longer document is a chunk of its own),
so the numpy temporaries of a task are bounded by the chunk, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
U64 = np.uint64

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"n": 0, "pow": None, "inv": None}

#: ASCII white space: the bytes 0x09-0x0D and 0x20; UTF-8 uses them for nothing else.
WORD_BYTES = np.ones(256, dtype=bool)
WORD_BYTES[[9, 10, 11, 12, 13, 32]] = False
#: ASCII letters and digits, and every byte of a code point from U+0080 on.
ALNUM_BYTES = np.zeros(256, dtype=bool)
ALNUM_BYTES[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, offsets


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Ranges (lo, hi) of documents holding about ``limit`` bytes each."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each maximal run of ``inside`` bytes within a document."""
    n = len(inside)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    full = offs[1:] > offs[:-1]
    first, last = offs[:-1][full], offs[1:][full] - 1
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    prev[first] = False
    start = np.flatnonzero(inside & ~prev)
    prev[-1] = False
    prev[:-1] = inside[1:]
    prev[last] = False
    end = np.flatnonzero(inside & ~prev) + 1
    return start, end, np.searchsorted(offs, start, "right") - 1


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("pow", _BASE), ("inv", _BASE_INV)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
        _powers["n"] = size
    return _powers["pow"], _powers["inv"]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from one rolling (prefix) hash of the chunk."""
    power, inverse = _power_tables(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODE[buf] * power[:len(buf)], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * inverse[start]
    return mix(h + (end - start).astype(np.uint64) * U64(0xD1B54A32D192ED03))


def run_hashes(h: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each run ``h[first:stop]``, from one rolling hash over the entries."""
    power, inverse = _power_tables(len(h) + 1)
    prefix = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * power[:len(h)], out=prefix[1:])
    return mix((prefix[stop] - prefix[first]) * inverse[first]
               + (stop - first).astype(np.uint64) * U64(0xD1B54A32D192ED03))


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive entries (rolled up one entry at a time)."""
    g = h[: max(0, len(h) - n + 1)].copy()
    for k in range(1, n):
        g = extend(g, h, k + 1)
    return g


def extend(g: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """From the hashes of n-1 entries to those of n entries."""
    m = max(0, len(h) - n + 1)
    return mix(g[:m] * U64(_BASE) + h[n - 1: n - 1 + m])


def run_starts(ordered: np.ndarray) -> np.ndarray:
    """Index of the first entry of each run of equal values."""
    if len(ordered) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def code_points(buf: np.ndarray) -> np.ndarray:
    """Prefix counts of code points: entry i is the number before byte i."""
    out = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def screen_of(hashes, bits: int) -> np.ndarray:
    """Packed screen of 2**bits bits with the top bits of each hash set.

    ``hashes`` is a DataFrame with one bigint column; Spark packs 64 bits to a row, so 2**(bits - 6)
    rows at most come to the driver, however many hashes there are.
    """
    from pyspark.sql import functions as F
    slot = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    rows = hashes.select(slot.alias("s")).select(
        F.shiftright("s", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(s & 63 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return words.view(np.uint8)


def screen_bits(screen: np.ndarray) -> np.ndarray:
    """The screen as booleans."""
    return np.unpackbits(screen, bitorder="little").astype(bool)
