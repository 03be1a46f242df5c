"""Vectorised work on the bytes of many texts at once.

A text column of an Arrow batch is one byte buffer with offsets. Words, shingles and span hashes are computed over the
whole buffer with NumPy, so no Python object is made for a word. Buffers are cut into chunks of whole texts, about half
a megabyte each, which bounds memory; a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
#: Fixed odd multiplier of the span hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_STEP = 1 << 16


def _table(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


#: BASE**i and BASE**-i modulo 2**64 for i below _STEP; a long text needs one more number for each _STEP bytes.
_POWERS = [_table(base, _STEP) for base in (BASE, pow(BASE, -1, 1 << 64))]
_STRIDE = [pow(BASE, _STEP, 1 << 64), pow(BASE, -_STEP, 1 << 64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        return buffer_of(column.cast(pa.string()))
    if column.null_count:
        column = column.fill_null("" if "string" in str(column.type) else b"")
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of whole texts of about ``limit`` bytes."""
    raw, offsets = buffer_of(column)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running sums from which span_hash() takes the hash of any span."""
    out = np.zeros(len(raw) + 1, np.uint64)
    scale = 1
    for at in range(0, len(raw), _STEP):
        part = raw[at : at + _STEP]
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * (_POWERS[0][: len(part)] * np.uint64(scale)), out=out[at + 1 : at + 1 + len(part)])
        out[at + 1 : at + 1 + len(part)] += out[at]
        scale = scale * _STRIDE[0] % (1 << 64)
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, the same wherever these bytes stand."""
    back = _POWERS[1][start & (_STEP - 1)]
    if len(sums) > _STEP:
        back = back * _table(_STRIDE[1], -(-len(sums) // _STEP))[start >> 16]
    return mix((sums[end] - sums[start]) * back + (end - start).astype(np.uint64))


def word_spans(raw: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each word: a maximal run of bytes for which ``space`` is false, within one text."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = ~space[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def table_of(chars: bytes) -> np.ndarray:
    """A table that is true for the given bytes."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: ASCII white space: tab to carriage return, and space.
ASCII_SPACE = table_of(b"\t\n\x0b\x0c\r ")
#: Lower-cases A-Z alone.
LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each word of the texts after lower-casing A-Z; words are split at ASCII white space."""
    start, end, text = word_spans(raw, offsets, ASCII_SPACE)
    return span_hash(prefix_hash(LOWER[raw]), start, end), text


def shingles(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each run of ``size`` words; a text with fewer words, but not none, gives all of them as one."""
    if not len(hashes):
        return hashes, text
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    count = np.diff(np.append(first, len(text)))
    short = count < size
    take = np.repeat(np.where(short, 1, count - size + 1), count)
    place = np.arange(len(text)) - np.repeat(first, count)
    at = np.flatnonzero(place < take)
    width = np.minimum(size, np.repeat(count, count))[at]
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        use = width > k
        out[use] = mix(out[use] * np.uint64(3) + hashes[at[use] + k] + np.uint64(k + 1))
    return out, text[at]
