"""Vectorised text helpers that run inside Spark tasks.

A batch of texts is one Arrow buffer of UTF-8 bytes plus row offsets.  All
the separators of the operators are ASCII, so words and lines are found on
the bytes, for many texts at once, without a Python object per word.

Words and lines are compared by 64-bit hashes of their whole bytes (with
seeds fixed here, so equal in every task and run).
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer single text is one piece.
PIECE_BYTES = 2 << 20

_K1 = np.uint64(0xD6E8FEB86659FD93)
_K2 = np.uint64(0x9E3779B97F4A7C15)
_S32 = np.uint64(32)
_LONG = 1024  # spans beyond this many bytes are hashed one by one

try:  # glibc only
    _TRIM = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):
    _TRIM = None

_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=np.uint64)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Look-up table that is True for the given inclusive byte ranges."""
    table = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Bytes of a word between white space: all but \x20 and \x09-\x0D.
SPACED_WORD = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Bytes of an alphanumeric word: 0-9, a-z and everything beyond ASCII.
ALNUM_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: ASCII lower case, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pieces(texts: pa.Array, max_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over an Arrow string array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, off_buf, data_buf = texts.buffers()
    offsets = np.frombuffer(off_buf, dtype=width, count=n + 1 + texts.offset)[texts.offset :].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and offsets[-1] else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1)
        base = offsets[lo]
        yield lo, hi, data[base : offsets[hi]], offsets[lo : hi + 1] - base
        lo = hi
    release()


def release() -> None:
    """Hand freed memory back to the system; else each of a machine's workers keeps the most it ever used."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and lengths of the words, and the word offsets of the texts."""
    inside = table[data]
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    lens = np.flatnonzero(last) + 1 - starts
    return starts, lens, np.searchsorted(starts, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and lengths of the \\n-split lines (an empty text has one), and line offsets of the texts."""
    breaks = np.flatnonzero(data == 10)
    # a text begins a line, and so does the byte after each break
    starts = np.concatenate([offsets[:-1], breaks + 1])
    rows = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((starts, rows))
    starts, rows = starts[order], rows[order]
    line_off = np.searchsorted(rows, np.arange(len(offsets)))
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[line_off[1:] - 1] = offsets[1:]
    return starts, ends - starts, line_off


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> _S32)) * _K1
    x = (x ^ (x >> _S32)) * _K1
    return x ^ (x >> _S32)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair (a, b)."""
    return mix(a * _K2 + (b ^ (a >> _S32)))


def hash_spans(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    at = np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = mix(lens.astype(np.uint64) * _K2 + np.uint64(1))
    h = mix(h ^ (at[starts] & _MASKS[np.minimum(lens, 8)]))
    left = np.flatnonzero((lens > 8) & (lens <= _LONG))
    done = 8
    while len(left):
        x = at[starts[left] + done] & _MASKS[np.minimum(lens[left] - done, 8)]
        h[left] = mix(h[left] * _K2 ^ x)
        done += 8
        left = left[lens[left] > done]
    for i in np.flatnonzero(lens > _LONG):
        span = data[starts[i] : starts[i] + lens[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(span, digest_size=8).digest(), "little")
    return h


def sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (one per byte or word) between consecutive offsets."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs at least twice."""
    out = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        order = np.argsort(keys)
        k = keys[order]
        same = k[1:] == k[:-1]
        hit = np.zeros(len(keys), dtype=bool)
        hit[1:] |= same
        hit[:-1] |= same
        out[order] = hit
    return out


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each element, from the rows' offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark longs (same bits)."""
    return x.astype(np.uint64).view(np.int64)
