"""Elias-Fano coded monotone sequences and bit-packed arrays over plain bytes (numpy, no copies on opening)."""

from __future__ import annotations

import numpy as np

_BLOCK = 1 << 16  # values packed at a time; a multiple of 8, so blocks end at whole bytes


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """``values`` at ``width`` bits each, little-endian, with 8 spare bytes for unaligned reads."""
    out = []
    for s in range(0, len(values) if width else 0, _BLOCK):
        raw = np.ascontiguousarray(values[s : s + _BLOCK].astype("<u8")).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
        out.append(np.packbits(bits.reshape(-1), bitorder="little").tobytes())
    return b"".join(out) + bytes(8)


def read_bits(raw: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The values numbered ``at`` of a packed array (``width`` up to 56)."""
    if not width or not len(at):
        return np.zeros(len(at), dtype=np.uint64)
    words = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    bit = at.astype(np.int64) * width
    return (words[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class EliasFano:
    """Values v[0] <= v[1] <= ... below 2^universe_bits: low bits packed, high parts in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low = n, low_bits, low
        ones = np.flatnonzero(np.unpackbits(high, bitorder="little"))[:n]
        self.tops = (ones - np.arange(n)).astype(np.uint64)

    @staticmethod
    def encode(values: np.ndarray, universe_bits: int) -> dict:
        n = len(values)
        low_bits = max(0, min(56, universe_bits - max(n, 1).bit_length()))
        tops = (values.astype(np.uint64) >> np.uint64(low_bits)).astype(np.int64)
        bits = np.zeros(n + (int(tops[-1]) if n else 0) + 1, dtype=np.uint8)
        bits[tops + np.arange(n)] = 1
        low = pack_bits(values.astype(np.uint64) & np.uint64((1 << low_bits) - 1), low_bits)
        return {"n": n, "low_bits": low_bits, "low": low, "high": np.packbits(bits, bitorder="little").tobytes()}

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.tops[at] << np.uint64(self.low_bits)) | read_bits(self.low, at, self.low_bits)

    def successor(self, values: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Places of the first element >= each value, within [begin, end) (end if there is none)."""
        values = values.astype(np.uint64)
        top = values >> np.uint64(self.low_bits)
        rest = values & np.uint64((1 << self.low_bits) - 1)
        stop = np.broadcast_to(np.asarray(self.n if end is None else end, dtype=np.int64), values.shape)
        lo = np.maximum(np.searchsorted(self.tops, top), begin).astype(np.int64)
        hi = np.minimum(np.searchsorted(self.tops, top, side="right"), stop).astype(np.int64)
        lo = np.minimum(lo, stop)
        hi = np.maximum(hi, lo)
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) >> 1
            less = read_bits(self.low, mid, self.low_bits) < rest[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
        return lo
