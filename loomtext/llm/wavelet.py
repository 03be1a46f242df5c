"""Wavelet matrix of a token sequence: bit planes with rank and select, in one self-describing byte string.

Layout, little-endian: the mark LTWM, u16 version, u16 planes, u64 tokens, u64 documents; u64 zeros of each plane; i64
document ids; u64 end of each document; then plane by plane, highest bit first, its bits (bit i of byte j is token
8 * j + i) padded to whole blocks, and u32 ones before each block of BLOCK bits.
"""

from __future__ import annotations

import struct

import numpy as np

MARK, VERSION = b"LTWM", 1
BLOCK = 512
_HEAD = struct.Struct("<4sHHQQ")


def _narrow(width: int):
    return np.uint16 if width <= 16 else np.uint32


def pack(tokens: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """The byte string of ``tokens`` (values below 2**width), which hold documents that end at ``ends``."""
    now = tokens.astype(_narrow(width))
    n = len(now)
    blocks = -(-n // BLOCK)
    zeros, planes = [], []
    for bit in range(width - 1, -1, -1):
        ones = ((now >> bit) & 1).astype(bool)
        bits = np.zeros(blocks * BLOCK // 8, np.uint8)
        bits[: -(-n // 8)] = np.packbits(ones, bitorder="little")
        counts = np.bitwise_count(bits.view(np.uint64)).reshape(blocks, BLOCK // 64).sum(axis=1, dtype=np.int64)
        planes += [bits.tobytes(), (np.cumsum(counts) - counts).astype("<u4").tobytes()]
        left = np.compress(~ones, now)
        zeros.append(len(left))
        now = np.concatenate((left, np.compress(ones, now)))
    head = _HEAD.pack(MARK, VERSION, width, n, len(doc_ids))
    return b"".join([head, np.array(zeros, "<u8").tobytes(), doc_ids.astype("<i8").tobytes(), ends.astype("<u8").tobytes(), *planes])


class WaveletMatrix:
    """Reads a packed byte string without unpacking it."""

    def __init__(self, raw: bytes):
        mark, version, self.width, self.n, docs = _HEAD.unpack_from(raw)
        if mark != MARK or version != VERSION:
            raise ValueError("not a packed token file of this version")
        at = _HEAD.size
        self.zeros = np.frombuffer(raw, "<u8", self.width, at).astype(np.int64)
        at += 8 * self.width
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        self.ends = np.frombuffer(raw, "<u8", docs, at + 8 * docs).astype(np.int64)
        at += 16 * docs
        blocks = -(-self.n // BLOCK)
        self.bits, self.ranks = [], []
        for _ in range(self.width):
            self.bits.append(np.frombuffer(raw, np.uint8, blocks * BLOCK // 8, at))
            at += blocks * BLOCK // 8
            self.ranks.append(np.frombuffer(raw, "<u4", blocks, at))
            at += 4 * blocks

    def __len__(self) -> int:
        return self.n

    def _bit(self, plane: int, i: int) -> int:
        return int(self.bits[plane][i >> 3] >> (i & 7)) & 1

    def _ones(self, plane: int, i: int) -> int:
        """Ones before place ``i``."""
        if i >= self.n:
            return self.n - int(self.zeros[plane])
        block = i // BLOCK
        part = self.bits[plane][block * BLOCK // 8 : (i >> 3) + 1].copy()
        part[-1] &= (1 << (i & 7)) - 1
        return int(self.ranks[plane][block]) + int(np.bitwise_count(part).sum())

    def access(self, i: int) -> int:
        """The token at place ``i``."""
        out = 0
        for plane in range(self.width):
            bit, ones = self._bit(plane, i), self._ones(plane, i)
            i = int(self.zeros[plane]) + ones if bit else i - ones
            out = out * 2 + bit
        return out

    def _range(self, token: int, upto: int) -> tuple[int, int]:
        """Where the occurrences of ``token`` before place ``upto`` stand below the last plane."""
        lo, hi = 0, upto
        for plane in range(self.width):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            if token >> (self.width - 1 - plane) & 1:
                lo, hi = int(self.zeros[plane]) + a, int(self.zeros[plane]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, upto: int | None = None) -> int:
        """How often ``token`` occurs before place ``upto``, or at all."""
        lo, hi = self._range(token, self.n if upto is None else upto)
        return hi - lo

    def _find(self, plane: int, bit: int, count: int) -> int:
        """The place of the ``count``-th (from 0) ``bit`` of a plane."""
        ranks = self.ranks[plane].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, count, "right")) - 1
        bits = np.unpackbits(self.bits[plane][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[count - int(before[block])])

    def select(self, token: int, count: int) -> int:
        """The place of the ``count``-th (from 0) occurrence of ``token``."""
        lo, hi = self._range(token, self.n)
        if not 0 <= count < hi - lo:
            raise IndexError("no such occurrence")
        i = lo + count
        for plane in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - plane) & 1
            i = self._find(plane, bit, i - int(self.zeros[plane]) if bit else i)
        return i

    def tokens(self) -> np.ndarray:
        """The whole sequence, plane by plane from the lowest."""
        kind = _narrow(self.width)
        now = np.zeros(self.n, kind)
        for plane in range(self.width - 1, -1, -1):
            ones = np.unpackbits(self.bits[plane], count=self.n, bitorder="little").view(bool)
            split = int(self.zeros[plane])
            up = np.empty(self.n, kind)
            high = now[split:]
            high |= kind(1 << (self.width - 1 - plane))
            for bits, part in ((~ones, now[:split]), (ones, high)):
                if len(part):
                    np.place(up, bits, part)
            now = up
        return now
