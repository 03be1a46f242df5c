"""Encodings of text pieces that a Python worker has met before."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from loomtext.llm.bytewise import prefix_hash, span_hash


_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _looks(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(length, first eight bytes, last eight bytes) of each piece; shorter ones are filled with zeros."""
    words = np.ndarray((len(raw) + 1,), "<u8", np.concatenate((raw, np.zeros(8, np.uint8))).data, 0, (1,))
    size = end - start
    mask = _MASK[np.minimum(size, 8)]
    return np.stack((size.astype(np.uint64), words[start] & mask, words[np.maximum(end - 8, start)] & mask), axis=1)


class Memo:
    """Maps pieces of a byte buffer to id lists; what is new goes to ``encode`` (spans of the buffer), once.

    A piece is known by its hash, its length, and its first and last eight bytes; should pieces share a hash and not the
    rest, all of that call are encoded anew. It holds ``limit`` pieces at most, about 64 bytes each; when full it is emptied.
    """

    def __init__(self, encode: Callable[[bytes, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], limit: int):
        self.encode, self.limit = encode, limit
        self.forget()

    def forget(self) -> None:
        self.keys, self.start, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.looks = np.empty((0, 3), np.uint64)
        self.ids = np.empty(0, np.uint32)

    def lookup(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each piece) of the pieces ``raw[start:end]``, one after the other."""
        if not len(start):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        looks = _looks(raw, start, end)
        keys, first, which = np.unique(span_hash(prefix_hash(raw), start, end), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.limit:
            self.forget()
        fresh = np.ones(len(keys), bool)
        if len(self.keys):
            fresh = self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys
        if fresh.any():
            ids, count = self.encode(raw.tobytes(), start[first[fresh]], end[first[fresh]])
            begin = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate((self.ids, ids.astype(np.uint32)))
            at = np.searchsorted(self.keys, keys[fresh])
            self.keys, self.start, self.count = (np.insert(a, at, b) for a, b in ((self.keys, keys[fresh]), (self.start, begin), (self.count, count)))
            self.looks = np.insert(self.looks, at, looks[first[fresh]], axis=0)
        at = np.searchsorted(self.keys, keys)[which]
        if (self.looks[at] != looks).any():
            return self.encode(raw.tobytes(), start, end)
        count = self.count[at]
        stops = np.cumsum(count)
        return self.ids[np.arange(int(stops[-1])) + np.repeat(self.start[at] - (stops - count), count)], count
