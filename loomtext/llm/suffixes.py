"""Suffix arrays of bounded blocks by two-stage sorting, in NumPy.

A suffix smaller than its successor is of type S, any other of type L. Only the S suffixes are sorted directly. The L
suffixes follow by scanning the buckets of equal first bytes in rising order: a suffix that has its place hands the next
free place of its bucket to the suffix one position to the left. Within a bucket L suffixes precede S suffixes.

The order is exact up to ``depth`` bytes and arbitrary among suffixes that agree on so many.
"""

from __future__ import annotations

import numpy as np

from loomtext.llm.bytewise import prefix_hash, span_hash

_WORD = 8
_ROUNDS = 4


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes at every position as a big-endian number."""
    return np.ndarray((len(text) - _WORD + 1,), ">u8", text.data, 0, (1,)).astype(np.uint64)


def is_smaller(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor; the last one, of the end mark, counts as smaller."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = 1
    #: equal neighbours take the type of the next position that differs
    decided = np.where(step != 0, np.arange(n), n)
    following = np.minimum.accumulate(decided[::-1])[::-1]
    return step[following] > 0


def _sort_directly(which: np.ndarray, text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``which`` by their first ``depth`` bytes: a few rounds of eight bytes, each on what is still tied.

    What is tied after these shares a long prefix; fingerprints of ``depth`` bytes show which of it is equal, and the
    rest is sorted as byte strings.
    """
    order = which[np.argsort(words[which])]
    keys = words[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    at, group = np.arange(len(order)), np.cumsum(new) - 1
    for offset in range(_WORD, _WORD * _ROUNDS, _WORD):
        size = np.bincount(group)
        keep = (size > 1)[group]
        at, group = at[keep], group[keep]
        if not len(at):
            return order
        key = words[order[at] + offset]
        by = np.lexsort((key, group))
        order[at] = order[at][by]
        key = key[by]
        group = np.cumsum(np.concatenate(([0], (group[1:] != group[:-1]) | (key[1:] != key[:-1]))))
    keep = (np.bincount(group) > 1)[group]
    at, group = at[keep], group[keep]
    if not len(at):
        return order
    place = order[at]
    prints = span_hash(prefix_hash(text), place, place + depth)
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    mixed = np.minimum.reduceat(prints, first) != np.maximum.reduceat(prints, first)
    raw = text.tobytes()
    for lo, hi in zip(first[mixed], np.append(first[1:], len(at))[mixed], strict=True):
        order[at[lo:hi]] = sorted(place[lo:hi].tolist(), key=lambda p: raw[p : p + depth])
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes. Its last byte must be 0, an end mark."""
    padded = np.concatenate((text, np.zeros(depth + _WORD, np.uint8)))
    smaller = is_smaller(text)
    direct = _sort_directly(np.flatnonzero(smaller), padded, _words(padded), depth)
    starts = np.searchsorted(text[direct], np.arange(257))
    handed: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        if not handed[c] and starts[c] == starts[c + 1]:
            continue
        larger = []
        now = np.concatenate(handed[c]) if handed[c] else np.empty(0, np.int64)
        while len(now):  # a run of one byte hands places within its own bucket
            larger.append(now)
            before = now[now > 0] - 1
            now = before[text[before] == c]
        bucket = np.concatenate((*larger, direct[starts[c] : starts[c + 1]]))
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = text[before]
        up = first > c
        before, first = before[up], first[up]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        if len(first):
            edges = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1], [True])))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                handed[first[lo]].append(before[lo:hi])
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each of the suffixes in ``order``, how many bytes it shares with the one before it, ``depth`` at most."""
    padded = np.concatenate((text, np.zeros(depth + _WORD, np.uint8)))
    words = _words(padded)
    out = np.zeros(len(order), np.int64)
    a, b, at = order[:-1], order[1:], np.arange(1, len(order))
    for offset in range(0, depth, _WORD):
        x, y = words[a + offset], words[b + offset]
        differ = x != y
        if differ.any():
            d = np.flatnonzero(differ)
            gap = (x[d] ^ y[d]).astype(np.uint64)
            lead = np.zeros(len(d), np.int64)
            for k in (32, 16, 8):
                clear = (gap >> np.uint64(64 - k)) == 0
                lead[clear] += k // 8
                gap[clear] <<= np.uint64(k)
            out[at[d]] = offset + lead
            go = ~differ
            a, b, at = a[go], b[go], at[go]
        if not len(at):
            break
    out[at] = depth
    return np.minimum(out, depth)
