"""Byte-level helpers and suffix arrays, and the removal of repeated strings."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from loomtext.llm import bytewise, repeats, suffixes


def test_buffers_and_chunks():
    column = pa.array(["ab", None, "", "é", "x" * 50]).slice(1)
    raw, offsets = bytewise.buffer_of(column)
    assert raw.tobytes() == ("é" + "x" * 50).encode() and offsets.tolist() == [0, 0, 0, 2, 52]
    parts = list(bytewise.chunks(column, 4))
    assert [(lo, hi) for lo, hi, *_ in parts] == [(0, 3), (3, 4)] and parts[1][2].tobytes() == b"x" * 50
    assert list(bytewise.chunks(pa.array([], pa.string()))) == []


def test_shingles_follow_words_not_spacing():
    raw, offsets = bytewise.buffer_of(pa.array(["A b  c d", "a B\tc d", "a b", "", "x"]))
    hashes, text = bytewise.shingles(*bytewise.word_hashes(raw, offsets), 3)
    assert text.tolist() == [0, 0, 1, 1, 2, 4] and hashes[:2].tolist() == hashes[2:4].tolist() and len(set(hashes.tolist())) == 4


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(150):
        n, letters = rng.randint(0, 200), rng.choice([1, 2, 3, 200])
        text = np.array([rng.randint(1, letters) for _ in range(n)] + [0], np.uint8)
        text[n // 2] *= rng.random() < 0.5 or n < 4
        raw = text.tobytes()
        order = sorted(range(n + 1), key=lambda i: raw[i:])
        assert suffixes.suffix_array(text, 400).tolist() == order
        padded = raw + bytes(500)
        shared = [next((k for k in range(400) if padded[a + k] != padded[b + k]), 400) for a, b in zip(order, order[1:])]
        assert suffixes.common_prefixes(text, np.array(order), 400).tolist() == [0, *shared]


def brute(rows, length):
    counts, out = {}, []
    raw = [(t or "").encode() for _, t in rows]
    for x in raw:
        for p in range(len(x) - length + 1):
            counts[x[p : p + length]] = counts.get(x[p : p + length], 0) + 1
    for (i, _), x in zip(rows, raw):
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            if counts[x[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(gone)))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def removed(docs, **k):
    return sorted((tuple(r) for r in repeats.drop_repeats(docs, **k).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_repeats(docs, rows, empty):
    for length, gram in ((400, 96), (60, 20)):
        assert removed(docs, length=length, gram=gram) == brute(rows, length)
    assert removed(empty) == []


def test_repeats_of_crowded_anchors(docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_CONTEXTS", 1)
    assert removed(docs, length=60, gram=20) == brute(rows, 60)


def test_repeats_within_long_texts(spark):
    """A text beyond the piece that is worked on at once, and a copy of most of it at another place."""
    rng = np.random.default_rng(4)
    long = rng.integers(97, 123, 1_300_000, np.uint8).tobytes().decode()
    texts = [long, "0" + long[:700_000] + "1", long[100:499], long[1_048_000:1_049_000]]
    got = {r.doc_id: r for r in repeats.drop_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[k].n_removed for k in range(4)] == [701_000, 700_000, 0, 1_000] and list(got[1].spans) == [1, 700_001]


def test_hashes_of_spans_do_not_depend_on_their_place():
    raw = np.random.default_rng(5).integers(0, 256, 200_000, np.uint8)
    raw[150_000:150_500] = raw[70:570]
    raw[65_400:65_900] = raw[70:570]
    hashes = bytewise.span_hash(bytewise.prefix_hash(raw), np.array([70, 65_400, 150_000, 71]), np.array([570, 65_900, 150_500, 571]))
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3]


def test_removed_spans_give_the_kept_bytes(docs):
    for r in repeats.drop_repeats(docs.where(F.col("doc_id") > 10), length=60, gram=20).where("kept is not null").collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed
