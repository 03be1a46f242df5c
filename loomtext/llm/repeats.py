"""Removal of long repeated byte strings over a whole corpus, by suffix arrays.

One suffix array of 100 TB is not built; the suffixes are dealt out so that equal strings of ``length`` bytes meet in
one bounded block. In each such string the smallest hash of a gram marks an anchor, and equal strings have equal
anchors. Consecutive string starts with one anchor form a context, a few hundred bytes that hold all these strings.
Contexts are counted by anchor and by content before any byte of them moves; where an anchor occurs at least twice, each
distinct context is cut once, with its number of copies. Blocks of contexts are sorted by two-stage suffix sorting, and
adjacent common prefixes of ``length`` bytes show the repeated strings.

An anchor with more distinct contexts than a block holds (the edge of a passage that very many documents share) is thinned
first: the starts of a context fall into cells, and all strings of a cell have a core in common, so a cell whose core
stands nowhere else has no repeated string. What is left of the contexts is cut again and counted by content; should
it still be more than a block, blocks meet in pairs. The suffix arrays decide in every case.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.bytewise import buffer_of, chunks, prefix_hash, span_hash
from loomtext.llm.staging import staged
from loomtext.llm.suffixes import common_prefixes, suffix_array

#: Bytes of a repeated string and of the grams whose hashes mark anchors.
LENGTH = 400
GRAM = 96
#: Bytes of a block, and distinct contexts of one anchor that a block takes.
BLOCK_BYTES = 1 << 20
BLOCK_CONTEXTS = 2048
#: Starts of one cell of a crowded anchor's contexts; less than the length of a string.
CELL = 16
#: Bytes of a long text that are worked on at once.
PIECE_BYTES = 1 << 19


def _argmin_windows(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` keys, from running minima within blocks of that width."""
    n = len(keys) - width + 1
    blocks = -(-len(keys) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """(text, anchor hash, context hash, first and last start within the text) of every context of the texts."""
    empty = np.empty(0, np.int64)
    width = length - gram + 1
    if len(raw) < length:
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty
    sums = prefix_hash(raw)
    at = np.arange(len(raw) - gram + 1)
    grams = span_hash(sums, at, at + gram)
    low = np.uint64((1 << int(len(grams)).bit_length()) - 1)
    anchor = (_argmin_windows((grams & ~low) | at.astype(np.uint64), width) & low).astype(np.int64)
    text = np.searchsorted(offsets, at[: len(anchor)], "right") - 1
    start = np.flatnonzero(at[: len(anchor)] + length <= offsets[text + 1])
    if not len(start):
        return empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty
    anchor, text = anchor[start], text[start]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    lo, hi = start[first], start[np.concatenate((first[1:], [True]))]
    text = text[first]
    return text, grams[anchor[first]], span_hash(sums, lo, hi + length), lo - offsets[text], hi - offsets[text]


def _anchors_by_piece(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """_anchors(), of a long text by pieces; a context on an edge is cut, which leaves its strings as they are."""
    if len(offsets) > 2 or len(raw) <= 2 * PIECE_BYTES:
        return _anchors(raw, offsets, length, gram)
    parts = []
    for at in range(0, len(raw) - length + 1, PIECE_BYTES):
        piece = raw[at : at + PIECE_BYTES + length - 1]
        owner, anchor, context, first, last = _anchors(piece, np.array([0, len(piece)]), length, gram)
        parts.append((owner, anchor, context, first + at, last + at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def anchor_table(docs: DataFrame, doc_id: str, text: str, length: int, gram: int) -> DataFrame:
    """(row, doc_id, digest, n_bytes, spots) of each document; spots: array<struct<anchor, context, lo, hi>>."""
    kind = docs.select(doc_id).dtypes[0][1]
    given = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.sha2(given.cast("binary"), 256).alias("digest"), given.alias("text"))

    def find(batches):
        for batch in batches:
            parts, sizes = [], []
            for lo, hi, raw, offsets in chunks(batch.column(3)):
                owner, *rest = _anchors_by_piece(raw, offsets, length, gram)
                parts.append((np.bincount(owner, minlength=hi - lo), *rest))
                sizes.append(np.diff(offsets))
            if not parts:
                continue
            count, anchor, context, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
            spots = pa.StructArray.from_arrays([pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(first, pa.int32()), pa.array(last, pa.int32())], names=["anchor", "context", "lo", "hi"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), spots)
            yield pa.record_batch([*batch.columns[:3], pa.array(np.concatenate(sizes), pa.int64()), lists], names=["row", "doc_id", "digest", "n_bytes", "spots"])

    return base.mapInArrow(find, f"row long, doc_id {kind}, digest string, n_bytes long, spots array<struct<anchor:long,context:long,lo:int,hi:int>>")


def _runs(starts: np.ndarray, length: int) -> np.ndarray:
    """Flat [from, to, from, to, ...] of the bytes covered by strings at the sorted ``starts``."""
    first = np.concatenate(([True], starts[1:] > starts[:-1] + length))
    return np.stack((starts[first], starts[np.concatenate((first[1:], [True]))] + length), axis=1).ravel()


_FOUND = "anchor long, context long, runs array<int>"


def _batch(rows: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()))
    return pa.record_batch([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], names=["anchor", "context", "runs"])


def _by_suffixes(contexts: DataFrame, length: int, *deal: str) -> DataFrame:
    """(anchor, context, runs): the repeated bytes of each context, by the suffix array of its block.

    Contexts are dealt by anchor, and by the columns ``deal`` where its contexts are in more than one group.
    """

    def solve(rows):
        #: every context ends with a mark below all its bytes; UTF-8 leaves room for the shift by one
        text = np.frombuffer(b"".join(np.add(np.frombuffer(r[2], np.uint8), 1, dtype=np.uint8).tobytes() + b"\0" for r in rows), np.uint8)
        size = np.array([len(r[2]) for r in rows])
        begin = np.concatenate(([0], np.cumsum(size + 1)))
        order = suffix_array(text, length)
        owner = np.repeat(np.arange(len(rows)), size + 1)
        #: a suffix is a string of full length if its context has so many bytes left
        whole = begin[owner + 1] - 1 - np.arange(len(text)) >= length
        order = order[whole[order]]
        equal = np.append(common_prefixes(text, order, length) >= length, False)
        repeated = np.zeros(len(text), bool)
        repeated[order[equal[:-1] | equal[1:]]] = True
        copies = np.array([r[3] for r in rows])
        repeated |= whole & (copies > 1)[owner]
        out = []
        for k, r in enumerate(rows):
            starts = np.flatnonzero(repeated[begin[k] : begin[k + 1]])
            if len(starts):
                out.append((r[0], r[1], _runs(starts, length)))
        return out

    keys = ["anchor", *deal]

    def blocks(batches):
        held, weight, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("anchor", "context", "bytes", "copies", *deal)), strict=True):
                key = (row[0], *row[4:])
                #: groups of one anchor stay apart, as a context may be in several of them
                if held and key != last and (weight >= BLOCK_BYTES or deal):
                    yield _batch(solve(held))
                    held, weight = [], 0
                held.append(row)
                last = key
                weight += len(row[2]) + 1
        if held:
            yield _batch(solve(held))

    dealt = contexts.select("anchor", "context", "bytes", "copies", *deal).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(blocks, _FOUND)


def _anchor_at(raw: np.ndarray, anchor: int, gram: int) -> int:
    """Where the anchor of a context stands: its first gram with that hash."""
    at = np.arange(len(raw) - gram + 1)
    return int(np.flatnonzero(span_hash(prefix_hash(raw), at, at + gram).view(np.int64) == anchor)[0])


def _cells(n: int, place: int) -> np.ndarray:
    """The cell of each of the ``n`` starts of a context: their distance to the anchor, in steps of CELL."""
    return (place - np.arange(n)) // CELL


def _crowded(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """As _by_suffixes(), for anchors with any number of contexts."""

    def cores(batches):
        for batch in batches:
            out = []
            for anchor, context, raw, copies in zip(*(batch.column(k).to_pylist() for k in ("anchor", "context", "bytes", "copies")), strict=True):
                text = np.frombuffer(raw, np.uint8)
                place, sums = _anchor_at(text, anchor, gram), prefix_hash(text)
                for cell in np.unique(_cells(len(text) - length + 1, place)).tolist():
                    #: all strings that begin CELL * cell to CELL * cell + CELL - 1 bytes before the anchor hold these bytes
                    lo = np.array([place - CELL * cell])
                    hi = lo + length - CELL + 1
                    out.append((anchor, context, cell, int(span_hash(sums, lo, hi).view(np.int64)[0]), copies))
            yield pa.record_batch([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names=["anchor", "context", "cell", "core", "copies"])

    table = staged(contexts.mapInArrow(cores, "anchor long, context long, cell long, core long, copies long"), "cells")
    often = table.groupBy("anchor", "cell", "core").agg(F.sum("copies").alias("n")).where("n > 1").drop("n")
    left = table.join(often.hint("merge"), ["anchor", "cell", "core"], "left_semi").groupBy("anchor", "context").agg(F.collect_set("cell").alias("cells"))

    def cut(batches):
        for batch in batches:
            out = []
            for anchor, context, raw, copies, cells in zip(*(batch.column(k).to_pylist() for k in ("anchor", "context", "bytes", "copies", "cells")), strict=True):
                text = np.frombuffer(raw, np.uint8)
                use = np.flatnonzero(np.isin(_cells(len(text) - length + 1, _anchor_at(text, anchor, gram)), cells))
                new = np.flatnonzero(np.concatenate(([True], use[1:] != use[:-1] + 1)))
                for a, b in zip(use[new].tolist(), use[np.append(new[1:], len(use)) - 1].tolist(), strict=True):
                    out.append((anchor, context, a, raw[a : b + length], copies))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
            yield pa.record_batch([pa.array([r[k] for r in out], kinds[k]) for k in range(5)], names=["anchor", "context", "lo", "bytes", "copies"])

    thin = contexts.join(left.hint("merge"), ["anchor", "context"]).select("anchor", "context", "bytes", "copies", "cells")
    parts = staged(thin.mapInArrow(cut, "anchor long, context long, lo int, bytes binary, copies long").withColumn("part", F.xxhash64("bytes", F.lit(3))), "parts")
    distinct = parts.groupBy("anchor", "part").agg(F.sum("copies").alias("copies"), F.first("bytes").alias("bytes"))
    totals = parts.groupBy("anchor").agg(F.countDistinct("part").alias("kinds"))
    blocks = F.ceil(F.col("kinds") / BLOCK_CONTEXTS).cast("int")
    own = F.pmod(F.xxhash64("part"), blocks).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), blocks - 1), lambda x: F.least(x, own).cast("long") * blocks + F.greatest(x, own))
    tiled = distinct.join(totals.hint("merge"), "anchor").select("anchor", F.col("part").alias("context"), "bytes", "copies", F.explode(tiles).alias("tile"))
    found = staged(_by_suffixes(tiled, length, "tile"), "found")
    spread = found.select("anchor", F.col("context").alias("part"), "runs")
    moved = parts.select("anchor", "context", "part", "lo").join(spread.hint("merge"), ["anchor", "part"])
    return moved.select("anchor", "context", F.transform("runs", lambda x: x + F.col("lo")).alias("runs"))


def _one_each(docs: DataFrame, given) -> DataFrame:
    """(digest, bytes) of each distinct text; of copies one a task is moved."""
    return docs.groupBy(F.sha2(given.cast("binary"), 256).alias("digest")).agg(F.first(given.cast("binary")).alias("bytes"))


def repeated_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(documents, runs): documents as (row, doc_id, digest, n_bytes), runs as (digest, lo, runs).

    runs holds, for each distinct text, pieces of what strings of ``length`` bytes that also start elsewhere cover:
    byte offsets counted from lo. A document and its copy repeat each other wholly if they are long enough.
    """
    table = staged(anchor_table(docs, doc_id, text, length, gram), "anchors")
    spots = table.select("row", F.explode("spots").alias("s")).select("row", "s.*")
    contexts = spots.groupBy("anchor", "context").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("row", "lo", "hi")).alias("at"))
    totals = contexts.groupBy("anchor").agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("kinds")).where("total > 1")
    repeated = staged(contexts.join(totals, "anchor").select("anchor", "context", "copies", "kinds", "at.*"), "contexts")

    wanted = repeated.groupBy("row").agg(F.collect_list(F.struct("anchor", "context", "copies", "kinds", "lo", "hi")).alias("cuts"))
    wanted = wanted.join(table.select("row", "digest"), "row").select("digest", "cuts")
    given = F.coalesce(F.col(text), F.lit(""))
    one_each = _one_each(docs, given).join(wanted.hint("merge"), "digest")

    def cut(batches):
        for batch in batches:
            raw, offsets = buffer_of(batch.column("bytes"))
            cuts = batch.column("cuts")
            owner = np.repeat(np.arange(len(cuts)), cuts.value_lengths().to_numpy(zero_copy_only=False))
            of = dict(zip((f.name for f in cuts.type.value_type), cuts.flatten().flatten(), strict=True))
            lo = offsets[owner] + of["lo"].to_numpy(zero_copy_only=False)
            hi = offsets[owner] + of["hi"].to_numpy(zero_copy_only=False) + length
            view = memoryview(raw)
            for k in range(0, len(owner), 8192):
                part = slice(k, k + 8192)
                pieces = pa.array([bytes(view[a:b]) for a, b in zip(lo[part].tolist(), hi[part].tolist(), strict=True)], pa.binary())
                yield pa.record_batch([of["anchor"][part], of["context"][part], pieces, of["copies"][part], of["kinds"][part]], names=["anchor", "context", "bytes", "copies", "kinds"])

    pieces = staged(one_each.select("bytes", "cuts").mapInArrow(cut, "anchor long, context long, bytes binary, copies long, kinds long"), "pieces")
    found = _by_suffixes(pieces.where(F.col("kinds") <= BLOCK_CONTEXTS), length)
    crowded = pieces.where(F.col("kinds") > BLOCK_CONTEXTS)
    if not crowded.isEmpty():
        found = found.unionByName(_crowded(crowded, length, gram))
    heads = table.groupBy("digest").agg(F.min("row").alias("row"))
    own = spots.join(found, ["anchor", "context"]).select("row", "lo", "runs").join(heads, "row").select("digest", "lo", "runs")
    return table.select("row", "doc_id", "digest", "n_bytes"), own


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) of each document.

    Texts count as UTF-8 bytes, a null as none; matches stay within one text, overlaps and matches within the same text
    included. spans: array<int> of [from, to) byte offsets, end to end; kept: the remaining bytes, null where nothing was
    removed. Texts shorter than ``length`` repeat nothing. Rows that repeat a doc_id are documents of their own; equal
    texts are worked on once. An empty table gives an empty result; other columns are ignored.
    """
    table, own = repeated_strings(docs, doc_id, text, length, gram)
    spans = own.groupBy("digest").agg(F.collect_list(F.struct("lo", "runs")).alias("parts"))
    given = F.coalesce(F.col(text), F.lit(""))
    one_each = _one_each(docs, given).join(spans.hint("merge"), "digest")

    def apply(batches):
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.binary())
        names = ["digest", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
        for batch in batches:
            out = []
            for digest, raw, parts in zip(*(batch.column(k).to_pylist() for k in ("digest", "bytes", "parts")), strict=True):
                flat = np.concatenate([np.array(p["runs"], np.int64) + p["lo"] for p in parts]).reshape(-1, 2)
                flat = flat[np.argsort(flat[:, 0], kind="stable")]
                reach = np.maximum.accumulate(flat[:, 1])
                new = np.concatenate(([True], flat[1:, 0] > reach[:-1]))
                lo, hi = flat[new, 0], reach[np.concatenate((new[1:], [True]))]
                kept = b"".join(raw[a:b] for a, b in zip([0, *hi], [*lo, len(raw)], strict=True))
                out.append((digest, int((hi - lo).sum()), len(lo), hashlib.sha256(kept).hexdigest(), np.stack((lo, hi), axis=1).ravel(), kept))
            yield pa.record_batch([pa.array([r[k] for r in out], kinds[k]) for k in range(6)], names=names)

    changed = one_each.mapInArrow(apply, "digest string, n_removed long, n_spans long, kept_sha256 string, spans array<int>, kept binary")
    zero = F.lit(0).cast("long")
    return table.join(changed, "digest", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "digest").alias("kept_sha256"), "spans", "kept"
    )
