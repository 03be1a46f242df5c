"""Unigram segmentation with a SentencePiece vocabulary: Viterbi over a double-array trie of scored pieces.

A space becomes the marker U+2581 and a text gets one marker in front. No piece has a marker behind another character,
so the best segmentation falls apart at each marker that follows a non-marker; these units are encoded by themselves,
equal ones once for each Python worker. Matching and relaxing run over all new units at once. A character that no piece
covers is encoded by its bytes. Decoding joins the pieces, turns markers into spaces and drops the first.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.bytewise import chunks
from loomtext.llm.memo import Memo
from loomtext.llm.staging import fresh

MARKER = "▁".encode()
#: Below the least score of any piece: what a character costs that no piece covers.
UNKNOWN_PENALTY = 10.0
UNITS = 500_000
#: Units of more bytes are relaxed one by one.
LONG_UNIT = 512


class DoubleArray:
    """A trie of byte strings: the child of ``node`` by byte b is base[node] + b + 1 if check there is the node."""

    def __init__(self, keys: list[bytes]):
        size = 1 << 16
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.check[0] = 0
        order = sorted(range(len(keys)), key=keys.__getitem__)
        todo, low, hint = deque([(0, 0, len(keys), 0)]), 258, 1
        while todo:
            node, lo, hi, depth = todo.popleft()
            if lo < hi and len(keys[order[lo]]) == depth:
                self.value[node] = order[lo]
                lo += 1
            if lo >= hi:
                continue
            starts = [lo]
            for k in range(lo + 1, hi):
                if keys[order[k]][depth] != keys[order[k - 1]][depth]:
                    starts.append(k)
            codes = np.array([keys[order[k]][depth] + 1 for k in starts])
            #: single children fill the holes; larger families are placed further and further up
            while low < len(self.check) and self.check[low] >= 0:
                low += 1
            base = max(1, low - int(codes[0])) if len(codes) == 1 else hint
            while True:
                while base + 257 >= len(self.check):
                    self._grow()
                if (self.check[base + codes] < 0).all():
                    break
                base += 1
            hint = base if len(codes) > 1 else hint
            self.base[node] = base
            self.check[base + codes] = node
            for code, a, b in zip(codes.tolist(), starts, [*starts[1:], hi], strict=True):
                todo.append((base + code, a, b, depth + 1))

    def _grow(self) -> None:
        n = len(self.check)
        self.base = np.append(self.base, np.zeros(n, np.int32))
        self.check, self.value = (np.append(x, np.full(n, -1, np.int32)) for x in (self.check, self.value))

    def matches(self, raw: np.ndarray, start: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into start, end, value) of every key that begins at a place of ``start`` and ends by its limit."""
        which, node, at = np.arange(len(start)), np.zeros(len(start), np.int64), start.copy()
        out = []
        while len(which):
            go = at < limit[which]
            which, node, at = which[go], node[go], at[go]
            child = self.base[node] + raw[at].astype(np.int64) + 1
            go = (self.check[child] == node) & (self.base[node] > 0)
            which, node, at = which[go], child[go], at[go] + 1
            hit = self.value[node] >= 0
            out.append((which[hit], at[hit], self.value[node[hit]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


class Vocabulary:
    """Pieces of a SentencePiece model file, their scores and the ids of the byte pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.path = path
        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.unknown = model.unk_id()
        self.bytes_of = [b""] * len(ids)
        self.byte_ids = np.full(256, self.unknown, np.int64)
        self.scores = np.array([model.get_score(i) for i in ids], np.float64)
        normal = []
        for i in ids:
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                normal.append(i)
                self.bytes_of[i] = model.id_to_piece(i).encode()
        self.normal = np.array(normal)
        if any(MARKER in re.sub(b"^(?:" + MARKER + b")+", b"", b) for b in self.bytes_of):
            raise ValueError("a piece has a marker behind another character")
        self.trie = DoubleArray([self.bytes_of[i] for i in normal])
        self.lowest = float(self.scores[self.normal].min()) - UNKNOWN_PENALTY
        plain = [b.replace(MARKER, b" ") for b in self.bytes_of]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_end = np.cumsum([len(b) for b in plain])
        self.plain_start = self.plain_end - np.array([len(b) for b in plain])


class Unigram:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.memo = Memo(self._units, UNITS)

    def _units(self, blob: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of the units at these spans."""
        v = self.v
        size = end - start
        stops = np.cumsum(size)
        begins = stops - size
        source = np.frombuffer(blob, np.uint8)
        raw = source[np.arange(int(stops[-1])) + np.repeat(start - begins, size)]
        unit = np.repeat(np.arange(len(size)), size)
        place = np.flatnonzero((raw & 0xC0) != 0x80)
        limit = stops[unit[place]]
        which, to, piece = v.trie.matches(raw, place, limit)
        following = np.append(place[1:], len(raw))
        single = np.zeros(len(place), bool)
        single[which[to == following[which]]] = True
        bare = np.flatnonzero(~single)
        origin = np.concatenate((place[which], place[bare]))
        to = np.concatenate((to, following[bare]))
        ident = np.concatenate((v.normal[piece], np.full(len(bare), -1)))
        score = np.concatenate((v.scores[v.normal[piece]], np.full(len(bare), v.lowest)))
        best = np.full(len(raw) + len(size), -np.inf)
        #: every unit has one place more than bytes, for its end
        best[begins + np.arange(len(size))] = 0
        came = np.full(len(best), -1)
        a, b = origin + unit[origin], to + unit[origin]
        depth = origin - begins[unit[origin]]
        order = np.lexsort((to, depth))
        a, b, depth, score, ident = a[order], b[order], depth[order], score[order], ident[order]
        long_ = size[unit[origin[order]]] > LONG_UNIT
        edges = np.arange(len(a))
        short = edges[~long_]
        bounds = np.searchsorted(depth[short], np.arange(LONG_UNIT + 1))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if lo == hi:
                continue
            e = short[lo:hi]
            total = best[a[e]] + score[e]
            better = total > best[b[e]]
            best[b[e[better]]] = total[better]
            came[b[e[better]]] = e[better]
        if long_.any():
            rest = edges[long_]
            rest = rest[np.lexsort((b[rest], a[rest]))]
            for e, x, y, s in zip(rest.tolist(), a[rest].tolist(), b[rest].tolist(), score[rest].tolist(), strict=True):
                total = best[x] + s
                if total > best[y]:
                    best[y], came[y] = total, e
        return self._trace(begins, stops, a, b, ident, came, raw)

    def _trace(self, begins, stops, a, b, ident, came, raw):
        units = np.arange(len(begins))
        now, which, taken, owners = stops + units, units, [], []
        while len(which):
            go = now > begins[which] + which
            now, which = now[go], which[go]
            edge = came[now]
            taken.append(edge)
            owners.append(which)
            now = a[edge]
        edge, owner = np.concatenate(taken)[::-1], np.concatenate(owners)[::-1]
        order = np.argsort(owner, kind="stable")
        edge, owner = edge[order], owner[order]
        out = ident[edge]
        if (out < 0).any():
            width = np.where(out < 0, b[edge] - a[edge], 1)
            first = np.cumsum(width) - width
            pick = np.repeat(np.arange(len(edge)), width)
            offset = np.arange(int(width.sum())) - first[pick]
            bare = out[pick] < 0
            owner = owner[pick]
            out = out[pick]
            out[bare] = self.v.byte_ids[raw[a[edge[pick[bare]]] - owner[bare] + offset[bare]]]
        return out, np.bincount(owner, minlength=len(begins))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each text). An empty text has no ids."""
        n = len(offsets) - 1
        size = np.diff(offsets)
        spaces = raw == 32
        #: the marked text: three bytes for each space, and a marker in front of each text
        grow = np.where(spaces, 3, 1)
        ends = np.concatenate(([0], np.cumsum(grow)))
        lead = 3 * (size > 0)
        owner = np.repeat(np.arange(n), size)
        shift = np.cumsum(lead)
        to = ends[:-1] + shift[owner]
        marked = np.zeros(int(ends[-1] + lead.sum()), np.uint8)
        marked[to[~spaces]] = raw[~spaces]
        marks = np.concatenate((to[spaces], (ends[offsets[:-1]] + shift - lead)[size > 0]))
        for k in range(3):
            marked[marks + k] = MARKER[k]
        limits = np.concatenate(([0], ends[offsets[1:]] + shift))
        is_mark = np.zeros(len(marked) + 1, bool)
        found = np.flatnonzero((marked[:-2] == MARKER[0]) & (marked[1:-1] == MARKER[1]) & (marked[2:] == MARKER[2])) if len(marked) > 2 else np.empty(0, np.int64)
        is_mark[found] = True
        begin = np.zeros(len(marked) + 1, bool)
        begin[limits[:-1][size > 0]] = True
        after = found[found >= 3]
        begin[after[~is_mark[after - 3]]] = True
        start = np.flatnonzero(begin[:-1])
        if not len(start):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        end = np.append(start[1:], len(marked))
        ids, count = self.memo.lookup(marked, start, end)
        return ids, np.bincount(np.searchsorted(limits, start, "right") - 1, count, n).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts of these ids, without the marker in front of each."""
        v = self.v
        width = (v.plain_end - v.plain_start)[ids]
        stops = np.cumsum(width)
        total = int(stops[-1]) if len(stops) else 0
        raw = v.plain[np.arange(total) + np.repeat(v.plain_start[ids] - (stops - width), width)]
        ends = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts)))]
        keep = np.ones(total, bool)
        heads = ends[:-1][counts > 0]
        keep[heads[raw[heads] == 32]] = False
        kept = np.concatenate(([0], np.cumsum(keep)))
        return raw[keep], kept[ends]


_CODERS: dict[str, Unigram] = {}


def _coder(shared) -> Unigram:
    key = str(shared.value.path)
    if key not in _CODERS:
        _CODERS[key] = Unigram(shared.value)
    return _CODERS[key]


def encode_texts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ids (array<int>) and decoded (string), which the ids give back.

    Null and empty texts have no ids and decode to an empty text. decoded is the text itself, but for U+2581, which
    stands for a space in this coding. Rows keep their number; columns named ids or decoded are replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary(model))
    names = [c for c in docs.columns if c not in ("ids", "decoded")]
    base = docs.select(*names)
    schema = base.withColumn("ids", F.array().cast("array<int>")).withColumn("decoded", F.lit("")).schema

    given = fresh(docs, "_text")

    def encode(batches):
        coder = _coder(shared)
        for batch in batches:
            at = batch.schema.get_field_index(given)
            rest = [c for k, c in enumerate(batch.columns) if k != at]
            for lo, hi, raw, offsets in chunks(batch.column(at)):
                ids, counts = coder.encode(raw, offsets)
                back, ends = coder.decode(ids, counts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.uint32()).cast(pa.int32()))
                decoded = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(back.tobytes()))
                yield pa.record_batch([*[c.slice(lo, hi - lo) for c in rest], lists, decoded], names=[*names, "ids", "decoded"])

    return base.withColumn(given, F.col(text)).mapInArrow(encode, schema)


def encoded_digests(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, n_bytes, decoded_sha256) of each document.

    ids_crc32: of the ids as little-endian unsigned 32-bit integers; n_bytes and decoded_sha256: of the text that the ids
    decode to. Null and empty texts have no ids and no bytes.
    """
    kind = docs.select(doc_id).dtypes[0][1]
    rows = encode_texts(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model).select("doc_id", "ids", "decoded")

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = memoryview(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8))
            ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            texts = [t.as_buffer() for t in batch.column("decoded")]
            yield pa.record_batch(
                [batch.column(0), ids.value_lengths().cast(pa.int64()), pa.array([zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip([0, *ends], ends, strict=False)], pa.int64()), pa.array([t.size for t in texts], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
                names=["doc_id", "n_tokens", "ids_crc32", "n_bytes", "decoded_sha256"],
            )

    return rows.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_crc32 long, n_bytes long, decoded_sha256 string")
