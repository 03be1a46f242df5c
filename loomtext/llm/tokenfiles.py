"""Token ids of a corpus in ascending document order, as wavelet-matrix shard files.

Documents are dealt by ranges of doc_id and encoded in order; every run of about SHARD_TOKENS ids is one packed shard,
written through Spark's own writer as a record of a compressed file, so any store that Spark reaches will do. Readers
take documents, counts and occurrences from the packed bit planes.

The pattern of byte-level BPE always parts a text before a space that something visible follows, around line ends and
between a letter and a mark. Texts are cut at these places, and equal pieces are encoded once for each Python worker.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.llm.bytewise import chunks, table_of
from loomtext.llm.memo import Memo
from loomtext.llm.staging import shared_folder
from loomtext.llm.wavelet import WaveletMatrix, pack

SHARD_TOKENS = 1 << 20
#: Pieces that a worker remembers, about 40 bytes each; a full memory is emptied.
PIECES = 3_000_000
#: Bytes that begin no white space of any kind: visible ASCII and lead bytes but those of Unicode's white space.
_PLAIN = table_of(bytes(range(0x21, 0x7F)) + bytes(b for b in range(0xC3, 0xF5) if b not in (0xE1, 0xE2, 0xE3)))
_LETTER = table_of(bytes(range(65, 91)) + bytes(range(97, 123)))
_MARK = table_of(b",.;:!?")
_ENCODERS: dict[str, PieceEncoder] = {}


class PieceEncoder:
    """Encodes texts with a byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = max(1, int(self.tokenizer.get_vocab_size() - 1).bit_length())
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            self.bytes[number] = len(token)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memo = Memo(self._pieces, PIECES)

    def _pieces(self, blob: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces. Those that begin with a space may follow each other in one text, those of visible ends may stand
        on lines of one text; it parts just there."""
        count = np.zeros(len(start), np.int64)
        spans = [blob[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        kind = np.fromiter((0 if s[0] == 32 else 1 if _PLAIN[s[0]] and _PLAIN[s[-1]] else 2 for s in spans), np.int64, len(spans))
        spaced, visible, alone = (np.flatnonzero(kind == k) for k in range(3))
        texts = [b"".join(spans[k] for k in spaced.tolist()).decode(), b"\n".join(spans[k] for k in visible.tolist()).decode(), *[spans[k].decode() for k in alone.tolist()]]
        lists = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        #: an id stands for as many bytes as its token has characters, so byte counts show where the pieces end
        for k, (some, gap) in enumerate(((spaced, 0), (visible, 1))):
            at = np.cumsum(self.bytes[lists[k]])
            stops = np.cumsum((end - start)[some] + gap) - gap
            last = np.searchsorted(at, stops, "left") + 1
            first = np.searchsorted(at, stops - (end - start)[some], "right")
            count[some] = last - first
            inside = np.zeros(len(at) + 1, np.int64)
            np.add.at(inside, first, 1)
            np.add.at(inside, last, -1)
            lists[k] = lists[k][np.cumsum(inside[:-1]) > 0]
        count[alone] = [len(x) for x in lists[2:]]
        every = np.concatenate((spaced, visible, alone))
        return np.concatenate(lists)[np.argsort(np.repeat(every, count[every]), kind="stable")], count

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each text) of the texts in a buffer."""
        n = len(offsets) - 1
        blob = raw.tobytes()
        if any(t in blob for t in self.added):
            lists = [self.tokenizer.encode(blob[a:b].decode(), add_special_tokens=False).ids for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            return np.array([i for x in lists for i in x], np.uint32), np.array([len(x) for x in lists], np.int64)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        begins = np.zeros(len(raw) + 1, bool)
        begins[offsets] = True
        last = begins[1:].copy()
        plain, line = _PLAIN[raw], raw == 10
        #: before a space that something visible follows; before a line end that follows something visible, and after it
        #: if that holds and something visible follows; between a letter and a mark
        begins[: len(raw) - 1] |= (raw[:-1] == 32) & plain[1:] & ~last[:-1]
        begins[1 : len(raw)] |= (plain[:-1] & line[1:]) | (_LETTER[raw[:-1]] & _MARK[raw[1:]])
        begins[2 : len(raw)] |= plain[:-2] & line[1:-1] & plain[2:]
        begins[-1] = False
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(raw))
        ids, count = self.memo.lookup(raw, start, end)
        return ids, np.bincount(np.searchsorted(offsets, start, "right") - 1, count, n).astype(np.int64)


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


_SHARD = "part int, seq int, n_tokens long, packed binary"


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> str:
    """Encodes all texts, appends ``end_id`` to each, writes the shards and returns their folder.

    Ascending doc_id, nulls first; rows that repeat a doc_id follow each other by a hash of their text. A null or empty
    text is its end id alone. Other columns are ignored.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/loomtext/tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))

    def shard(batches):
        encoder, part, seq = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def packed():
            ids, known, counts = (np.concatenate([h[k] for h in held]) for k in range(3))
            # a null id is kept apart from the others by its place in front of them; its value is the least
            raw = pack(ids, known, np.cumsum(counts), encoder.width)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([raw], pa.binary())], names=["part", "seq", "n_tokens", "packed"])

        for batch in batches:
            known = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            for lo, hi, raw, offsets in chunks(batch.column(1)):
                ids, counts = encoder.encode(raw, offsets)
                stops = np.cumsum(counts)
                held.append((np.insert(ids, stops, end_id), known[lo:hi], counts + 1))
                size += len(ids) + len(counts)
                if size >= SHARD_TOKENS:
                    yield packed()
                    held, size, seq = [], 0, seq + 1
        if held:
            yield packed()

    dealt = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    dealt.mapInArrow(shard, _SHARD).write.option("compression", "zstd").parquet(path)
    return path


#: Stands for a null document id in a shard.
NULL_ID = -(1 << 63)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the shards: start counts the ids of all before it."""
    shards = spark.read.schema(_SHARD).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("at")).join(parts, "part").select("part", "seq", (F.col("base") + F.col("at")).alias("base"))

    def unpack(batches):
        for batch in batches:
            for part, seq, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                matrix = WaveletMatrix(raw.as_buffer())
                ids = matrix.tokens().astype("<u4").view(np.uint8)
                begin = np.concatenate(([0], matrix.ends[:-1])).astype(np.int64)
                view = memoryview(ids)
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), matrix.ends.tolist(), strict=True)]
                n = len(crc)
                names = ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]
                known = pa.array(matrix.doc_ids, mask=matrix.doc_ids == NULL_ID)
                yield pa.record_batch([pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), known, pa.array(begin), pa.array(matrix.ends - begin), pa.array(crc, pa.int64())], names=names)

    read = shards.select("part", "seq", "packed").mapInArrow(unpack, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read.join(places, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
