"""One row to many: sentence groups with dedup and counters, article sentences, transcripts, audio windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import article_sentences, collapse_repetitions, collapse_runs, cut_sentences, digest, has_code, key_squeezed, key_strip, overlap_merge, sentence_groups, spoken_sentences, token_count, tokens, whole_article
from loomtext.operators.merge import first_wins


def split_fragments(rows: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, min_chars: int = 10) -> DataFrame:
    """(key, part, text, sources, has_code, reason): sentence groups marked short, dup or kept, in this order."""
    parts = rows.select(key, "sources", has_code(F.col(text)).alias("has_code"), F.posexplode(sentence_groups(F.col(text), size)).alias("part", "text"))
    keyed = parts.withColumn("key", F.when(F.length("text") >= min_chars, digest(key_squeezed(F.col("text")))))
    first = keyed.where("key is not null").groupBy("key").agg(F.min(F.struct(key, "part")).alias("first"))
    marked = keyed.join(first, "key", "left")
    reason = F.when(F.col("key").isNull(), "short").when(F.struct(key, "part") == F.col("first"), "kept").otherwise("dup")
    return marked.select(key, "part", "text", "sources", "has_code", reason.alias("reason"))


def kept_fragments(rows: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, min_chars: int = 10) -> DataFrame:
    """(key, part, text, sources): the kept rows of split_fragments(), found in one aggregation."""
    parts = rows.select(key, "sources", F.posexplode(sentence_groups(F.col(text), size)).alias("part", "text")).where(F.length("text") >= min_chars)
    return first_wins(parts, digest(key_squeezed(F.col("text"))), F.col(key), F.col("part")).select(key, "part", "text", "sources")


def split_counters(rows: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, min_chars: int = 10) -> DataFrame:
    """(reason, n_rows, n_bytes, n_code) of split_fragments(), from sums over the keys instead of marked rows."""
    parts = rows.select(key, has_code(F.col(text)).cast("long").alias("code"), F.posexplode(sentence_groups(F.col(text), size)).alias("part", "text"))
    parts = parts.select("code", F.octet_length("text").cast("long").alias("b"), F.struct(key, "part").alias("o"), F.when(F.length("text") >= min_chars, digest(key_squeezed(F.col("text")))).alias("key"))
    keys = parts.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("b").alias("b"), F.sum("code").alias("k"), F.min(F.struct("o", "b", "code")).alias("f"))
    row = lambda reason, n, b, k: F.struct(F.lit(reason).alias("reason"), n.cast("long").alias("n"), b.alias("b"), k.alias("k"))
    short = F.array(row("short", F.col("c"), F.col("b"), F.col("k")))
    other = F.array(row("kept", F.lit(1), F.col("f.b"), F.col("f.code")), row("dup", F.col("c") - 1, F.col("b") - F.col("f.b"), F.col("k") - F.col("f.code")))
    each = keys.select(F.explode(F.when(F.col("key").isNull(), short).otherwise(other)).alias("x"))
    return each.groupBy("x.reason").agg(F.sum("x.n").alias("n_rows"), F.sum("x.b").alias("n_bytes"), F.sum("x.k").alias("n_code")).where("n_rows > 0")


def sentence_rows(rows: DataFrame, keep: list[str], text: str = "text", min_words: int = 3) -> DataFrame:
    """Article sentences with the columns of their article."""
    return rows.select(*keep, F.posexplode(article_sentences(F.col(text), min_words)).alias("part", "text"))


def transcript_sentences(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Cleaned transcript sentences, the first of each K2 key, with the key of their own video."""
    parts = rows.select(key, F.posexplode(spoken_sentences(collapse_repetitions(F.col(text)))).alias("part", "text"))
    return first_wins(parts, digest(key_strip(F.col("text"))), F.col(key), F.col("part"))


def transcript_report(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row of transcript_sentences(): sentences before dedup, final ones, duplicates, words, least and greatest length."""
    parts = rows.select(F.explode(spoken_sentences(collapse_repetitions(F.col(text)))).alias("text"))
    keys = parts.groupBy(digest(key_strip(F.col("text"))).alias("key")).agg(F.count(F.lit(1)).alias("c"), F.min(token_count(F.col("text"))).alias("w"))
    zero = F.lit(0).cast("long")
    return keys.agg(
        F.coalesce(F.sum("c"), zero).alias("before"), F.count(F.lit(1)).alias("final"), F.coalesce(F.sum(F.col("c") - 1), zero).alias("duplicates"),
        F.coalesce(F.sum("w"), zero).alias("words"), F.min("w").alias("min_words"), F.max("w").alias("max_words"),
    )


def article_rows(rows: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Whole articles as items: one row for each that has text, with the columns of its article."""
    return rows.select(*keep, whole_article(F.col(text)).alias("text")).where("text is not null")


def asr_documents(chunks: DataFrame, video: str, min_confidence: float = 0.5) -> DataFrame:
    """(video, n_chunks, raw, cleaned, sentences, avg_confidence, low_confidence) from ASR chunks in order.

    Chunks under ``min_confidence`` go before their overlaps are merged; a video without any left has empty texts.
    """
    ok = F.col("confidence") >= min_confidence
    grouped = chunks.groupBy(video).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.array_sort(F.collect_list(F.when(ok, F.struct("chunk_id", tokens(F.col("text")).alias("w"))))).alias("c"),
        F.avg("confidence").alias("avg_confidence"), F.count_if(~ok).alias("low_confidence"),
    )
    raw = grouped.withColumn("raw", F.array_join(overlap_merge(F.transform("c", lambda x: x["w"])), " "))
    cleaned = raw.withColumn("cleaned", collapse_runs(F.col("raw")))
    return cleaned.select(video, "n_chunks", "raw", "cleaned", cut_sentences(F.col("cleaned")).alias("sentences"), "avg_confidence", "low_confidence")


def windows_without_tail(length: Column, size: int, stride: int) -> Column:
    """Starts of whole windows; the tail is dropped, and what is shorter than one window gives none."""
    last = F.floor((length - size) / stride).cast("int")
    return F.when(length >= size, F.transform(F.sequence(F.lit(0), last), lambda k: k * stride)).otherwise(F.array().cast("array<int>"))


def windows_padded(length: Column, size: int, stride: int) -> Column:
    """array<struct<start, padding>>: a window at every stride before the end, the last ones padded."""
    last = F.floor((length - 1) / stride).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda k: k * stride)
    padded = F.transform(starts, lambda s: F.struct(s.alias("start"), F.greatest(s + size - length, F.lit(0)).cast("int").alias("padding")))
    return F.when(length > 0, padded).otherwise(F.array().cast("array<struct<start:int,padding:int>>"))
