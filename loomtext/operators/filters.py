"""Labelled filters: each row gets one reason, and counters are a group-by of the reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.language import heuristic
from loomtext.functions.text import html_share, key_lower, norm_text, token_count


def unpivot_texts(rows: DataFrame, keep: list[str], columns: list[str]) -> DataFrame:
    """Each non-empty cell of ``columns`` as a row (keep.., part, text), in the order given."""
    cells = F.array(*[norm_text(F.col(c)) for c in columns])
    return rows.select(*keep, F.posexplode(cells).alias("part", "text")).where("text <> ''")


def turn_texts(turns: Column, value: str = "value") -> Column:
    """Texts of a conversation cell, blanks dropped."""
    return F.filter(F.transform(turns, lambda t: norm_text(t[value])), lambda x: x != "")


def _early(rows: DataFrame, label: Column, conf: Column, target: str, min_tokens: int | Column, threshold: float, check_language: bool | Column) -> DataFrame:
    """``rows`` with the text stripped and the reason short or lang, or null."""
    clean = rows.withColumn("text", norm_text(F.col("text")))
    wrong = F.lit(check_language) if isinstance(check_language, bool) else check_language
    wrong = wrong & ~((label == target) & (conf >= threshold))
    least = F.lit(min_tokens) if isinstance(min_tokens, int) else min_tokens
    return clean.withColumn("reason", F.when(token_count(F.col("text")) < least, "short").when(wrong, "lang"))


def ingest_reasons(rows: DataFrame, label: Column, conf: Column, target: str, order: Column, min_tokens: int | Column = 3, threshold: float = 0.5, check_language: bool | Column = True) -> DataFrame:
    """``rows`` (source, text) with reason: short, lang, dup or kept, each row counted once in this order.

    Duplicates are found by K1 within a source among what passes the other filters; ``order`` must tell these rows
    apart. Trusted sources switch the language check off and set their own ``min_tokens``, both of which may be columns.
    """
    early = _early(rows, label, conf, target, min_tokens, threshold, check_language)
    keyed = early.withColumn("_o", order).withColumn("_k", F.when(F.col("reason").isNull(), key_lower(F.col("text"))))
    first = keyed.where("_k is not null").groupBy("source", "_k").agg(F.min("_o").alias("_first"))
    marked = keyed.join(first, ["source", "_k"], "left")
    reason = F.coalesce("reason", F.when(F.col("_o") == F.col("_first"), "kept").otherwise("dup"))
    return marked.withColumn("reason", reason).drop("_first", "_o", "_k")


def ingest_counts(rows: DataFrame, label: Column, conf: Column, target: str, min_tokens: int | Column = 3, threshold: float = 0.5, check_language: bool | Column = True) -> DataFrame:
    """(source, reason, n_rows) of ingest_reasons() without marking rows: duplicates are what a key has beyond one."""
    early = _early(rows, label, conf, target, min_tokens, threshold, check_language)
    keys = early.groupBy("source", "reason", F.when(F.col("reason").isNull(), key_lower(F.col("text"))).alias("k")).agg(F.count(F.lit(1)).alias("c"))
    each = F.when(F.col("reason").isNotNull(), F.array(F.struct("reason", F.col("c").alias("n")))).otherwise(F.array(F.struct(F.lit("kept").alias("reason"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("dup").alias("reason"), (F.col("c") - 1).alias("n"))))
    return keys.select("source", F.explode(each).alias("x")).groupBy("source", "x.reason").agg(F.sum("x.n").alias("n_rows")).where("n_rows > 0")


def reason_counts(marked: DataFrame, *by: str) -> DataFrame:
    return marked.groupBy(*by, "reason").agg(F.count(F.lit(1)).alias("n_rows"))


def validation(text: Column, min_tokens: int = 20, html: float = 0.1, language: Column | None = None, mismatch: str = "not_target") -> Column:
    """struct<passed, reason, word_count> by the chain no_content, invalid_encoding, too_short, html_residual, language."""
    count = token_count(text)
    accepted = heuristic(text)["is_target"] if language is None else language
    reason = (
        F.when(F.coalesce(text, F.lit("")) == "", "no_content").when(~F.is_valid_utf8(text), "invalid_encoding").when(count < min_tokens, "too_short")
        .when(html_share(text) > html, "html_residual").when(~F.coalesce(accepted, F.lit(False)), mismatch)
    )
    return F.struct(reason.isNull().alias("passed"), F.coalesce(reason, F.lit("passed")).alias("reason"), count.alias("word_count"))


def split_by(rows: DataFrame, test: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not; null fails."""
    sure = F.coalesce(test, F.lit(False))
    return rows.where(sure), rows.where(~sure)
