"""Language identification providers. A provider adds struct<label, conf> for a text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from loomtext.functions.text import let

#: Fixed values of the heuristic for the target language: typical characters, counted as they are written, and words.
TARGET_CHARS = "ëñóàéèɛɔŋ"
TARGET_WORDS = (
    "la", "na", "ci", "mu", "du", "di", "ko", "nga", "naa", "ak", "gi", "yi", "bi", "wi", "mi", "si", "ki", "mooy", "doon", "ñu", "ñuy", "muy", "duy",
    "sama", "sa", "man", "yow", "ñoom", "jëf", "wax", "def", "dem", "jóg", "réew", "nit", "boppam", "mbir", "yàlla", "allaaxiraa",
)


def heuristic(text: Column, chars: str = TARGET_CHARS, words: tuple = TARGET_WORDS, share: float = 0.1) -> Column:
    """struct of the evidence, is_target and confidence, from typical characters and common words.

    Any typical character or a word share of ``share`` decides; case counts for characters and not for words.
    """
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    counted = let(found, lambda ws: F.struct(F.size(F.filter(ws, lambda w: w.isin(*words))).alias("known"), F.size(ws).alias("all")))

    def evidence(x):
        n_chars, known = x["chars"], x["words"]["known"]
        ratio = F.coalesce(known / F.nullif(x["words"]["all"], F.lit(0)), F.lit(0.0))
        has = n_chars > 0
        return F.struct(
            n_chars.cast("long").alias("char_count"), known.cast("long").alias("word_count"), ratio.alias("word_ratio"),
            F.coalesce(n_chars / F.nullif(x["length"], F.lit(0)), F.lit(0.0)).alias("char_density"), has.alias("has_chars"),
            (has | (ratio >= share)).alias("is_target"), F.least(F.lit(1.0), F.when(has, 0.4).otherwise(0.0) + ratio * 0.6).alias("confidence"),
        )

    n_chars = F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]", ""))
    return let(F.struct(n_chars.alias("chars"), F.length(text).alias("length"), counted.alias("words")), evidence)


def from_column(label: Column, conf: float = 1.0) -> Column:
    """A label that is already there."""
    return F.struct(F.coalesce(label, F.lit("unknown")).alias("label"), F.lit(conf).alias("conf"))


def top_labels(load: Callable[[], Callable[[str], list[tuple[str, float]]]], top: int = 3):
    """A pandas UDF around a model that ranks labels: array<struct<label, conf>> of the ``top`` best; blank text has none."""

    @F.pandas_udf("array<struct<label:string,conf:double>>")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for part in texts:
            ranked = [sorted(model(" ".join(t.split())), key=lambda x: (-x[1], x[0]))[:top] if isinstance(t, str) and t.strip() else [] for t in part]
            yield pd.Series([[{"label": a, "conf": float(b)} for a, b in x] for x in ranked])

    return predict


def from_model(load: Callable[[], Callable[[str], tuple[str, float]]]):
    """A pandas UDF around a model, loaded once for each Python worker. Blank text gives __empty__ with 0."""

    @F.pandas_udf("label string, conf double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load()
        for part in texts:
            rows = [model(" ".join(t.split())) if isinstance(t, str) and t.strip() else ("__empty__", 0.0) for t in part]
            yield pd.DataFrame(rows, columns=["label", "conf"])

    return predict
