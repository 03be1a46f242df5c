"""Readers. Each declares its schema, so nothing is inferred from the data, and stamps an order where one matters."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import norm_text
from loomtext.operators.filters import turn_texts

CORPUS = T.StructType([T.StructField("text", T.StringType()), T.StructField("sources", T.ArrayType(T.StringType()))])
TRANSCRIPT = T.StructType([T.StructField(c, T.StringType()) for c in ("video_id", "text", "language", "model")])
SPEECH = T.StructType([T.StructField(c, T.StringType()) for c in ("filename", "speaker", "gender", "transcription")])


@dataclass
class SourceSpec:
    """One source of the registry: where it is, which text columns it has, and whether its language is trusted."""

    name: str
    path: str
    cols: list[str] = field(default_factory=lambda: ["text"])
    format: str = "parquet"
    lid: bool = True
    min_tokens: int | None = None


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """(source, part, text): each cell of the configured columns that exist; conversations give a row for each turn."""
    rows = spark.read.format(spec.format).load(spec.path)
    parts = []
    for k, c in enumerate(c for c in spec.cols if c in rows.columns):
        kind = rows.schema[c].dataType
        if isinstance(kind, T.ArrayType):
            cells = turn_texts(F.col(c)) if isinstance(kind.elementType, T.StructType) else F.filter(F.transform(c, norm_text), lambda x: x != "")
            parts.append(rows.select(F.lit(k).alias("part"), F.explode(cells).alias("text")))
        else:
            parts.append(rows.select(F.lit(k).alias("part"), norm_text(F.col(c)).alias("text")).where("text <> ''"))
    if not parts:
        parts = [spark.createDataFrame([], "part int, text string")]
    return reduce(DataFrame.unionByName, parts).select(F.lit(spec.name).alias("source"), "part", "text")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = CORPUS) -> DataFrame:
    """JSON lines of a folder, with file_name as the first part of an order; blank lines are skipped."""
    return spark.read.schema(schema).json(path).withColumn("file_name", F.col("_metadata.file_name"))


def read_transcripts(spark: SparkSession, path: str, summary: str = "summary.json") -> DataFrame:
    """A JSON document for each video; video_id defaults to the file's name, the summary file is left out."""
    rows = spark.read.schema(TRANSCRIPT).option("multiLine", True).json(path).withColumn("file_name", F.col("_metadata.file_name"))
    rows = rows.where(F.col("file_name") != summary)
    return rows.withColumn("video_id", F.coalesce("video_id", F.regexp_extract("file_name", r"^(.*)\.[^.]*$", 1)))


def read_speech_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated speech metadata; gender becomes 0 for female and 1 for male. A file without rows is an error."""
    rows = spark.read.schema(SPEECH).option("sep", "|").option("header", True).csv(path)
    if rows.isEmpty():
        raise ValueError(f"no metadata in {path}")
    return rows.withColumn("gender", F.when(F.lower("gender") == "female", 0).when(F.lower("gender") == "male", 1))


def count_key(spark: SparkSession, path: str, column: str, value: str) -> int:
    """Rows of a CSV file with ``value``; 0 for a file that is missing or has no such column."""
    try:
        return spark.read.option("header", True).csv(path).where(F.col(column) == value).count()
    except AnalysisException:
        return 0


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A published corpus, or None where it cannot be read."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_pages(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """(url, category, html) of the files of a crawl's folder; the folder that holds a file names its category."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    where = F.col("_metadata.file_path")
    return files.select(where.alias("url"), F.element_at(F.split(where, "/"), -2).alias("category"), F.col("value").alias("html"))


def read_waveforms(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """(path, audio bytes) of the files of a folder, for a decoder that the caller brings."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("content").alias("audio"))
