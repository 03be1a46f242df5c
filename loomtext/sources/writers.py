"""Sinks. Large tables go through Spark's writers; small reports are written by the driver."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators.html import video_list


def write_parquet(rows: DataFrame, path: str, *partition_by: str, shards: int | None = None) -> None:
    """Overwrites ``path``; ``shards`` sets the number of files, for publication only."""
    rows = rows.repartition(shards) if shards else rows
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_split(rows: DataFrame, test: Column, path: str) -> None:
    """One pass over ``rows`` into passed=true and passed=false; null fails."""
    write_parquet(rows.withColumn("passed", F.coalesce(test, F.lit(False))), path, "passed")


def _path(spark: SparkSession, path: str):
    """(file system, path) in whatever store ``path`` names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small file, in any store that Spark reaches."""
    fs, target = _path(spark, path)
    out = fs.create(target, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None where there is none."""
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return None
    return spark.read.text(path, wholetext=True).first()["value"]


def write_json(report: dict, path: str, spark: SparkSession | None = None) -> None:
    write_text(spark or SparkSession.active(), json.dumps(report, ensure_ascii=False, indent=2, default=str), path)


def _rename(fs, source, target) -> None:
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


def publish_directory(rows: DataFrame, path: str, card: str, token: str, shards: int | None = None) -> None:
    """Writes data and card beside the target, then renames: readers never see a mixture of the old and the new corpus.

    For the moment between two renames there is no target. Should the second fail, the old corpus is put back and the
    error raised; the old one is deleted only once the new one stands in its place.
    """
    spark = rows.sparkSession
    fs, target = _path(spark, path)
    stage, old = (_path(spark, f"{path}._{name}_{token}")[1] for name in ("stage", "old"))
    write_parquet(rows, f"{stage}/data", shards=shards)
    spark.createDataFrame([(card,)], "value string").coalesce(1).write.text(f"{stage}/card")
    replaced = fs.exists(target)
    if replaced:
        _rename(fs, target, old)
    try:
        _rename(fs, stage, target)
    except Exception:
        if replaced:
            _rename(fs, old, target)
        raise
    if replaced:
        fs.delete(old, True)


def write_by_category(rows: DataFrame, category: str, path: str) -> None:
    """All rows under all, and again under by_category with a folder for each category."""
    write_parquet(rows, f"{path}/all")
    write_parquet(rows, f"{path}/by_category", category)


def write_per_video(rows: DataFrame, path: str, key: str = "video_id") -> None:
    """A JSON folder for each video, and all of them again as one summary."""
    rows.withColumn("video", F.col(key)).repartition("video").write.mode("overwrite").partitionBy("video").json(f"{path}/videos")
    write_jsonl(rows, f"{path}/summary")


def write_video_list(articles: DataFrame, article: str, title: str, path: str) -> None:
    """The videos of articles as CSV, one row for each."""
    write_csv(video_list(articles, article, title), path)


def write_train_test(rows: DataFrame, path: str, shards: int | None = None) -> None:
    """Rows with a split column into split=train and split=test."""
    write_parquet(rows, path, "split", shards=shards)
