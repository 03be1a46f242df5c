"""Incremental forms of the batch operators, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomtext.functions.text import key_strip
from loomtext.operators.merge import provenance_merge


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int = 64) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def merge_available(stream: DataFrame, state: str, checkpoint: str, order: str = "ord") -> StreamingQuery:
    """Merges what has arrived into versions of a corpus at ``state``, by K2 key, earlier batches first; then stops.

    Each batch reads the last whole version, whatever query wrote it, and writes the next one. A batch that runs again
    after a failure merges what is already there, which changes nothing. Versions are whole corpora; older ones may go.
    """

    def versions(spark: SparkSession) -> list[int]:
        """Numbers of the versions that were written to their end."""
        root = spark._jvm.org.apache.hadoop.fs.Path(state)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        marks = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/v=*/_SUCCESS")) or []
        return sorted(int(m.getPath().getParent().getName()[2:]) for m in marks)

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.select("text", "sources", F.struct(F.lit(1).alias("rank"), F.col(order).cast("long").alias("ord")).alias("_o"))
        last = max(versions(spark), default=-1)
        if last >= 0:
            old = spark.read.parquet(f"{state}/v={last}")
            new = old.select("text", "sources", F.struct(F.lit(0).alias("rank"), F.lit(0).cast("long").alias("ord")).alias("_o")).unionByName(new)
        provenance_merge(new, F.col("_o")).write.mode("overwrite").parquet(f"{state}/v={last + 1}")

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(stream: DataFrame, time: str, text: str = "text", delay: str = "1 day") -> DataFrame:
    """Rows whose K2 key has not come within ``delay`` of event time; state is dropped after that."""
    keyed = stream.withColumn("_t", F.col(time).cast("timestamp")).withColumn("_key", key_strip(F.col(text)))
    return keyed.withWatermark("_t", delay).dropDuplicatesWithinWatermark(["_key"]).drop("_t", "_key")


def windowed_counts(stream: DataFrame, time: str, by: str, size: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts by window and ``by``; rows later than ``delay`` are left out."""
    timed = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay)
    window = F.window("_t", size, slide) if slide else F.window("_t", size)
    grouped = timed.groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n_rows")
