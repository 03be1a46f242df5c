"""Sharding by jump consistent hashing (Lamping and Veach), in DataFrame functions only.

A key visits a rising sequence of shard numbers, the next one drawn from a generator seeded with the key; its shard is
the last number below the shard count. No ring table is needed, and appending a shard moves only the keys whose sequence
visits the new number, all of them into it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one slot-numbering group, on average, and of one piece of equal rows.
SLOT_GROUP = 4096


def jump_walk(key: Column, shards: int) -> Column:
    """struct<last, next>: the last visited number below ``shards`` and the first one at or above it.

    The generator is xxhash64(key, step), of which 31 bits are used. Each step moves up by one at least, so ``shards``
    steps always suffice. A null key hashes like any other value.
    """
    start = F.struct(F.lit(-1).cast("long").alias("last"), F.lit(0).cast("long").alias("next"))

    def step(at, i):
        drawn = F.shiftrightunsigned(F.xxhash64(key, i), 33).cast("double") + 1
        onward = F.floor((at["next"] + 1).cast("double") * (F.lit(2147483648.0) / drawn))
        return F.when(at["next"] < shards, F.struct(at["next"].alias("last"), onward.alias("next"))).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of ``key``, from 0 to ``shards`` - 1."""
    return jump_walk(key, shards)["last"].cast("int")


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` rows as (key, size, text_crc32, shard, slot, grown_shard).

    size: UTF-8 bytes of the text (null: none) plus 16. text_crc32: of the UTF-8 text (null: of no bytes). shard depends
    on key and shard count alone; grown_shard is the shard among ``shards`` + 1. slot numbers the rows of a shard from 0
    without gaps. Rows with equal keys share a shard and get slots of their own; a null key is a key like any other.
    An empty table gives an empty result; other columns are ignored.

    Slots come from small groups, not from one window a shard: rows are grouped by shard and a hash of key and text, the
    groups are counted with partial sums, and each group starts where those before it end. The count of groups follows
    the count of rows. Rows that are alike in every column are counted first and move as one; they are written out again
    in pieces, so that no task gets all rows of a key.
    """
    groups = max(1, math.ceil(docs.count() / (shards * SLOT_GROUP)))
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).select(
        "k",
        (F.coalesce(F.octet_length("t"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("t"), F.lit("")).cast("binary")).alias("text_crc32"),
        jump_walk(F.col("k"), shards).alias("walk"),
        F.pmod(F.xxhash64("k", "t"), F.lit(groups)).cast("int").alias("part"),
    )
    grown = F.when(F.col("walk.next") == shards, F.lit(shards)).otherwise(F.col("walk.last"))
    rows = rows.select("k", "size", "text_crc32", "part", F.col("walk.last").cast("int").alias("shard"), grown.cast("int").alias("grown_shard"))
    alike = rows.groupBy("shard", "part", "k", "text_crc32", "size", "grown_shard").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard", "part").orderBy("k", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    offsets = alike.groupBy("shard", "part").agg(F.sum("n").alias("rows")).select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    placed = alike.withColumn("at", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(offsets, ["shard", "part"]).withColumn("first", F.col("offset") + F.col("at"))
    pieces = placed.withColumn("lo", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SLOT_GROUP).cast("long"))))
    numbered = pieces.repartition("shard", "part", "k", "lo").withColumn(
        "slot", F.explode(F.sequence(F.col("first") + F.col("lo"), F.col("first") + F.least(F.col("lo") + SLOT_GROUP, "n") - 1))
    )
    return numbered.select(F.col("k").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")


def shard_sizes(assigned: DataFrame) -> DataFrame:
    """Rows and bytes of each shard."""
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"))
