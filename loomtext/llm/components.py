"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.staging import staged


#: Links up to this many (16 bytes each) are contracted by one task in one pass; more by rounds of star contraction.
ONE_TASK_LINKS = 200_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, label) of all links by union-find, the smaller root on top."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while above[top] != top:
            top = above[top]
        while above[x] != top:
            above[x], x = top, above[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            above.setdefault(a, a)
            above.setdefault(b, b)
            a, b = root(a), root(b)
            above[max(a, b)] = min(a, b)
    nodes = list(above)
    yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["node", "label"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, one_task_links: int = ONE_TASK_LINKS) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b: long): label is the smallest node it can reach.

    Few links are contracted in one pass. Otherwise each round is staged in the shared folder; rounds grow with the logarithm of the longest path. Links of a node with
    itself are ignored, so such a node alone does not appear. No links give an empty table.
    """
    edges = staged(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b").distinct(), "edges")
    if edges.count() <= one_task_links:
        return staged(edges.repartition(1).mapInArrow(_contracted, "node long, label long"), "labels")
    total = None
    while True:
        edges = staged(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == total:
            break
        total = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
