"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A window is a shortest run of whole lines with MIN_WORDS words: from each line forwards, and up to each line backwards.
Its fingerprint is its least line hash, so a run of lines that repeats, with MIN_WORDS words or more, has the same
fingerprints wherever it stands. Fingerprints that occur once are dropped. The windows of the others are joined by
fingerprint and content with their first occurrence; forward windows extend a match to its first line and backward
windows to its last, and the lines that later occurrences cover go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.staging import fresh, row_key, staged

#: Words of the shortest repeated run that is removed.
MIN_WORDS = 30


def line_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(row, doc_id, at, words, hash) of each line that has words; words are runs of anything but spaces."""
    lines = docs.select(row_key(doc_id, text).alias("row"), F.col(doc_id).alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("at", "line"))
    words = F.size(F.filter(F.split("line", " "), lambda x: x != ""))
    return lines.select("row", "doc_id", "at", words.alias("words"), F.xxhash64("line").alias("hash")).where("words > 0")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(row, gone): for each document with later repeats, the places of the lines to delete.

    First is the occurrence in the least doc_id (nulls before all), then at the least place. Rows that repeat id and
    text are one document here and lose the same lines.
    """
    lines = staged(line_table(docs, doc_id, text), "lines").repartition("row")
    once = lines.withColumn("copy", F.row_number().over(Window.partitionBy("row", "at").orderBy("hash"))).where("copy = 1").drop("copy")
    inside = Window.partitionBy("row").orderBy("at")
    upto = F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    summed = once.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("words"))
    windows = None
    for order, lo, hi in (("before", 0, min_words - 1), ("upto", 1 - min_words, 0)):
        frame = Window.partitionBy("row").orderBy(order).rangeBetween(lo, hi)
        run = summed.select(
            "row", "doc_id", F.min("at").over(frame).alias("lo"), F.max("at").over(frame).alias("hi"), F.sum("words").over(frame).alias("total"),
            F.min(F.struct("hash", "at")).over(frame).alias("least"), F.collect_list("hash").over(frame).alias("hashes"),
        ).where(F.col("total") >= min_words)
        part = run.select("row", "doc_id", "lo", "hi", F.col("least.hash").alias("print"), F.col("least.at").alias("print_at"), F.xxhash64("hashes").alias("x"), F.xxhash64(F.lit(order == "upto"), "hashes", F.lit(1)).alias("y"))
        windows = part if windows is None else windows.unionByName(part)
    windows = staged(windows, "windows")
    prints = windows.select("print", "row", "print_at").distinct().groupBy("print").agg(F.count(F.lit(1)).alias("often")).where("often > 1").select("print")
    #: a very common line is the print of very many windows; so what follows is dealt by content, not by print
    some = windows.join(prints.hint("merge"), "print").drop("print_at", "print")
    place = F.struct("doc_id", "row", "lo")
    first = some.groupBy("x", "y").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("often")).where("often > 1").drop("often")
    later = some.join(first.hint("merge"), ["x", "y"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("row", F.explode(F.sequence("lo", "hi")).alias("at")).groupBy("row").agg(F.collect_set("at").alias("gone"))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with text as what is left, and n_lines and n_removed: lines with words, and how many of them went.

    Lines are what newlines part; blank ones stay where they are. Null texts stay null and have no lines. A document
    whose lines all go keeps an empty or blank text. An empty table stays empty. Columns named n_lines or n_removed are
    replaced, all others kept.
    """
    gone = repeated_lines(docs, doc_id, text, min_words)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row, dropped, split = (fresh(docs, c) for c in ("_row", "_gone", "_parts"))
    rows = docs.select(*names, row_key(doc_id, text).alias(row)).join(gone.select(F.col("row").alias(row), F.col("gone").alias(dropped)), row, "left")
    rows = rows.withColumn(split, F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), dropped)
    left = F.array_join(F.transform(kept, lambda i: F.get(split, i)), "\n")
    full = F.size(F.filter(split, lambda x: F.replace(x, F.lit(" "), F.lit("")) != ""))
    return rows.select(
        *[F.when(F.col(dropped).isNull(), F.col(c)).otherwise(left).alias(c) if c == text else F.col(c) for c in names],
        full.cast("long").alias("n_lines"), F.when(F.col(dropped).isNull(), 0).otherwise(F.size(dropped)).cast("long").alias("n_removed"),
    )
