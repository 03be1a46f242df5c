"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions only.

An item's windows of ten consecutive words (one window for a shorter item) are sets of positioned shingles. A window
occurs in a document only if all its shingles do, so for full containment the prefix is one shingle: its rarest. The
documents are read once; positions whose shingle belongs to some item are staged with the words around them. From that
table come the shingle frequencies over all documents, then the join of each window's rarest shingle, the length and
positional bounds, and the comparison of the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.staging import staged

WINDOW = 10
SHINGLE = 5
#: Item shingles up to this many are sent to every executor (about 16 bytes each); more are joined by a shuffle.
BROADCAST_SHINGLES = 1_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Token of the row that stands for the end of a document.
END = 0


def words_of(text: Column) -> Column:
    """Words of ``text`` after lower-casing A-Z alone; null and wordless texts give an empty array."""
    given = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(given) == F.length(given), F.lower(given)).otherwise(F.translate(given, UPPER, UPPER.lower()))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _token(words: Column, at: Column, first: Column, size: int) -> Column:
    """Hash of the ``size`` words from position ``at`` (from 0), whose first word is ``first``."""
    return F.xxhash64(F.lit(size), first, *[F.get(words, at + i) for i in range(1, size)])


def item_windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """(win, item, s, size, token): every shingle of every window; win is the array of the window's words."""
    base = items.select(F.col(item_id).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.lit(window), F.size("words"))
    wins = base.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("win"))
    rows = None
    for size in range(1, shingle + 1):
        of_size = F.size("win") == size if size < shingle else F.size("win") >= size
        part = wins.where(of_size).select("item", "win", F.posexplode(F.slice("win", F.lit(1), F.size("win") - size + 1)).alias("s", "first"))
        part = part.select("item", "win", "s", F.lit(size).alias("size"), _token(F.col("win"), F.col("s"), F.col("first"), size).alias("token"))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def find_windows(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(documents, hits): documents as (row, doc_id, n_words), hits as (row, start, size, win, item).

    ``row`` tells apart rows that repeat a doc_id. Null and empty texts have no words and no hits; an empty item has no
    window. Either table may be empty.
    """
    wins = staged(item_windows(items, item_id, item_text, window, shingle), "windows")
    sizes = sorted(r["size"] for r in wins.select("size").distinct().collect())
    known = wins.select("size", "token").distinct()
    small = known.count() <= BROADCAST_SHINGLES
    known = known.unionByName(known.sparkSession.range(1).select(F.lit(END).alias("size"), F.lit(END).cast("long").alias("token")))
    base = docs.select(F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words")).withColumn("row", F.monotonically_increasing_id())
    at = base.select("row", "doc_id", "words", F.posexplode(F.concat("words", F.array(F.lit("")))).alias("at", "first"))
    n, pos = F.size("words"), F.col("at")
    tokens = F.array(*[F.when(pos + size <= n, F.struct(F.lit(size).alias("size"), _token(F.col("words"), pos, F.col("first"), size).alias("token"))) for size in sizes], F.when(pos == n, F.struct(F.lit(END).alias("size"), F.lit(END).cast("long").alias("token"))))
    if sizes == [shingle]:  # the usual case stays free of a second generator
        full = pos + shingle <= n
        at = at.where(full | (pos == n)).select("row", "doc_id", "words", "at", F.when(full, shingle).otherwise(END).alias("size"), F.when(full, _token(F.col("words"), pos, F.col("first"), shingle)).otherwise(F.lit(END).cast("long")).alias("token"))
    else:
        at = at.select("row", "doc_id", "words", "at", F.explode(F.array_compact(tokens)).alias("x")).select("row", "doc_id", "words", "at", "x.size", "x.token")
    reach = F.when(F.col("size") == shingle, window - shingle).otherwise(0)
    low = F.greatest(pos - reach, F.lit(0))
    around = F.when(F.col("size") > 0, F.slice("words", low + 1, pos - low + F.greatest(F.col("size") + reach, F.lit(1))))
    known = F.broadcast(known) if small else known
    found = at.join(known, ["token", "size"]).select("row", "doc_id", pos, "size", "token", F.size("words").alias("n_words"), low.alias("low"), around.alias("around"))
    found = staged(found, "shingles")
    ends = found.where(F.col("size") == END).select("row", "doc_id", "n_words")
    seen = found.where(F.col("size") > END)

    often = seen.groupBy("token", "size").agg(F.count(F.lit(1)).alias("often"))
    ranked = wins.join(often, ["token", "size"], "left")
    rarest = ranked.groupBy("win").agg(
        F.min(F.struct("often", "token", "s", "size")).alias("least"), F.count_if(F.col("often").isNull()).alias("absent")
    ).where("absent = 0").select("win", F.col("least.token").alias("token"), F.col("least.size").alias("size"), F.col("least.s").alias("s"))
    length = F.size("win")
    start = F.col("at") - F.col("s")
    pairs = seen.join(rarest, ["token", "size"]).where((start >= 0) & (start + length <= F.col("n_words")))
    same = F.slice("around", start - F.col("low") + 1, length) == F.col("win")
    hits = pairs.where(same).select("row", start.alias("start"), length.alias("size"), "win")
    return ends, hits.join(wins.select("win", "item").distinct(), "win").select("row", "start", "size", "win", "item")


def contamination(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """(row, doc_id, n_words, n_hit, items): words inside any occurring window and the sorted ids, as strings, of the items.

    A row for each document: null and empty texts have no words and no hits, and rows that repeat an id stay apart. An
    empty table of documents gives an empty result, an empty one of items no hits; other columns are ignored.
    """
    ends, hits = find_windows(docs, items, **names)
    spans = hits.select("row", "start", (F.col("start") + F.col("size")).alias("end")).distinct().groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct(F.greatest(a["upto"], x["end"]).alias("upto"), (a["n"] + F.greatest(x["end"] - F.greatest(a["upto"], x["start"]), F.lit(0))).cast("long").alias("n")))
    of_items = hits.select("row", F.col("item").cast("string").alias("item")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return ends.join(spans.select("row", covered["n"].alias("n_hit")), "row", "left").join(of_items, "row", "left").select(
        "row", "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
