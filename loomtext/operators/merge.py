"""Exact dedup that merges provenance, ordered first-wins dedup, and keyed merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import digest, key_strip, key_squeezed, norm_sources


def provenance_merge(rows: DataFrame, order: Column, text: str = "text", sources: str = "sources", drop_blank: bool = False) -> DataFrame:
    """One row for each K2 key: the first text by ``order`` as it stands, and the sorted union of all sources.

    Sources are exploded and deduplicated by partial aggregation, so a key that very many rows share costs a row for each
    source and task; keys travel as digests. Null sources add none. With ``drop_blank`` keys without text go, else they form one group.
    """
    base = rows.select(key_strip(F.col(text)).alias("key"), F.col(text).alias("text"), norm_sources(F.col(sources)).alias("s"), order.alias("ord"))
    base = base.where("key <> ''") if drop_blank else base
    parts = base.select(digest(F.col("key")).alias("key"), "text", "ord", F.explode_outer("s").alias("source"))
    merged = parts.groupBy("key").agg(F.min_by("text", "ord").alias("text"), F.array_sort(F.collect_set("source")).alias("sources"))
    return merged.select("text", "sources")


def corpus_union_merge(corpora: list[DataFrame], text: str = "text", sources: str = "sources", order: str = "ord") -> DataFrame:
    """provenance_merge() of several corpora; earlier ones come first, blank texts go."""
    ranked = [c.select(text, sources, F.struct(F.lit(k).alias("rank"), F.col(order).alias("ord")).alias("_ord")) for k, c in enumerate(corpora)]
    return provenance_merge(reduce(DataFrame.unionByName, ranked), F.col("_ord"), text, sources, drop_blank=True)


def first_wins(rows: DataFrame, key: Column, *order: Column, last: bool = False) -> DataFrame:
    """The first row of each key by ``order`` (or the last one); null keys equal each other.

    A row for each key and task is shuffled, so a key that very many rows share costs no more than another.
    """
    pick = F.max_by if last else F.min_by
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(key.alias("_key")).agg(pick(whole, F.struct(*order)).alias("_row")).select("_row.*")


def append_merge(corpora: list[DataFrame], text: str = "text", order: str = "ord") -> DataFrame:
    """All corpora end to end; of rows with one K2 key the first stays, its sources unmerged."""
    ranked = [c.withColumn("_rank", F.lit(k)) for k, c in enumerate(corpora)]
    both = reduce(DataFrame.unionByName, ranked)
    key = F.when(F.col(text).isNotNull(), key_strip(F.col(text)))
    return first_wins(both, digest(key), F.col("_rank"), F.col(order)).drop("_rank")


def bag_union(corpora: list[DataFrame]) -> DataFrame:
    """All corpora end to end, without dedup."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), corpora)


def fragment_dedup(fragments: DataFrame, *order: Column, text: str = "text") -> DataFrame:
    """The first fragment of each K3 key, with the sources of its own parent."""
    return first_wins(fragments, digest(key_squeezed(F.col(text))), *order)


def keyed_append(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Existing rows win over new ones: the last of the existing, else the first of the new."""
    kept = first_wins(existing, F.col(key), F.col(order), last=True)
    fresh = first_wins(new, F.col(key), F.col(order)).join(kept.select(key), key, "left_anti")
    return kept.unionByName(fresh)


def keyed_enrich(base: DataFrame, extra: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """Last row of each key in ``base``, with ``columns`` from ``extra`` where it knows the key; its other keys are added."""
    left = first_wins(base, F.col(key), F.col(order), last=True)
    right = first_wins(extra, F.col(key), F.col(order), last=True)
    both = left.alias("l").join(right.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"), "full_outer")
    names = list(dict.fromkeys([*left.columns, *right.columns]))

    def pick(c):
        sides = [F.col(f"{s}.{c}") for s, t in (("l", left), ("r", right)) if c in t.columns]
        if c in columns and c in right.columns:
            sides = sides[::-1]
        return F.coalesce(*sides).alias(c)

    return both.select(*[pick(c) for c in names])
