"""Comparisons of corpora: loss, id sets, schemas; deterministic samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.text import digest, key_strip


def _keys(rows: DataFrame, text: str) -> DataFrame:
    """(digest, key) of each distinct K2 key that is not blank; keys meet by digest, one of each moves for a task."""
    keys = rows.select(key_strip(F.col(text)).alias("key")).where("key <> ''")
    return keys.groupBy(digest(F.col("key")).alias("digest")).agg(F.first("key").alias("key"))


def lost_keys(baseline: DataFrame, new: DataFrame, text: str = "text") -> DataFrame:
    """K2 keys of the baseline that the new corpus lacks; blanks don't count."""
    return _keys(baseline, text).join(_keys(new, text).select("digest"), "digest", "left_anti").select("key")


def baseline_loss(baseline: DataFrame, new: DataFrame, text: str = "text") -> DataFrame:
    """One row: keys missing from the new corpus, added by it, and common to both, from one aggregation of digests."""
    sides = [rows.select(key_strip(F.col(text)).alias("key"), F.lit(k).alias("side")).where("key <> ''") for k, rows in enumerate((baseline, new))]
    keys = sides[0].unionByName(sides[1]).groupBy(digest(F.col("key")).alias("key")).agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return keys.agg(F.count_if(F.col("hi") == 0).alias("missing"), F.count_if(F.col("lo") == 1).alias("added"), F.count_if(F.col("lo") < F.col("hi")).alias("common"))


def compare_ids(one: DataFrame, two: DataFrame, key: str) -> DataFrame:
    """One row: ids in both, in one of them only, and in either."""
    a, b = one.select(key).where(F.col(key).isNotNull()).distinct().withColumn("a", F.lit(1)), two.select(key).where(F.col(key).isNotNull()).distinct().withColumn("b", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("common"), F.count_if(F.col("b").isNull()).alias("only_one"), F.count_if(F.col("a").isNull()).alias("only_two"), F.count(F.lit(1)).alias("either"))


def new_by_category(old: DataFrame, new: DataFrame, key: str, category: Column) -> DataFrame:
    """(category, n_rows) of the rows whose key the old table lacks."""
    return new.join(old.select(key).distinct(), key, "left_anti").groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n_rows"))


def compare_schemas(one: DataFrame, two: DataFrame) -> DataFrame:
    """(column, side, same_type) for every column of either table: side is both, one or two."""
    a, b = dict(one.dtypes), dict(two.dtypes)
    rows = [(c, "both" if c in a and c in b else "one" if c in a else "two", a.get(c) == b.get(c)) for c in sorted({*a, *b})]
    return one.sparkSession.createDataFrame(rows, "column string, side string, same_type boolean")


def draw(seed: int, key: Column) -> Column:
    """A number in text form that orders rows the same way in any engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by the order of draw(), or all if there are no more."""
    return rows.orderBy(draw(seed, F.col(key)), key).limit(n)


#: Rows among which the boundary of a split is looked for by sorting; more are counted by range first.
BOUNDARY_ROWS = 10_000


def train_test(rows: DataFrame, key: str, train: int, seed: int = 42, boundary_rows: int = BOUNDARY_ROWS) -> DataFrame:
    """``rows`` with split: the first ``train`` rows by draw() are train, the others test. Too few rows are an error.

    Only the boundary is looked for: counts by the next three digits of draw() show the range that holds it, at most
    4,096 numbers each time, until the range is small enough to sort.
    """
    d = draw(seed, F.col(key))
    inside, prefix, need = rows.select(d.alias("d"), F.col(key).alias("k")), "", train
    while True:
        at = len(prefix)
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(F.substring("d", at + 1, 3).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect() if r["p"] is not None)
        if not at and train >= sum(n for _, n in counts):
            raise ValueError("train must be smaller than the number of rows")
        n = 0
        for p, n in counts:
            if need <= n:
                break
            need -= n
        prefix += p
        inside = inside.where(F.startswith("d", F.lit(prefix)))
        if n <= boundary_rows or len(prefix) >= 32:
            break
    last = inside.orderBy("d", "k").limit(need).agg(F.max(F.struct("d", "k")).alias("last"))
    return rows.crossJoin(F.broadcast(last)).withColumn("split", F.when(F.struct(d.alias("d"), F.col(key).alias("k")) <= F.col("last"), "train").otherwise("test")).drop("last")
