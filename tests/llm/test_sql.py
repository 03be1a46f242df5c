"""The registered queries against their SQL, and what SQL cannot say against plain Python, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loomtext.llm import catalog, sharding

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({catalog.oracle_sql()[name]})").fetchall(), key=str)


def test_jump_hash_against_its_plain_form(spark):
    keys = spark.range(300).select("id", *[F.xxhash64("id", F.lit(i)).alias(f"h{i}") for i in range(1, 42)], sharding.jump_shard(F.col("id"), 40).alias("a"), sharding.jump_shard(F.col("id"), 41).alias("b"))

    def plain(row, shards):
        last, at, i = -1, 0, 1
        while at < shards:
            drawn = ((row[f"h{i}"] & (1 << 64) - 1) >> 33) + 1
            last, at, i = at, int((at + 1) * (2147483648.0 / drawn)), i + 1
        return last

    for row in keys.collect():
        assert row.a == plain(row, 40) and row.b == plain(row, 41)


def test_stages_with_odd_rows(spark, tmp_path):
    """Nulls, empty texts, repeated rows and empty tables through every stage."""
    pipeline = pytest.importorskip("corpus_pipeline")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"word{k}" for k in range(80))
    rows = [(None, None, None, None, None), (1, None, "en", "s", None), (2, "", "en", "s", 0), (3, long, "en", "s", len(long)), (3, long, "en", "s", len(long)), (None, long + " end", None, "s", 9), (4, "two words", None, None, 9)]
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    left = {"quality_classifier": None, "line_dedup": 7, "jaccard_join": 5, "decontamination": 7, "sentencepiece": 7}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        n = out.count()
        assert n == left[name] or left[name] is None and n <= 7, (name, n)
        assert name == "sentencepiece" or out.columns == docs.columns
        assert stage(spark, none, str(tmp_path)).count() == 0
