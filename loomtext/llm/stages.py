"""Pipeline stages: each takes all documents that the stage before it kept and returns documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import quality as _quality
from loomtext.llm.decontaminate import contamination
from loomtext.llm.jaccard import near_duplicates
from loomtext.llm.linededup import drop_repeated_lines
from loomtext.llm.staging import fresh, row_key
from loomtext.llm.unigram import encode_texts
from loomtext.session import ship, table

#: Shingle size and similarity at which documents count as near duplicates.
SHINGLE, PERCENT = 5, 80


def _with_length(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with n_chars, where it has that column, as the length of the text it has now."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in names])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, unchanged.

    Null and empty texts are scored like any other, repeated rows stay repeated, and an empty table stays empty.
    """
    ship(spark)
    model = _quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    return _quality.score_quality(docs, model).where(F.col("score") >= _quality.THRESHOLD).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeats of runs of lines; one that loses all its words goes.

    Null and empty texts stay, rows that repeat id and text are treated alike, and an empty table stays empty.
    """
    left = drop_repeated_lines(docs)
    return _with_length(left.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least doc_id; documents without words all stay.

    Of rows that repeat id and text one stays. A component without any doc_id keeps one of its texts. An empty table stays
    empty.
    """
    ship(spark)
    found = near_duplicates(docs, size=SHINGLE, percent=PERCENT)
    first = found.where("n > 0").where(F.col("doc_id").eqNullSafe(F.col("component_doc"))).groupBy("component").agg(F.min("key").alias("key")).select("key")
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, row_key("doc_id", "text"))
    wordless = found.where("n = 0").select("key").distinct()
    single = keyed.join(first.withColumnRenamed("key", row), row, "left_semi").dropDuplicates([row])
    return single.unionByName(keyed.join(wordless.withColumnRenamed("key", row), row, "left_semi")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item, unchanged.

    Null and empty texts have no window and stay, as do repeated rows; without items, or without documents, nothing goes.
    An item of fewer than ten words is one window of all its words, as op2 defines it, whatever their number.
    """
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, row_key("doc_id", "text"))
    hit = contamination(keyed.select(row, "text"), table(spark, sf_dir, "benchmark"), doc_id=row).where("n_hit > 0").select(F.col("doc_id").alias(row))
    return keyed.join(hit, row, "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): the texts as SentencePiece ids, whose decoding is compared.

    Null and empty texts have no ids; repeated rows stay repeated; an empty table gives an empty result.
    """
    import public_tokenizers

    ship(spark)
    rows = encode_texts(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    given = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    return rows.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == given).alias("round_trip"))
