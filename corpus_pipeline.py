"""The corpus pipeline over ``documents``: classify, drop repeated lines, drop near duplicates, decontaminate, encode.

Each stage works on all documents that the one before it kept. Every result but the last is a table of documents, written
as Parquet in the shared folder and read again, so a lost executor repeats tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomtext.llm import stages
from loomtext.llm.staging import staged
from loomtext.session import table

STAGES = [
    ("quality_classifier", stages.classify),
    ("line_dedup", stages.drop_lines),
    ("jaccard_join", stages.drop_near_duplicates),
    ("decontamination", stages.decontaminate),
    ("sentencepiece", stages.encode),
]

#: The fitted classifier of the first stage is beyond SQL, and with it all that follows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
