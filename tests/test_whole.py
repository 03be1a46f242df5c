"""Queries over whole tables, on small tables with overlap, ties and missing sources."""

import pytest

from loomtext.operators import stats
from loomtext.plans import catalog


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents 1 to 8, of which 3 stands twice; labels of 2, 3 (twice), 4, and of two ids that no document has."""
    path = str(tmp_path_factory.mktemp("small"))
    docs = [(k, f"text {k}", "en" if k % 2 else "fr", f"src{k % 3}", 6) for k in range(1, 9)] + [(3, "again", "de", "src0", 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(2, 1, 0), (3, 0, 1), (3, 1, 0), (4, 0, 0), (9, 1, 1), (11, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_keyed_append_takes_all_labels_and_documents(spark, small):
    got = sorted(tuple(r) for r in catalog.queries()["keyed_append_merge_whole"](spark, small).select("doc_id", "quality", "toxic").collect())
    assert got == [(1, 9, 9), (2, 1, 0), (3, 1, 0), (4, 0, 0), (5, 9, 9), (6, 9, 9), (7, 9, 9), (8, 9, 9), (9, 1, 1), (11, 0, 0)]


def test_keyed_enrich_takes_all_labels_and_documents(spark, small):
    got = sorted(tuple(r) for r in catalog.queries()["keyed_enrich_merge_whole"](spark, small).select("doc_id", "quality", "lang").collect())
    assert got == [(1, -1, "en"), (2, 1, "fr"), (3, 1, "en"), (4, 0, "fr"), (5, -1, "en"), (6, -1, "fr"), (7, -1, "en"), (8, -1, "fr"), (9, 1, None), (11, 0, None)]


def test_every_document_is_evaluated(spark, small):
    got = sorted(tuple(r) for r in catalog.queries()["source_language_join_whole"](spark, small).select("source", "examples", "evaluated").collect())
    assert got == [("src0", 3, 3), ("src1", 3, 3), ("src2", 3, 3)]


def test_a_source_without_evaluation_stays(spark):
    by_source = spark.createDataFrame([("a", 2), ("b", 1)], "source string, examples long")
    seen = spark.createDataFrame([("a", 2), ("c", 5)], "source string, evaluated long")
    assert sorted(tuple(r) for r in stats.sources_with_language(by_source, seen).collect()) == [("a", 2, 2), ("b", 1, None)]


def test_wer_of_every_turn(spark, tmp_path):
    turns = [(1, 0, "user", "one two three"), (1, 1, "assistant", "four five"), (2, 0, "system", ""), (2, 1, None, "six")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.conv_id, r.turn): r.wer for r in catalog.queries()["wer"](spark, str(tmp_path)).collect()}
    assert set(got) == {(1, 0), (1, 1), (2, 0), (2, 1)} and got[2, 0] == 0.0
