"""Physical plans: what scans read, and that nothing native runs Python."""

import os
import re

import pytest

from loomtext.plans import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")


def plan(spark, name):
    return catalog.queries()[name](spark, DATA)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


@pytest.mark.parametrize("name,columns", [("corpus_totals", {"text"}), ("split_sentences", {"doc_id", "text"}), ("lang_share", {"lang"}), ("html_residual", {"page_id", "html"}), ("chunk_windows_padded", {"doc_id", "n_chars"})])
def test_scans_read_what_is_used(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(spark, name))
    assert schemas and all({c.split(":")[0] for c in s.split(",")} == columns for s in schemas)


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(value)]" in plan(spark, "duration_format")


@pytest.mark.parametrize("name", ["provenance_merge", "append_merge_first_wins", "split_dedup", "split_counters", "ingest_cascade_counts", "sentence_length_stats", "duplicate_rate"])
def test_keys_are_aggregated_before_they_are_shuffled(spark, name):
    assert re.search(r"partial_(min_by|min|count|collect_set)", plan(spark, name))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_in_the_plan(spark, name):
    assert not re.search(r"EvalPython|ArrowEval|MapInArrow|MapInPandas|FlatMapGroups", plan(spark, name))
