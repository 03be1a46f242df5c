"""Merging, filters, segmentation, comparison and gates on small tables."""

import pytest
from pyspark.sql import functions as F

from loomtext.operators import filters, html, merge, segment, setops, stats
from loomtext.plans.datacard import build_card, size_name
from loomtext.plans.gates import GateConfig, GateReport, gate_schema, run_gates

CORPUS = "text string, sources array<string>, ord long"


def corpus(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CORPUS)


def test_provenance_merge_keeps_first_text_and_all_sources(spark):
    rows = corpus(spark, [(" Bonjour", ["b"]), ("bonjour\xa0", ["a", "b"]), ("autre", []), ("", None), (None, ["c"])])
    got = {r.text: r.sources for r in merge.provenance_merge(rows, F.col("ord")).collect()}
    assert got == {" Bonjour": ["a", "b"], "autre": [], "": ["c"]}
    assert merge.provenance_merge(rows, F.col("ord"), drop_blank=True).count() == 2


def test_append_merge_and_bag(spark):
    a, b = corpus(spark, [("x", ["a"]), (None, ["a"])]), corpus(spark, [("X ", ["b"]), ("y", ["b"]), (None, ["b"])])
    assert sorted((r.text or "", r.sources) for r in merge.append_merge([a, b]).collect()) == [("", ["a"]), ("x", ["a"]), ("y", ["b"])]
    assert merge.bag_union([a, b]).count() == 5


def test_keyed_merges(spark):
    old = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "id long, v string, o long")
    new = spark.createDataFrame([(2, "d", 0), (3, "e", 1), (3, "f", 2)], "id long, v string, o long")
    assert sorted((r.id, r.v) for r in merge.keyed_append(old, new, "id", "o").collect()) == [(1, "b"), (2, "c"), (3, "e")]
    extra = spark.createDataFrame([(1, "dom", 0), (4, "dom4", 0)], "id long, domain string, o long")
    got = {r.id: (r.v, r.domain) for r in merge.keyed_enrich(old, extra, "id", "o", ["domain"]).collect()}
    assert got == {1: ("b", "dom"), 2: ("c", None), 4: (None, "dom4")}


def test_ingest_counts_each_row_once(spark):
    rows = spark.createDataFrame([("s", "a b c", "t"), ("s", "A B C ", "t"), ("s", "a b", "t"), ("s", "d e f", "x"), ("r", "a b c", "t")], "source string, text string, lang string").withColumn("o", F.monotonically_increasing_id())
    got = {(r.source, r.reason): r.n_rows for r in filters.reason_counts(filters.ingest_reasons(rows, F.col("lang"), F.lit(1.0), "t", F.col("o")), "source").collect()}
    assert got == {("s", "kept"): 1, ("s", "dup"): 1, ("s", "short"): 1, ("s", "lang"): 1, ("r", "kept"): 1}


def test_validation_chain(spark):
    long = "nga " * 20
    rows = spark.createDataFrame([(None,), ("",), ("nga " * 19,), (long,), ("<p>" * 30 + " x" * 20,), ("word " * 20,)], "text string")
    assert [r.v.reason for r in rows.select(filters.validation(F.col("text")).alias("v")).collect()] == ["no_content", "no_content", "too_short", "passed", "html_residual", "not_target"]


def test_fragments(spark):
    rows = spark.createDataFrame([(1, "Good morning all. Yes it is. Short.", ["a"]), (2, "good  MORNING all. Yes it is.", ["b"]), (3, None, ["c"]), (4, "```code. more```", ["d"])], "doc_id long, text string, sources array<string>")
    got = sorted((r.doc_id, r.part, r.reason) for r in segment.split_fragments(rows).collect())
    assert got == [(1, 0, "kept"), (1, 1, "short"), (2, 0, "dup"), (4, 0, "kept")]


def test_asr_documents(spark):
    chunks = spark.createDataFrame([("v", 1, "c d e", 0.9), ("v", 0, "a b c d", 0.5), ("v", 2, "noise", 0.4), ("w", 0, "x", 0.1)], "video string, chunk_id int, text string, confidence double")
    got = {r.video: (r.n_chunks, r.raw, r.low_confidence) for r in segment.asr_documents(chunks, "video").collect()}
    assert got == {"v": (3, "a b c d e", 1), "w": (1, "", 1)}


def test_audio_windows(spark):
    rows = spark.createDataFrame([(0,), (11,), (12,), (13,), (23,), (30,)], "n int")
    got = rows.select(segment.windows_without_tail(F.col("n"), 12, 11).alias("a"), segment.windows_padded(F.col("n"), 20, 18).alias("b")).collect()
    assert [r.a for r in got] == [[], [], [0], [0], [0, 11], [0, 11]]
    assert [[tuple(x) for x in r.b] for r in got] == [[], [(0, 9)], [(0, 8)], [(0, 7)], [(0, 0), (18, 15)], [(0, 0), (18, 8)]]


def test_set_comparisons(spark):
    a, b = corpus(spark, [("a a", []), ("b b", []), (" ", [])]), corpus(spark, [("A A", []), ("c c", [])])
    assert tuple(setops.baseline_loss(a, b).first()) == (1, 1, 1)
    assert [r.key for r in setops.lost_keys(a, b).collect()] == ["b b"]
    ids = spark.createDataFrame([(1,), (2,), (2,)], "id long"), spark.createDataFrame([(2,), (3,)], "id long")
    assert tuple(setops.compare_ids(*ids, "id").first()) == (1, 1, 1, 3)
    with pytest.raises(ValueError):
        setops.train_test(ids[0], "id", 3)


def test_statistics(spark):
    rows = corpus(spark, [("a b", ["x", "x"]), (None, None), ("  ", [])])
    totals = stats.corpus_totals(rows).first()
    assert (totals.examples, totals.tokens, totals.bytes, totals.empty_examples) == (3, 2, 5, 2)
    assert {r.source: r.examples for r in stats.stats_by_source(rows).collect()} == {"x": 2, "__unknown__": 2}
    assert stats.corpus_totals(rows.limit(0)).first().avg_tokens == 0
    lengths = spark.createDataFrame([("g", n) for n in (1, 2, 3, 4)], "g string, n long")
    assert stats.length_stats(lengths, F.col("n"), "g").first().upper_median == 3


def test_cards_of_a_list_page(spark):
    page = '<article class="post-7 category-news category-art"><h2><a href="/x">A <b>title</b></a></h2><time datetime="2020-01-02"></time><p>First</p></article><article class="post-8"><p>none</p></article>'
    card = spark.createDataFrame([(page,)], "h string").select(html.list_cards(F.col("h")).alias("c")).first().c
    assert [(c.id, c.url, c.categories, c.published, c.excerpt) for c in card] == [("7", "/x", ["news", "art"], "2020-01-02", "First")]


def good(spark):
    return corpus(spark, [("man maa ngi fi", ["a"]), ("naka nga def", ["b"]), ("jërëjëf waay", ["a", "b"])]).drop("ord")


def verdicts(report):
    return {r.name: r.passed for r in report.results}


def test_gates(spark):
    loose = GateConfig(min_examples=3, min_text_mb=0.0, min_target_pct=0.0, require_no_loss=False)
    report = run_gates(good(spark), loose, {"lid": {"target_pct": 95.0}})
    assert report.all_passed and len(report.results) == 6
    assert not verdicts(run_gates(good(spark), GateConfig(min_examples=4)))["min_examples"]
    assert not gate_schema(good(spark).drop("sources"), ("text", "sources")).passed
    assert not gate_schema(good(spark).withColumn("sources", F.lit("x")), ("text", "sources")).passed
    blank = corpus(spark, [("ok ok", []), ("   ", []), ("", [])])
    assert verdicts(run_gates(blank, GateConfig(max_empty=2)))["empty_texts"] and not verdicts(run_gates(blank, GateConfig(max_empty=1)))["empty_texts"]
    same = corpus(spark, [("Bonjour", []), ("bonjour", []), ("autre", [])])
    assert not verdicts(run_gates(same, GateConfig()))["duplicates"] and verdicts(run_gates(same, GateConfig(max_duplicate_pct=50.0)))["duplicates"]
    assert not verdicts(run_gates(good(spark), GateConfig(), {"lid": {"target_pct": 80}}))["target_lang_pct"]
    assert not verdicts(run_gates(good(spark), GateConfig(), {"lid": None}))["target_lang_pct"]
    assert GateReport().all_passed


def test_loss_gate(spark):
    new = corpus(spark, [("a a", []), ("b b", []), ("c c", [])])
    gate = lambda base, **k: verdicts(run_gates(new, GateConfig(**k), None, base))["no_baseline_loss"]
    assert gate(corpus(spark, [("a a", []), ("b b", [])])) and not gate(corpus(spark, [("a a", []), ("ZZZ", [])]))
    assert gate(None) and not gate(None, fail_closed=True)


def test_size_gate(spark):
    rows = corpus(spark, [("x" * 1_000_000, [])])
    assert verdicts(run_gates(rows, GateConfig(min_text_mb=0.5)))["raw_text_size"] and not verdicts(run_gates(rows, GateConfig(min_text_mb=2.0)))["raw_text_size"]


def test_card(spark):
    card = build_card(good(spark), {"lid": {"target_pct": 95.0}, "by_source": {"src": {"examples": 2, "tokens": 9}}}, language="wo")
    assert "num_examples: 3" in card and "- wo" in card and "`src`" in card and "95.0%" in card
    assert "Target" not in build_card(good(spark), {"lid": None})
    assert [size_name(n) for n in (999, 1000, 10**7)] == ["n<1K", "1K<n<10K", "10M<n<100M"]
