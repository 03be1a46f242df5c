"""Readers, the runner, publication and streams, end to end in a temporary folder."""

import json

import pytest
from pyspark.sql import functions as F

from loomtext.plans.gates import GateConfig
from loomtext.plans.runner import Config, Pipeline, load_config
from loomtext.sources import readers, writers
from loomtext.streaming import ingest


def test_readers(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.jsonl").write_text('{"text": "x", "sources": ["a"]}\n\n{"text": "y"}\n')
    assert sorted((r.text, r.sources, r.file_name) for r in readers.read_jsonl(spark, str(tmp_path / "j")).collect()) == [("x", ["a"], "a.jsonl"), ("y", None, "a.jsonl")]
    (tmp_path / "t").mkdir()
    (tmp_path / "t/v1.json").write_text('{"text": "hi"}')
    (tmp_path / "t/summary.json").write_text("{}")
    assert [r.video_id for r in readers.read_transcripts(spark, str(tmp_path / "t")).collect()] == ["v1"]
    (tmp_path / "m.csv").write_text("filename|speaker|gender|transcription\na.wav|s|Male|text\n")
    assert readers.read_speech_metadata(spark, str(tmp_path / "m.csv")).first().gender == 1
    assert readers.count_key(spark, str(tmp_path / "none.csv"), "x", "1") == 0
    assert readers.read_or_none(spark, str(tmp_path / "none")) is None


def test_pipeline(spark, tmp_path):
    rows = [("Dafa nga ñu man",), ("dafa nga ñu MAN ",), ("short",), ("all english words here",), ("naka nga def léegi",)]
    spark.createDataFrame(rows, "text string").write.parquet(str(tmp_path / "src"))
    config = {"work_dir": str(tmp_path / "work"), "publish_dir": str(tmp_path / "out"), "sources": [{"name": "s/one", "path": str(tmp_path / "src")}], "gates": {"min_examples": 2, "min_text_mb": 0.0}}
    (tmp_path / "config.json").write_text(json.dumps(config))
    pipeline = Pipeline(spark, load_config(str(tmp_path / "config.json")))
    assert pipeline.run("all") and pipeline.run("publish")
    assert spark.read.parquet(str(tmp_path / "out/data")).count() == 2
    report = json.loads((tmp_path / "work/ingest_report.json").read_text())
    assert report == {"s/one/kept": 2, "s/one/dup": 1, "s/one/short": 1, "s/one/lang": 1}
    refused = Pipeline(spark, Config(work_dir=str(tmp_path / "work"), publish_dir=str(tmp_path / "no"), gates=GateConfig()))
    assert not refused.run("publish") and not (tmp_path / "no").exists()


def test_split_sink(spark, tmp_path):
    writers.write_split(spark.createDataFrame([(1,), (2,), (None,)], "x int"), F.col("x") > 1, str(tmp_path / "s"))
    assert {r.passed: r["count"] for r in spark.read.parquet(str(tmp_path / "s")).groupBy("passed").count().collect()} == {"true": 1, "false": 2}


def test_streams(spark, tmp_path):
    schema = "text string, sources array<string>, ord long"
    for k, rows in enumerate([[("A", ["x"], 1)], [("a ", ["y"], 2), ("b", ["y"], 3)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = ingest.stream_files(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
        ingest.merge_available(stream, str(tmp_path / "state"), str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.text, r.sources) for r in spark.read.parquet(str(tmp_path / "state/v=1")).collect()) == [("A", ["x", "y"]), ("b", ["y"])]
    spark.sql("SELECT timestamp_ntz'2020-01-01 00:30:00' AS ts, 'k' AS kind").write.mode("append").parquet(str(tmp_path / "ev"))
    events = spark.readStream.schema("ts timestamp_ntz, kind string").parquet(str(tmp_path / "ev"))
    query = ingest.windowed_counts(events, "ts", "kind").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("w").first().n_rows == 1


def corpus_at(spark, path, *texts):
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(str(path))
    return str(path)


def test_a_failed_publication_keeps_the_old_corpus(spark, tmp_path, monkeypatch):
    rows = lambda *t: spark.createDataFrame([(x,) for x in t], "text string")
    target = str(tmp_path / "out")
    writers.publish_directory(rows("old"), target, "card", "a")
    rename, calls = writers._rename, []

    def second_fails(fs, source, to):
        calls.append(str(to))
        if len(calls) == 2:
            raise OSError("no")
        rename(fs, source, to)

    monkeypatch.setattr(writers, "_rename", second_fails)
    with pytest.raises(OSError):
        writers.publish_directory(rows("new"), target, "card", "b")
    assert [r.text for r in spark.read.parquet(f"{target}/data").collect()] == ["old"] and len(calls) == 3
    monkeypatch.setattr(writers, "_rename", rename)
    writers.publish_directory(rows("new"), target, "card", "c")
    assert [r.text for r in spark.read.parquet(f"{target}/data").collect()] == ["new"] and not list(tmp_path.glob("out._old*"))


def test_ingesting_some_sources_leaves_the_others(spark, tmp_path):
    sources = [{"name": n, "path": corpus_at(spark, tmp_path / n, f"dafa nga {n} ñu man")} for n in ("one", "two")]
    (tmp_path / "c.yaml").write_text(json.dumps({"work_dir": str(tmp_path / "w"), "target": "wol", "publish_dir": str(tmp_path / "out"), "sources": sources, "gates": {"min_examples": 1, "min_text_mb": 0.0}}))
    pipeline = Pipeline(spark, load_config(str(tmp_path / "c.yaml")))
    names = lambda: sorted(r.source for r in pipeline.read("ingested").collect())
    pipeline.ingest(only=["two"])
    assert names() == ["two"]
    pipeline.ingest(skip_existing=True)
    assert names() == ["one", "two"] and pipeline.ingest(skip_existing=True) is None
    assert json.loads((tmp_path / "w/ingest_report.json").read_text()) == {"one/kept": 1, "two/kept": 1}
    with pytest.raises(ValueError):
        pipeline.ingest(only=["three"])
    assert pipeline.run("all", publish=True, dry_run=True, skip_existing=True) and not (tmp_path / "out").exists()
    csv = spark.read.option("header", True).csv(str(tmp_path / "w/stats_by_source.csv"))
    assert {(r.source, r.examples, r.top_lang) for r in csv.collect()} == {("one", "1", "wol"), ("two", "1", "wol")}


def test_the_first_text_of_a_baseline_key_stays(spark, tmp_path, monkeypatch):
    base = spark.createDataFrame([("Zz top", ["b"]), ("zz TOP", ["c"]), ("aa", ["b"])], "text string, sources array<string>")
    base.coalesce(1).write.parquet(str(tmp_path / "base"))
    (tmp_path / "c.json").write_text(json.dumps({"work_dir": str(tmp_path / "w"), "sources": []}))
    monkeypatch.setenv("LOOMTEXT_BASELINE", str(tmp_path / "base"))
    pipeline = Pipeline(spark, load_config(str(tmp_path / "c.json")))
    spark.createDataFrame([("ZZ TOP", ["n"])], "text string, sources array<string>").write.parquet(pipeline.path("central"))
    assert sorted((r.text, r.sources) for r in pipeline.merge().collect()) == [("Zz top", ["b", "c", "n"]), ("aa", ["b"])]
    assert pipeline.read("baseline").count() == 3


def test_small_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("v1", "a", "x"), ("v2", "b", "y")], "video_id string, text string, category string")
    writers.write_per_video(rows, str(tmp_path / "v"))
    assert sorted(p.name for p in (tmp_path / "v/videos").glob("video=*")) == ["video=v1", "video=v2"] and spark.read.json(str(tmp_path / "v/videos")).count() == spark.read.json(str(tmp_path / "v/summary")).count() == 2
    writers.write_by_category(rows, "category", str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "c/by_category")).where("category = 'y'").first().text == "b" and spark.read.parquet(str(tmp_path / "c/all")).count() == 2
    writers.write_train_test(rows.withColumn("split", F.lit("train")), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t/split=train")).count() == 2
    videos = spark.createDataFrame([(1, "t", [("v1", "w1"), ("v2", "w2")]), (2, "u", [])], "id int, title string, videos array<struct<video_id:string,watch_url:string>>")
    writers.write_video_list(videos, "id", "title", str(tmp_path / "l"))
    assert spark.read.option("header", True).csv(str(tmp_path / "l")).count() == 2
    (tmp_path / "p/news").mkdir(parents=True)
    (tmp_path / "p/news/a.html").write_text("<p>Some words of a page</p>")
    page = readers.read_pages(spark, str(tmp_path / "p")).first()
    assert page.category == "news" and page.url.endswith("/news/a.html") and "<p>" in page.html


def test_first_seen_and_state_of_another_query(spark, tmp_path):
    spark.sql("SELECT timestamp_ntz'2020-01-01 00:30:00' AS ts, x AS text FROM VALUES ('a'), ('A '), ('b') AS t(x)").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp_ntz, text string").parquet(str(tmp_path / "ev"))
    ingest.first_seen(stream, "ts").writeStream.format("memory").queryName("f").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("f").count() == 2
    schema = "text string, sources array<string>, ord long"
    for k in range(2):
        spark.createDataFrame([(f"t{k}", ["x"], 1)], schema).write.parquet(str(tmp_path / f"in{k}"))
        stream = ingest.stream_files(spark, str(tmp_path / f"in{k}"), spark.createDataFrame([], schema).schema)
        ingest.merge_available(stream, str(tmp_path / "state"), str(tmp_path / f"cp{k}")).awaitTermination()
    assert sorted(r.text for r in spark.read.parquet(str(tmp_path / "state/v=1")).collect()) == ["t0", "t1"]
