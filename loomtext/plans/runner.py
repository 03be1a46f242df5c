"""Orchestration: ingest, centralise, merge, statistics, card, validation and publication, from one configuration."""

from __future__ import annotations

import argparse
import json
import os
import sys
import uuid
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.functions.language import heuristic
from loomtext.functions.text import known_sources
from loomtext.operators.filters import ingest_reasons, reason_counts
from loomtext.operators.merge import bag_union, corpus_union_merge, provenance_merge
from loomtext.operators.setops import sample
from loomtext.operators.stats import corpus_totals, language_share, sources_with_language, stats_by_source
from loomtext.plans.datacard import build_card
from loomtext.plans.gates import GateConfig, GateReport, run_gates
from loomtext.sources.readers import SourceSpec, read_or_none, read_source
from loomtext.sources.writers import publish_directory, read_text, write_csv, write_json, write_parquet, write_text


@dataclass
class Config:
    """Everything a run needs; ``from_dict`` takes the sections of a YAML or JSON file."""

    work_dir: str = "work"
    target: str = "target"
    threshold: float = 0.5
    min_tokens: int = 3
    sample_size: int = 30_000
    baseline: str | None = None
    publish_dir: str | None = None
    sources: list[SourceSpec] = field(default_factory=list)
    gates: GateConfig = field(default_factory=GateConfig)

    @staticmethod
    def from_dict(data: dict) -> Config:
        data = dict(data)
        data["sources"] = [SourceSpec(**s) for s in data.get("sources", [])]
        data["gates"] = GateConfig(**data.get("gates", {}))
        return Config(**data)


def load_config(path: str) -> Config:
    """A JSON file, or YAML where a YAML reader is installed. LOOMTEXT_BASELINE in the environment wins over the file."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        config = Config.from_dict(yaml.safe_load(text))
    else:
        config = Config.from_dict(json.loads(text))
    config.baseline = os.environ.get("LOOMTEXT_BASELINE", config.baseline)
    return config


def load_stats(spark: SparkSession, path: str) -> dict | None:
    """A statistics report, or None where there is none."""
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def file_order() -> Column:
    """Where a row stands in the files that it was read from."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


class Pipeline:
    """Stages over files of one work folder. Each is a function of what earlier ones wrote."""

    ORDER = ("ingest", "centralise", "merge", "stats", "card", "validate")

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config

    def path(self, name: str) -> str:
        return f"{self.config.work_dir.rstrip('/')}/{name}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def ingest(self, only: list[str] | None = None, skip_existing: bool = False) -> DataFrame | None:
        """Sources as one table of candidates with reasons; the kept ones are written by source.

        ``only`` names the sources to take, and ``skip_existing`` leaves out those that were ingested before; what other
        sources have written stays. None if nothing is left to do.
        """
        c = self.config
        specs = [s for s in c.sources if only is None or s.name in only]
        if only is not None and not specs:
            raise ValueError(f"no source of the configuration is one of {only}")
        report = (load_stats(self.spark, self.path("ingest_report.json")) or {}) if only is not None or skip_existing else {}
        if skip_existing:
            done = read_or_none(self.spark, self.path("ingested"))
            known = set() if done is None else {r["source"] for r in done.select("source").distinct().collect()}
            specs = [s for s in specs if s.name not in known]
        if not specs:
            return None
        parts = [read_source(self.spark, s).withColumn("_min", F.lit(c.min_tokens if s.min_tokens is None else s.min_tokens)).withColumn("_lid", F.lit(s.lid)) for s in specs]
        #: written first, so that the numbers stay the same in all that follows
        write_parquet(bag_union(parts).withColumn("ord", F.monotonically_increasing_id()), self.path("raw"))
        rows = self.read("raw")
        seen = heuristic(F.col("text"))
        label = F.when(seen["is_target"], c.target).otherwise("other")
        marked = ingest_reasons(rows, label, F.when(seen["is_target"], F.lit(1.0)).otherwise(F.lit(0.0)), c.target, F.col("ord"), F.col("_min"), c.threshold, F.col("_lid"))
        write_parquet(marked, self.path("candidates"))
        marked = self.read("candidates")
        kept = marked.where("reason = 'kept'").select("text", F.array("source").alias("sources"), "source", "ord")
        mode = "dynamic" if len(specs) < len(c.sources) else "static"
        kept.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("source").parquet(self.path("ingested"))
        report = {k: v for k, v in report.items() if k.rpartition("/")[0] not in {s.name for s in specs}}
        report |= {f"{r['source']}/{r['reason']}": r["n_rows"] for r in reason_counts(marked, "source").collect()}
        write_json(report, self.path("ingest_report.json"), self.spark)
        return marked

    def centralise(self) -> DataFrame:
        rows = self.read("ingested")
        write_parquet(provenance_merge(rows, F.col("ord")), self.path("central"))
        return self.read("central")

    def merge(self) -> DataFrame:
        """Baseline first, then what was ingested. A baseline that is configured but can't be read is an error.

        The baseline is copied to the work folder first, so the merge and a later look at it see one state.
        """
        corpora = [self.read("central").withColumn("ord", file_order())]
        if self.config.baseline:
            write_parquet(self.spark.read.parquet(self.config.baseline), self.path("baseline"))
            corpora.insert(0, self.read("baseline").withColumn("ord", file_order()))
        write_parquet(corpus_union_merge(corpora), self.path("unified"))
        return self.read("unified")

    def stats(self) -> dict:
        rows = self.read("unified")
        drawn = sample(rows.withColumn("key", F.xxhash64("text")), "key", self.config.sample_size)
        seen = heuristic(F.col("text"))
        lid = language_share(drawn.select(F.when(seen["is_target"], self.config.target).otherwise("other").alias("lang"), seen["confidence"].alias("conf")), "lang", "conf", self.config.target).first()
        report = corpus_totals(rows).first().asDict()
        by_source = stats_by_source(rows)
        report["by_source"] = {r["source"]: r.asDict() for r in by_source.collect()}
        report["lid"] = lid.asDict() if lid else None
        write_json(report, self.path("stats.json"), self.spark)
        marked = drawn.select("sources", F.when(seen["is_target"], self.config.target).otherwise("other").alias("lang"), seen["confidence"].alias("conf"))
        each = marked.select(F.explode(known_sources(F.col("sources"))).alias("source"), "lang", "conf")
        languages = language_share(each, "lang", "conf", self.config.target, "source").select("source", "target_pct", "top_lang")
        write_csv(sources_with_language(by_source, languages).orderBy(F.desc("examples"), "source").coalesce(1), self.path("stats_by_source.csv"))
        return report

    def card(self) -> str:
        text = build_card(self.read("unified"), load_stats(self.spark, self.path("stats.json")))
        write_text(self.spark, text, self.path("README.md"))
        return text

    def validate(self) -> GateReport:
        baseline = read_or_none(self.spark, self.config.baseline) if self.config.baseline else None
        report = run_gates(self.read("unified"), self.config.gates, load_stats(self.spark, self.path("stats.json")), baseline)
        write_json(report.to_dict(), self.path("gate_report.json"), self.spark)
        return report

    def publish(self, dry_run: bool = False) -> bool:
        """Writes the corpus and its card to the publication folder, only if every gate passes. False if refused."""
        if not self.validate().all_passed or not self.config.publish_dir:
            return False
        if not dry_run:
            publish_directory(self.read("unified"), self.config.publish_dir, self.card(), uuid.uuid4().hex)
        return True

    def run(self, stage: str, publish: bool = False, dry_run: bool = False, **ingest) -> bool:
        """One stage or ``all``, which publishes last if ``publish`` says so; False if a gate failed or publishing was refused."""
        names = self.ORDER + ("publish",) * publish if stage == "all" else (stage,)
        given = {"ingest": ingest, "publish": {"dry_run": dry_run}}
        results = [getattr(self, name)(**given.get(name, {})) for name in names]
        return all(r.all_passed for r in results if isinstance(r, GateReport)) and results[-1] is not False


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Corpus pipeline")
    parser.add_argument("stage", choices=[*Pipeline.ORDER, "all", "publish"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--only", nargs="+", help="sources to ingest")
    parser.add_argument("--skip-existing", action="store_true", help="leave out sources that were ingested before")
    parser.add_argument("--publish", action="store_true", help="with all: publish at the end")
    parser.add_argument("--dry-run", action="store_true", help="check the gates of a publication, and write nothing")
    given = parser.parse_args(args)
    spark = SparkSession.builder.appName("loomtext").getOrCreate()
    pipeline = Pipeline(spark, load_config(given.config))
    return 0 if pipeline.run(given.stage, given.publish, given.dry_run, only=given.only, skip_existing=given.skip_existing) else 1


if __name__ == "__main__":
    sys.exit(main())
