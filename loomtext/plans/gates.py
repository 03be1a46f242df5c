"""Quality gates: declarative checks of a corpus, computed in one aggregation and one join."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtext.functions.text import digest, key_strip
from loomtext.operators.setops import baseline_loss


@dataclass
class GateConfig:
    min_examples: int = 600_000
    max_empty: int = 0
    max_duplicate_pct: float = 0.0
    min_text_mb: float = 100.0
    min_target_pct: float = 90.0
    require_no_loss: bool = True
    #: a baseline that cannot be read skips the loss gate, or fails it with fail_closed
    fail_closed: bool = False
    columns: tuple[str, ...] = ("text", "sources")


@dataclass
class GateResult:
    name: str
    passed: bool
    expected: str
    actual: str
    detail: str = ""


@dataclass
class GateReport:
    results: list[GateResult] = field(default_factory=list)

    @property
    def all_passed(self) -> bool:
        """True if no gate failed; a report without gates passes."""
        return all(r.passed for r in self.results)

    def to_dict(self) -> dict:
        return {"all_passed": self.all_passed, "gates": [asdict(r) for r in self.results]}

    def render(self) -> str:
        return "\n".join(f"[{'ok' if r.passed else 'FAILED'}] {r.name}: expected {r.expected}, found {r.actual}{f' ({r.detail})' if r.detail else ''}" for r in self.results)


def gate_schema(rows: DataFrame, columns: tuple[str, ...]) -> GateResult:
    """The expected columns are there and sources is an array."""
    missing = [c for c in columns if c not in rows.columns]
    listed = "sources" not in rows.columns or isinstance(rows.schema["sources"].dataType, T.ArrayType)
    return GateResult("schema", not missing and listed, ", ".join(columns), ", ".join(rows.columns), f"missing: {', '.join(missing)}" if missing else "" if listed else "sources is no array")


def measures(rows: DataFrame, text: str = "text") -> DataFrame:
    """One row: n, empty, distinct keys and UTF-8 bytes, by partial sums over the keys."""
    t = F.coalesce(F.col(text), F.lit(""))
    keys = rows.groupBy(digest(key_strip(t)).alias("key"), (key_strip(t) == "").alias("blank")).agg(F.count(F.lit(1)).alias("c"), F.sum(F.octet_length(t).cast("long")).alias("b"))
    return keys.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("blank"), F.col("c"))), F.lit(0)).alias("empty"), F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"))


def run_gates(rows: DataFrame, config: GateConfig, stats: dict | None = None, baseline: DataFrame | None = None) -> GateReport:
    """All gates in order: schema, min_examples, empty_texts, duplicates, raw_text_size, target_lang_pct, no_baseline_loss.

    Percentages are rounded to four digits and sizes to two before they are compared. Without a language report its gate
    fails; without a baseline the loss gate passes as skipped, or fails if the configuration says so.
    """
    report = GateReport([gate_schema(rows, config.columns)])
    if "text" not in rows.columns:
        return report
    m = measures(rows).first()
    pct = round(100.0 * (m["n"] - m["keys"]) / m["n"], 4) if m["n"] else 0.0
    size = round(m["bytes"] / 1e6, 2)
    report.results += [
        GateResult("min_examples", m["n"] >= config.min_examples, f">= {config.min_examples}", str(m["n"])),
        GateResult("empty_texts", m["empty"] <= config.max_empty, f"<= {config.max_empty}", str(m["empty"])),
        GateResult("duplicates", pct <= config.max_duplicate_pct, f"<= {config.max_duplicate_pct} %", f"{pct} %"),
        GateResult("raw_text_size", size >= config.min_text_mb, f">= {config.min_text_mb} MB", f"{size} MB"),
    ]
    share = ((stats or {}).get("lid") or {}).get("target_pct")
    report.results.append(GateResult("target_lang_pct", share is not None and share >= config.min_target_pct, f">= {config.min_target_pct} %", "none" if share is None else f"{share} %"))
    if config.require_no_loss:
        if baseline is None:
            report.results.append(GateResult("no_baseline_loss", not config.fail_closed, "0 missing", "skip", "no baseline"))
        else:
            loss = baseline_loss(baseline, rows).first()
            report.results.append(GateResult("no_baseline_loss", loss["missing"] == 0, "0 missing", f"{loss['missing']} missing", f"{loss['added']} added"))
    return report
