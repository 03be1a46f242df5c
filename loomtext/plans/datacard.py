"""Data card of a published corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.operators.stats import corpus_totals, stats_by_source

SIZES = ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"))


def size_name(n: int) -> str:
    """The size bucket; the last one is open."""
    return next((name for limit, name in SIZES if n < limit), "10M<n<100M")


def build_card(rows: DataFrame, stats: dict | None = None, title: str = "Text corpus", language: str = "und", licence: str = "cc-by-4.0", download_bytes: int | None = None) -> str:
    """Markdown with front matter, overview, schema and a table of sources by examples.

    Sizes are sums of UTF-8 bytes of text. A report whose lid part is null leaves the language share out.
    """
    totals = corpus_totals(rows).first()
    n, size = totals["examples"], totals["bytes"]
    share = ((stats or {}).get("lid") or {}).get("target_pct")
    front = [
        "---", "dataset_info:", "  features:", "  - name: text", "    dtype: string", "  - name: sources", "    list: string", "  splits:", "  - name: train",
        f"    num_bytes: {size}", f"    num_examples: {n}", f"  download_size: {download_bytes if download_bytes is not None else size}", f"  dataset_size: {size}",
        "language:", f"- {language}", f"license: {licence}", "size_categories:", f"- {size_name(n)}", "---",
    ]
    body = ["", f"# {title}", "", f"- Examples: {n:,}", f"- Tokens: {totals['tokens']:,}", f"- Text: {size / 1e6:.1f} MB"]
    if share is not None:
        body.append(f"- Target language: {share}%")
    body += ["", "| column | type |", "|---|---|", "| `text` | string |", "| `sources` | list of strings |", "", "| source | examples | tokens |", "|---|---:|---:|"]
    by_source = (stats or {}).get("by_source") or {r["source"]: r.asDict() for r in stats_by_source(rows).orderBy(F.desc("examples"), "source").collect()}
    body += [f"| `{s}` | {d['examples']:,} | {d.get('tokens', 0):,} |" for s, d in sorted(by_source.items(), key=lambda kv: (-kv[1]["examples"], kv[0]))]
    return "\n".join(front + body) + "\n"
