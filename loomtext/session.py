"""Session factory shared by the bench, the tests and the command line."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "loomtext", cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session. A cluster sets its own master and sizes; nothing in the operators depends on these."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the input tables, by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()
#: Rows and bytes of one Arrow batch to a Python worker, at most: texts can be long.
BATCH_ROWS, BATCH_BYTES = "4000", "8m"


def ship(spark: SparkSession) -> None:
    """Give executors this package, as a cluster need not have it installed, and bound the batches sent to Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="loomtext-")) / "loomtext_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)
