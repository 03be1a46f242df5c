"""Tables that cut lineage, kept in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset (a local test), a temporary folder that is then set.

    On a cluster it has to be set: executors would not see each other's temporary folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: it has to name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="loomtext-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back.

    Later jobs read the files, so a lost executor costs only its running tasks, and a value such as a generated row
    number stays the same however often the table is read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/loomtext/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(*columns: str) -> Column:
    """128 bits that tell rows apart by these columns; rows that agree in all of them have one key."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
