"""Where intermediate tables go, and how the package reaches the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A session without that setting gets a temporary folder only when its master is
    local, where driver and executors are one process; elsewhere it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="qualia-")


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{stem}-{uuid.uuid4().hex}"


def staged(df: DataFrame, stem: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there, so a lost
    executor costs only the tasks of the later jobs."""
    spark = df.sparkSession
    path = fresh_path(spark, stem)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let the executors import this package (once for each Spark context)."""
    sc = spark.sparkContext
    if getattr(sc, "_qualia_llm_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    folder = tempfile.mkdtemp(prefix="qualia-src-")
    path = os.path.join(folder, f"qualia_llm_{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for base, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.join("qualia", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._qualia_llm_shipped = True


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns col_0, col_1, ... and the new name of each, so that a function that gives
    the same columns back can add its own whatever the table's are called."""
    names = {c: f"col_{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names
