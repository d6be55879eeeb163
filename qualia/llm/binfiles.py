"""Binary files of framed records, written and read by Spark's own writers and readers.

A record is a binary value; the text writer puts the bytes of a binary value that is cast to
string into its file unchanged, each followed by ``end``. Files are read back whole, so
their size must be bounded by the caller's partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_records(df: DataFrame, column: str, path: str, end: str = "\n", most: int = 0, compression: str = "none") -> None:
    """``most``: records of a file, if over 0."""
    out = df.select(F.col(column).cast("string").alias("value")).write.option("lineSep", end).option("compression", compression)
    out.option("maxRecordsPerFile", most).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(file_no: the writer's partition, content)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file_no"), "content")
