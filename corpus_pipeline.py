"""A training corpus from the given documents: grade, deduplicate, decontaminate, mix, encode.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and
read again as the next one's documents. All but the last give the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm import decontam, mixing, neardup, ordinal, tokenbin
from qualia.llm.queries import read, tokenizer_path
from qualia.llm.shared import fresh_path


def graded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that reach grade 1 with a probability of one half or more."""
    model = ordinal.train(docs, ordinal.rated(read(spark, sf_dir, "labels")), ordinal.label_grade(), ordinal.LEVELS)
    return ordinal.select(docs, model)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.remove_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix reads them: a row for each reading."""
    return mixing.mixed(docs, key=["doc_id"])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The written token files, read back: where each document's ids start, how many, and their checksum."""
    found = tokenbin.encode_and_read_back(docs, tokenizer_path())
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("ordinal_grade", graded),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("source_mix", mixed),
    ("token_files", encoded),
]

#: SQL can express neither the classifier nor the encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
