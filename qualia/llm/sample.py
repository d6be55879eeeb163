"""A bounded, repeatable sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, label: Column, most: int, *, id_col: str = "doc_id", text_col: str = "text",
             allowed: Column | None = None) -> DataFrame:
    """(id, text, label, r: a hash) of at most ``most`` labelled ids, lowest hash first.

    An id with several labels has the largest. Only ids and labels are sorted and broadcast, at most
    ``most`` rows of them, so the texts stay where they are.
    """
    ids = labels.select(F.col(id_col).cast("long").alias("id"), label.alias("label")).where("id is not null and label is not null")
    if allowed is not None:
        ids = ids.where(allowed)
    ids = ids.groupBy("id").agg(F.max("label").alias("label")).withColumn("r", F.xxhash64(F.lit("sample"), "id")).orderBy("r").limit(most)
    d = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.join(F.broadcast(ids), d.doc == ids.id).select("id", "text", "label", "r")
