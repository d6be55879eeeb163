"""Exact positions in a total order without one task that sees all rows.

Rows are dealt by ranges of the order and numbered inside their partition; a row count for each
partition (and group) then shifts the numbers. Only those counts meet in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from qualia.llm.shared import staged

_INDEX = (1 << 33) - 1  # monotonically_increasing_id: the partition above these bits, the row below


def in_order(df: DataFrame, order: list[Column], stem: str) -> DataFrame:
    """``df`` written in order, with _part (rises with the order) and _at (row of the part, from 0).

    Rows that tie in all of ``order`` land in one partition: end it with a column that differs.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumns({"_part": F.shiftright("_row", 33), "_at": F.col("_row").bitwiseAND(_INDEX)})
    return staged(rows.drop("_row"), stem)


def with_rank(rows: DataFrame, group: str, rank: str, size: str, also: DataFrame | None = None) -> DataFrame:
    """Adds the rank of each row in its group, from 0, and the group's size; rows: of in_order, by group first.
    also: a row for each group, whose other columns are added."""
    part = rows.groupBy("_part", group).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = W.partitionBy(group)  # one row for each partition that holds rows of the group
    part = part.select("_part", group, "_first", F.sum("_n").over(own).alias(size),
                       F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    if also is not None:
        part = part.join(also, group)
    out = rows.join(part, ["_part", group])
    return out.withColumn(rank, F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def with_position(rows: DataFrame, position: str, total: str) -> DataFrame:
    """Adds the position of each row of in_order in the whole table, from 0, and the row count."""
    every = W.orderBy("_part")  # one row for each partition
    part = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    part = part.select("_part", F.coalesce(F.sum("_n").over(every.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                       F.sum("_n").over(every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias(total))
    return rows.join(part, "_part").withColumn(position, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
