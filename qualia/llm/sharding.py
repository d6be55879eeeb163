"""Shards by proportional stratified interleaving.

Rows of each source are shuffled by a seeded digest and ranked; a row's fraction is
(rank + offset of its source) / rows of its source. Offsets are golden-ratio points along the sources by
size, so that many sources of one row spread evenly instead of meeting in the middle. All rows
sorted by fraction are cut into stretches of equal row counts, so each shard has of each source
its share, give or take a few rows.

Both sorts are range shuffles (ranks.py): no source, however large, passes through one task.

Defined results: null texts and ids are rows like others; a null source is a source of its own, before
the others; equal rows are placed each; with fewer rows than shards some shards are empty; an
empty table gives no rows. Other columns of any name are kept; one that is called like those added is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.llm.ranks import in_order, with_position, with_rank
from qualia.llm.shared import plain_names

SHARDS = 16
GOLDEN = 0.6180339887498949


def source_code(source: Column) -> Column:
    """A text for each source, null among them."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source.cast("string")))


def interleave(df: DataFrame, key: list[str], *, source_col: str = "source", shards: int = SHARDS, seed: str = "shard", names: tuple[str, str] = ("shard", "slot")) -> DataFrame:
    """``df`` with the shard (int, from 0) and slot (long, gapless from 0 in each shard) of each row.

    key: the columns that tell rows apart; the seeded digest is of their texts. Rows with equal keys stand side by side in
    the shuffle, in the order in which they are read.
    """
    df = df.drop(*names)
    plain, name = plain_names(df)
    keys = [F.coalesce(F.col(name[k]).cast("string"), F.lit("")) for k in key]
    rows = plain.withColumns({"_source": source_code(F.col(name[source_col])), "_digest": F.md5(F.concat_ws("/", F.lit(seed), *keys)),
                              "_read": F.monotonically_increasing_id()})
    rows = in_order(rows, [F.col(c) for c in ("_source", "_digest", "_read")], "shard-ranks")
    sources = rows.groupBy("_source").agg(F.count("*").alias("_n"))
    sources = with_position(in_order(sources, [F.col("_n"), F.col("_source")], "shard-sources"), "_k", "_all")
    sources = sources.select("_source", F.expr(f"_k * {GOLDEN}D - floor(_k * {GOLDEN}D)").alias("_offset"))
    rows = with_rank(rows, "_source", "_rank", "_rows", sources)
    rows = rows.withColumn("_fraction", (F.col("_rank") + F.col("_offset")) / F.col("_rows")).drop("_digest", "_read", "_rows", "_offset")
    rows = with_position(in_order(rows, [F.col(c) for c in ("_fraction", "_source", "_rank")], "shard-order"), "_position", "_total")
    rows = rows.withColumn("_shard", F.expr(f"_position * {shards} div _total"))
    rows = rows.withColumn("_slot", F.expr(f"_position - (_shard * _total + {shards - 1}) div {shards}"))
    own = [F.col(name[c]).alias(c) for c in df.columns]
    return rows.select(*own, F.col("_shard").cast("int").alias(names[0]), F.col("_slot").alias(names[1]))


def write_shards(sharded: DataFrame, path: str, *, names: tuple[str, str] = ("shard", "slot")) -> None:
    """A folder for each shard; its files, by name, hold its rows in the order of their slots."""
    rows = sharded.repartitionByRange(*names).sortWithinPartitions(*names)
    rows.write.partitionBy(names[0]).parquet(path)
