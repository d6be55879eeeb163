"""Exact token counts: one histogram of encoded lengths answers every context limit.

Documents become lengths in their tasks, lengths become a histogram by one pre-aggregated
group-by, and running sums over it from either end give totals, quantiles and
truncated totals for any limit. The running sums are formed in ranges of lengths and then
over the ranges, so no task gathers all lengths.

Defined results: a null or empty text has length 0; repeated documents count each; an
empty table gives an empty histogram, totals of 0 and null quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from qualia.llm.shared import ship, staged

#: Lengths in a range of the two-step running sums.
RANGE = 4096


def _counter(path: str, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from qualia.llm.tokens import encoder

        e = encoder(path)
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for lo, hi, _, first in e.encode(batch.column(at)):
                n[lo:hi] = np.diff(first)
            others = [c for k, c in enumerate(batch.columns) if k != at]
            names = [c for k, c in enumerate(batch.schema.names) if k != at]
            yield pa.RecordBatch.from_arrays([*others, pa.array(n)], [*names, "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """The other columns of ``docs`` and ``n_tokens``, by the tokenizer file at that path."""
    ship(docs.sparkSession)
    docs = docs.drop("n_tokens")  # a column so named is replaced
    at = docs.columns.index(text_col)
    fields = [f for f in docs.schema.fields if f.name != text_col]
    return docs.mapInArrow(_counter(tokenizer, at), T.StructType([*fields, T.StructField("n_tokens", T.LongType())]))


def histogram(counts: DataFrame) -> DataFrame:
    """(length, docs, tokens) of a table with ``n_tokens``."""
    return counts.groupBy(F.col("n_tokens").alias("length")).agg(F.count("*").alias("docs")).withColumn("tokens", F.col("length") * F.col("docs"))


def running(hist: DataFrame) -> DataFrame:
    """The histogram with documents and tokens up to each length and from longer ones (suffix sums)."""
    hist = staged(hist, "histogram").withColumn("range", F.expr(f"length div {RANGE}"))  # read twice, made once
    up = W.partitionBy("range").orderBy("length").rowsBetween(W.unboundedPreceding, 0)
    over = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = hist.groupBy("range").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    ranges = ranges.select("range", F.coalesce(F.sum("d").over(over), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(over), F.lit(0)).alias("t0"),
                           F.sum("d").over(W.partitionBy()).alias("all_docs"), F.sum("t").over(W.partitionBy()).alias("all_tokens"))
    out = hist.withColumns({"d": F.sum("docs").over(up), "t": F.sum("tokens").over(up)}).join(ranges, "range")
    return out.select("length", "docs", "tokens", (F.col("d0") + F.col("d")).alias("docs_up_to"), (F.col("t0") + F.col("t")).alias("tokens_up_to"),
                      "all_docs", "all_tokens").withColumns({
                          "docs_longer": F.expr("all_docs - docs_up_to"), "tokens_longer": F.expr("all_tokens - tokens_up_to")})


def at_every_limit(hist: DataFrame) -> DataFrame:
    """For every length that occurs, taken as context limit: tokens kept and cut when longer texts are
    truncated there, documents cut, windows of that size needed, and the share of documents that fit."""
    return running(hist).select(
        F.col("length").alias("context_limit"), "docs", "docs_up_to", "docs_longer", "tokens_up_to",
        F.expr("tokens_up_to + docs_longer * length").alias("tokens_kept"),
        F.expr("tokens_longer - docs_longer * length").alias("tokens_cut"),
        F.expr("docs_up_to / all_docs").alias("share_whole"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that this share of the documents does not exceed."""
    r = running(hist)
    out = r.agg(*[F.min(F.when(F.col("docs_up_to") >= F.lit(q) * F.col("all_docs"), F.col("length"))).alias(f"q{k}") for k, q in enumerate(shares)])
    return out.select(F.explode(F.array(*[F.struct(F.lit(q).alias("share"), F.col(f"q{k}").alias("length")) for k, q in enumerate(shares)])).alias("x")).select("x.*")
