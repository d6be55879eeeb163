"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame operations only.

Targets: sources share the mix by weight; none takes more than ``most`` times its size, and
what that frees goes to the others by weight. Slot i of the schedule has the point
frac((i + 1) * golden ratio); the point's place in the cumulative targets names the source,
and the slot's rank in its source names a block: documents of a source lie in shuffled order
on a line of words that is cut into blocks of equal words and read again from its start when
it ends. A source's last block is cut at its target; slots that the sequence lacks
are appended, those beyond a target are left out, so every target is met to the word.

No source is gathered in one task: positions on the line and ranks of slots come from
running sums inside pieces of bounded size plus running sums over the pieces.

Defined results: null or empty texts have size 0 and are never taken; a null source is a
source of its own, last in order; rows that repeat lie on the line each for itself; sources
without words have target 0; an empty table gives an empty mix.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from qualia.llm.shared import plain_names, staged

WEIGHTS = (5, 2, 1)
#: Words in a block, rows in a piece of a source's line, slots in a piece of the schedule.
BLOCK_WORDS = 1024
PIECE_ROWS = 2048
PIECE_SLOTS = 1 << 16
GOLDEN = (math.sqrt(5) - 1) / 2
#: The fractional part of 2**20 times the golden ratio.
FAR_GOLDEN = float((Decimal(5).sqrt() - 1) / 2 * 2**20 % 1)


def size_in_words(text: str = "text") -> Column:
    """Runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: tuple[int, int], most: int, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target, lo: targets of the sources before) of (source, source_size).

    Sources in order of the level at which they are full (most * size / weight): a source is
    full if the level reached by all that are fuller than it is not above. Two running sums.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("weight", cycle).withColumn("cap", F.col("source_size") * most)
    by_level = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, W.unboundedFollowing)
    s = s.withColumns({"total": F.sum("source_size").over(W.partitionBy()) * F.lit(share[0]) / F.lit(share[1]),
                       "full": F.coalesce(F.sum("cap").over(before), F.lit(0)), "open": F.sum("weight").over(after)})
    # the level if this source and all later ones are not full; the first such source fixes it
    s = s.withColumn("level", F.when((F.col("total") - F.col("full")) / F.col("open") <= F.col("cap") / F.col("weight"), (F.col("total") - F.col("full")) / F.col("open")))
    s = s.withColumn("level", F.max("level").over(W.partitionBy()))  # later ones count sources as full that are not, so theirs are lower
    s = s.withColumn("target", F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))))
    return s.select("source", "source_size", "weight", "target", F.coalesce(F.sum("target").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("lo"),
                    F.sum("target").over(W.partitionBy()).alias("all_targets"))


def line(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` (with source, size) and ``start``: words before the row in its source's shuffled order."""
    # pieces are ranges of the hash: the order on the line is that of the hashes, whatever the pieces
    piece_of = F.expr(f"shiftright(cast(conv(substring(_h, 1, 8), 16, 10) as long) * (_n div {PIECE_ROWS} + 1), 32)")
    n = rows.groupBy("source").agg(F.count("*").alias("_n"))
    rows = rows.withColumn("_h", F.md5(F.concat_ws("/", F.lit("line"), *[F.col(k).cast("string") for k in key]))).join(n.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).withColumn("_p", piece_of).drop("_s", "_n")
    inside = W.partitionBy("source", "_p").orderBy("_h", *key, "size").rowsBetween(W.unboundedPreceding, -1)
    pieces = rows.groupBy("source", "_p").agg(F.sum("size").alias("_w"))
    over = W.partitionBy("source").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.select(F.col("source").alias("_s"), F.col("_p").alias("_q"), F.coalesce(F.sum("_w").over(over), F.lit(0)).alias("_before"))
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(pieces, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_q")))
    return rows.withColumn("start", F.col("_before") + F.col("_in")).drop("_h", "_p", "_s", "_q", "_before", "_in")


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """(slot, source, rank, words): the blocks of the mix in order; ``words`` is less in a source's last block."""
    spark = goals.sparkSession
    goals = goals.where("target >= 0.5").withColumns({"words_wanted": F.round("target").cast("long"), "hi": F.col("lo") + F.col("target")})
    goals = goals.withColumn("n_slots", F.expr(f"(words_wanted + {block} - 1) div {block}"))
    n = goals.agg(F.sum("n_slots")).first()[0] or 0
    # frac(i * golden) in two parts, so that large i keep their low digits
    far = f"((id + 1) div {1 << 20}) * {FAR_GOLDEN!r}D"
    slots = spark.range(n).withColumn("x", F.expr(f"{far} - floor({far}) + ((id + 1) % {1 << 20}) * {GOLDEN!r}D")).withColumn("x", F.expr("x - floor(x)"))
    # equal cells of the unit interval, each with the sources that reach into it: an equi-join finds a point's source
    cells = 1 << 12
    g = goals.selectExpr("source", "words_wanted", "lo / all_targets a", "hi / all_targets b",
                         f"explode(sequence(cast(floor(lo / all_targets * {cells}) as long), cast(floor(hi / all_targets * {cells}) as long))) cell")
    slots = slots.withColumn("cell", F.expr(f"cast(floor(x * {cells}) as long)")).join(g, "cell").where("x >= a and x < b").select("id", "source", "words_wanted")
    slots = slots.withColumn("_p", F.expr(f"id div {PIECE_SLOTS}"))
    inside = W.partitionBy("_p", "source").orderBy("id")
    per = slots.groupBy("source", "_p").agg(F.count("*").alias("_c"))
    over = W.partitionBy("source").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("_s"), F.col("_p").alias("_q"), F.coalesce(F.sum("_c").over(over), F.lit(0)).alias("_before"))
    ranked = slots.withColumn("_r", F.row_number().over(inside) - 1).join(per, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_p") == F.col("_q")))
    ranked = ranked.select(F.col("id").alias("slot"), "source", (F.col("_before") + F.col("_r")).alias("rank"), "words_wanted").where(f"rank * {block} < words_wanted")
    had = ranked.groupBy("source").agg(F.count("*").alias("_had")).withColumnRenamed("source", "_s")
    lacking = goals.join(had, F.col("source").eqNullSafe(F.col("_s")), "left").selectExpr("source", "words_wanted", "n_slots", "coalesce(_had, 0L) had").where("had < n_slots")
    lacking = lacking.selectExpr("source", "words_wanted", "explode(sequence(had, n_slots - 1)) rank").selectExpr(f"{n}L + rank slot", "source", "rank", "words_wanted")
    return ranked.union(lacking).selectExpr("slot", "source", "rank", f"least({block}L, words_wanted - rank * {block}) words")


def mix(docs: DataFrame, *, key: list[str], source: str = "source", text: str = "text", share: tuple[int, int] = (150, 100), most: int = 2,
        weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, goals, pieces).

    rows: key columns, source, size, start on the source's line. goals: each source's size and
    target. pieces: (slot, source, start, size, epoch, from_word, to_word) and the key, the words of
    a document that a slot of the schedule takes, epoch counting the readings of the line.
    """
    rows = staged(docs.select(*key, F.col(source).alias("source"), size_in_words(text).alias("size")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = staged(targets(sizes, share, most, weights), "mix-goals")
    placed = staged(line(rows, key), "mix-line")
    plan = schedule(goals, block_words)
    g = goals.select(F.col("source").alias("_s"), "source_size", "target")
    lies = placed.where("size > 0").join(g, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    lies = lies.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("at", F.expr("start + epoch * source_size")).where("at < target")
    cut = lies.withColumn("block", F.explode(F.expr(f"sequence(at div {block_words}, (at + size - 1) div {block_words})")))
    p = plan.select("slot", F.col("source").alias("_s"), F.col("rank").alias("_r"), "words")
    both = cut.join(p, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_r")))
    pieces = both.select(*key, "slot", "source", "start", "size", "epoch", F.expr(f"greatest(block * {block_words} - at, 0L)").alias("from_word"),
                         F.expr(f"least(block * {block_words} + words - at, size)").alias("to_word")).where("from_word < to_word")
    return placed, goals, pieces


def taken(docs: DataFrame, *, key: list[str], **options) -> DataFrame:
    """Each row's key, source, size, source_size, target and taken words."""
    rows, goals, pieces = mix(docs, key=key, **options)
    got = pieces.groupBy(F.col("source").alias("_s"), F.col("start").alias("_a")).agg(F.sum(F.expr("to_word - from_word")).alias("_t"))
    g = goals.select(F.col("source").alias("_g"), "source_size", "target")
    out = rows.join(got, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_a")) & (F.col("size") > 0), "left")
    return out.join(g, F.col("source").eqNullSafe(F.col("_g"))).select(*key, "source", "size", "source_size", "target", F.coalesce("_t", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, *, key: list[str], source: str = "source", text: str = "text", **options) -> DataFrame:
    """``docs`` as the mix reads them: a row for each reading that takes at least half of its words; same columns."""
    plain, name = plain_names(docs)
    return _mixed(plain, key=[name[k] for k in key], source=name[source], text=name[text], **options).toDF(*docs.columns)


def _mixed(docs: DataFrame, *, key: list[str], **options) -> DataFrame:
    rows, _, pieces = mix(docs, key=key, **options)
    got = pieces.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(key)], "source", "start", "size", "epoch").agg(F.sum(F.expr("to_word - from_word")).alias("t"))
    got = got.where("2 * t >= size")
    # rows that share a key share their readings in order, so that none is read for another
    n = got.groupBy(*[f"_{i}" for i in range(len(key))]).agg(F.count("*").alias("_times"))
    same = W.partitionBy(*key).orderBy(F.xxhash64(*docs.columns))
    if docs.select(*key).distinct().count() == docs.count():
        numbered = docs.withColumns({"_k": F.lit(1), "_of": F.lit(1)})
    else:
        numbered = docs.withColumns({"_k": F.row_number().over(same), "_of": F.count("*").over(W.partitionBy(*key))})
    match = F.lit(True)
    for i, k in enumerate(key):
        match = match & F.col(k).eqNullSafe(F.col(f"_{i}"))
    out = numbered.join(n, match).withColumn("_n", F.expr("_times div _of + if(_k <= _times % _of, 1, 0)")).where("_n > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*docs.columns)
