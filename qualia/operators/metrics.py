"""The two aggregates behind every rule.

*Row-level checks* of a table, under any number of row filters, are counted in one
scan: ``count_if(filter)`` per filter and ``count_if(CASE WHEN filter THEN pass END)`` per rule.
A predicate that may raise an error on some row (a division, an ANSI cast) is evaluated under a
guard that gives NULL instead, and those rows are counted beside the passing ones, so one
faulty rule neither ends the scan nor needs another. Aggregate checks add their own aggregates to it.
The plan is scan -> (pushed-down OR of the filters) -> partial hash aggregate ->
one-row final aggregate; no data shuffle, only one partial row per task.

*Uniqueness* needs the frequency of each value. The uniqueness checks of a table
go into one ``GROUPING SETS`` query: Expand (one copy of a row per checked column)
-> partial count per value -> shuffle by value -> final count -> a second,
one-row aggregate that turns the frequencies into (values seen once, non-NULL
rows). A filter is applied per check as ``CASE WHEN filter THEN column END``:
rows outside the filter become NULL, and NULLs are left out of uniqueness anyway;
rows that give no value to any check are dropped at the scan.

How many checks go into one query is the caller's choice (``aggs_per_scan`` and
``unique_per_query`` of :func:`qualia.plans.engine.evaluate_rules`).

Long texts are never shuffled: a text or binary value of 32 bytes or more is grouped
by its SHA-256 digest (32 bytes), a shorter one by its bytes, so the two never meet.
Text of another collation than UTF8_BINARY is grouped as it is.

*Keys that lie close together* (whole numbers, dates) need no row for each value: stretches
of 32,768 values become bitmaps, made by each task for the stretches that it meets and merged by OR. A
stretch with as many rows as set bits holds every value once; only the rows of the other stretches are
grouped as above. A first pass over the column's least and largest value in each
task says whether the bitmaps are worth it: their size is known before they are made.

Skew: both aggregates are algebraic (counts), so a hot value is collapsed by the
map-side partial aggregate to one row per task before the shuffle; a value that
holds a third of the table costs the shuffle no more than any other value.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, ByteType, DataType, DateType, IntegerType, LongType, MapType, ShortType, StringType

from qualia.functions.text import col_of
from qualia.operators.checks import AGGREGATE, ROW, Check


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


@dataclass
class RowGroup:
    """One row filter (``None``: whole table) and the checks under it, or pass predicates that cannot raise an error; text: the
    filter as SQL, for aggregate checks."""

    filter: Column | None
    checks: list[Check | Column]
    text: str = ""

    def __post_init__(self):
        self.checks = [Check(ROW, "", "", "", c, fallible=False) if isinstance(c, Column) else c for c in self.checks]


_SECOND, _NONE = "INTERVAL '1' SECOND", "INTERVAL '0' SECOND"


def guarded(predicate: Column, where: Column) -> Column:
    """An interval of one second where the predicate is TRUE, of none where it is not or ``where`` does not hold, NULL where it
    raises an error. (A product with an interval is tried as a whole, whatever is in it. It must stand in a
    branch: a part that several predicates share is computed ahead of them, outside the trial, unless it is conditional.)"""
    return F.when(where, F.try_multiply(F.expr(_SECOND), F.when(predicate, 1).otherwise(0))).otherwise(F.expr(_NONE))


def _always(base: DataFrame, column: str) -> Column:
    """A condition on a column (the first one, if there is none of that name) that always holds, but that Spark cannot tell beforehand."""
    fields = base.schema.fields
    name, t = next(((f.name, f.dataType) for f in fields if f.name.lower() == column.lower()), (fields[0].name, fields[0].dataType))
    c = col_of(name, base.columns)
    if isinstance(t, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) >= 0
    if isinstance(t, (ArrayType, MapType)):
        return F.coalesce(F.size(c), F.lit(0)) >= -1
    return F.hash(c) >= -(1 << 31)


def weight(check: Check) -> int:
    """Aggregates that a check adds to the scan."""
    return len(check.aggregates or ()) if check.kind == AGGREGATE else 1 + check.fallible


def row_metrics(base: DataFrame, groups: list[RowGroup]) -> DataFrame:
    """One-row aggregate: ``__n{g}`` rows under filter g; for check i of it ``__p{g}_{i}`` rows passing and, if it may fail,
    ``__e{g}_{i}`` rows where it raised an error; for an aggregate check its metric ``__v{g}_{i}``. Checks are evaluated only
    where the filter holds. The OR of the filters is applied first so it reaches the scan."""
    if groups and all(g.filter is not None for g in groups):
        base = base.where(_any([g.filter for g in groups]))
    aggs, out, tried = [], [], {}
    for gi, g in enumerate(groups):
        under = (lambda c, f=g.filter: c if f is None else F.when(f, c))
        aggs.append((F.count(F.lit(1)) if g.filter is None else F.count_if(g.filter)).alias(f"__n{gi}"))
        out.append(F.col(f"__n{gi}"))
        for i, c in enumerate(g.checks):
            if c.kind == AGGREGATE:
                own = {name: f"__a{gi}_{i}_{k}" for k, name in enumerate(c.aggregates)}
                aggs += [F.expr(f"{sql} FILTER (WHERE {g.text})" if g.filter is not None else sql).alias(own[name]) for name, sql in c.aggregates.items()]
                metric = c.finish({name: F.col(a) for name, a in own.items()}).cast("double")
                out.append(F.when(F.col(f"__n{gi}") > 0, F.nanvl(metric, F.lit(None).cast("double"))).alias(f"__v{gi}_{i}"))
                continue
            if c.fallible:
                trial = f"__t{gi}_{i}"
                tried[trial] = guarded(c.predicate, _always(base, c.column) if g.filter is None else g.filter)
                aggs.append(F.count_if(F.col(trial) == F.expr(_SECOND)).alias(f"__p{gi}_{i}"))
                aggs.append(F.count_if(F.col(trial).isNull()).alias(f"__e{gi}_{i}"))
                out.append(F.col(f"__e{gi}_{i}"))
            else:
                aggs.append(F.count_if(under(c.predicate)).alias(f"__p{gi}_{i}"))
            out.append(F.col(f"__p{gi}_{i}"))
    return (base.withColumns(tried) if tried else base).agg(*aggs).select(*out)


@dataclass(frozen=True)
class UniqueSpec:
    """Uniqueness of ``column`` among the rows where ``filter`` holds."""

    column: str
    filter: Column | None = None


def _short_key(c: Column, t: DataType) -> Column:
    """A grouping key of at most 32 bytes for texts and binaries, other types as they are."""
    plain_text = isinstance(t, StringType) and t.collation == "UTF8_BINARY"
    if not plain_text and not isinstance(t, BinaryType):
        return c
    raw = c.cast("binary")
    return F.when(F.octet_length(raw) < 32, raw).otherwise(F.unhex(F.sha2(raw, 256)))


def unique_metrics(base: DataFrame, specs: list[UniqueSpec]) -> DataFrame:
    """One-row aggregate: ``__u{j}`` values seen exactly once, ``__d{j}`` non-NULL rows,
    for each spec j. ``__d{j}`` is 0 when the column holds no value at all."""
    keys, wanted = [], []
    cols = [col_of(s.column, base.columns) for s in specs]
    types = [f.dataType for f in base.select(*[c.alias(f"__c{j}") for j, c in enumerate(cols)]).schema.fields]
    for j, (s, c, t) in enumerate(zip(specs, cols, types)):
        k = _short_key(c, t)
        keys.append((k if s.filter is None else F.when(s.filter, k)).alias(f"__k{j}"))
        wanted.append(c.isNotNull() if s.filter is None else (s.filter & c.isNotNull()))
    names = [f"__k{j}" for j in range(len(specs))]
    # rows that give no key to any spec are dropped at the scan (pushed down)
    proj = base.where(_any(wanted)).select(*keys)
    if len(specs) == 1:
        freq = proj.groupBy(names[0]).agg(F.count(F.lit(1)).alias("__c"))
        in_set = [F.lit(True)]
    else:
        freq = proj.groupingSets([[n] for n in names], *names).agg(
            F.count(F.lit(1)).alias("__c"),
            *[F.grouping(n).alias(f"__g{j}") for j, n in enumerate(names)],
        )
        in_set = [F.col(f"__g{j}") == 0 for j in range(len(names))]
    aggs = []
    for j, n in enumerate(names):
        seen = in_set[j] & F.col(n).isNotNull()
        aggs.append(F.count_if(seen & (F.col("__c") == 1)).alias(f"__u{j}"))
        aggs.append(F.coalesce(F.sum(F.when(seen, F.col("__c"))), F.lit(0)).cast("long").alias(f"__d{j}"))
    return freq.agg(*aggs)


# Bytes of a bitmap of one stretch of values; bytes that a value costs in the shuffle of a grouping.
BITMAP_BYTES, KEY_BYTES = 4096, 24


def _whole(c: Column, t: DataType) -> Column | None:
    """The column as long, if its type is a whole number or a date."""
    if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
        return c.cast("long")
    return F.unix_date(c).cast("long") if isinstance(t, DateType) else None


def _whole_keys(base: DataFrame, specs: list[UniqueSpec]) -> dict[int, Column]:
    cols = [col_of(s.column, base.columns) for s in specs]
    types = [f.dataType for f in base.select(*[c.alias(f"__c{j}") for j, c in enumerate(cols)]).schema.fields]
    keys = {j: _whole(c, t) for j, (c, t) in enumerate(zip(cols, types))}
    return {j: k if specs[j].filter is None else F.when(specs[j].filter, k) for j, k in keys.items() if k is not None}


def dense_keys(base: DataFrame, specs: list[UniqueSpec]) -> list[int]:
    """The specs whose bitmaps are less than a tenth of what their values would cost in a shuffle.

    A task meets no more stretches than it has rows or its values span, so the sum over tasks bounds the bitmaps' bytes.
    """
    keys = _whole_keys(base, specs)
    if not keys:
        return []
    rows = base.select(F.spark_partition_id().alias("__t"), *[k.alias(f"__k{j}") for j, k in keys.items()])
    tasks = rows.groupBy("__t").agg(*[f(f"__k{j}").alias(f"__{n}{j}") for j in keys for n, f in (("lo", F.min), ("hi", F.max), ("n", F.count))])
    size = {j: F.sum(F.least(F.col(f"__n{j}").cast("double"), F.col(f"__hi{j}").cast("double") / 32768 - F.col(f"__lo{j}").cast("double") / 32768 + 2) * BITMAP_BYTES) for j in keys}
    row = tasks.agg(*[size[j].alias(f"__b{j}") for j in keys], *[F.sum(f"__n{j}").alias(f"__n{j}") for j in keys]).collect()[0]
    return [j for j in keys if row[f"__n{j}"] and 10 * row[f"__b{j}"] < KEY_BYTES * row[f"__n{j}"]]


def bitmap_metrics(base: DataFrame, spec: UniqueSpec) -> DataFrame:
    """The same row as ``unique_metrics`` of this one spec, by bitmaps."""
    key = _whole_keys(base, [spec])[0]
    rows = base.where(col_of(spec.column, base.columns).isNotNull() if spec.filter is None else spec.filter & col_of(spec.column, base.columns).isNotNull())
    rows = rows.select(key.alias("__k")).withColumn("__s", F.bitmap_bucket_number("__k"))
    stretches = rows.groupBy("__s").agg(F.count(F.lit(1)).alias("__n"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("__k"))).alias("__bits"))
    once = stretches.where("__n = __bits").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("u"), F.coalesce(F.sum("__n"), F.lit(0)).alias("d"))
    doubled = stretches.where("__n > __bits").select(F.col("__s").alias("__again"))
    freq = rows.join(doubled, F.col("__s") == F.col("__again"), "left_semi").groupBy("__k").agg(F.count(F.lit(1)).alias("__c"))
    again = freq.agg(F.count_if(F.col("__c") == 1).alias("u"), F.coalesce(F.sum("__c"), F.lit(0)).alias("d"))
    return once.unionAll(again).agg(F.sum("u").alias("__u0"), F.sum("d").alias("__d0"))
