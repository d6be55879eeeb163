"""Check registry: method key -> builder of the check.

A builder gets the rule's column, parameters and the (filtered) table it runs on,
and returns a :class:`Check`, or ``None`` when the parameters cannot make a check.
Row-level checks carry a *pass predicate*: a boolean Column that is never NULL, so
the fused aggregate can count passing rows with ``count_if``. Uniqueness carries no
predicate: it needs a grouping, see :mod:`qualia.operators.metrics`. An aggregate
check carries SQL aggregates of its own and a function that turns them into the metric, a
fraction in [0, 1]; they are computed in the same scan as the row-level checks.

The NULL rule of each check:

============== ===============================================
check          a NULL value ...
============== ===============================================
complete       fails
unique         is left out (metric over non-NULL rows)
contained in   passes
non-negative   passes
pattern        fails
between        fails
length         fails
not blank      fails
satisfies      fails (predicate must be TRUE)
============== ===============================================
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FractionalType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from qualia.functions.text import col_of

ROW = "row"
UNIQUE = "unique"
AGGREGATE = "aggregate"


@dataclass(frozen=True)
class Check:
    kind: str                       # ROW, UNIQUE or AGGREGATE
    column: str
    metric: str                     # Completeness, Compliance, PatternMatch, Uniqueness
    instance: str
    predicate: Column | None = None  # ROW only: pass predicate, never NULL
    fallible: bool = True           # ROW only: whether the predicate may raise an error on some row
    # AGGREGATE only: calls of one aggregate function each, as SQL text by name, and the metric made of
    # them (NULL: nothing to measure). The rule's row filter is applied to each call.
    aggregates: Mapping[str, str] | None = None
    finish: Callable[[Mapping[str, Column]], Column] | None = None


@dataclass
class CheckContext:
    """What a builder may look at: the table (already filtered), column, parameters."""

    df: DataFrame
    column: str
    params: str
    schema: StructType | None = None   # df.schema, read once per group by the caller
    param_list: Sequence[str] = ()      # the parameters as a list, blanks left out

    @property
    def col(self) -> Column:
        return col_of(self.column, self.schema.fieldNames() if self.schema is not None else self.df.columns)

    def dtype(self) -> DataType:
        """Type of the rule's column; an unknown column raises (analysis, no job)."""
        if self.schema is not None:
            hits = [f for f in self.schema.fields if f.name.lower() == self.column.lower()]
            if len(hits) == 1:
                return hits[0].dataType
        return self.df.select(self.col).schema.fields[0].dataType

    def types_of(self, *cols: Column) -> list[DataType]:
        return [f.dataType for f in self.df.select(*cols).schema.fields]

    def text(self) -> Column:
        """The column as text (strings and binaries unchanged)."""
        if isinstance(self.dtype(), StringType):
            return self.col
        return self.col.cast("string")


Builder = Callable[[CheckContext], "Check | None"]
REGISTRY: dict[str, Builder] = {}


def register_check(key: str, builder: Builder) -> None:
    """Add or replace a method; ``key`` is the normalized method name."""
    REGISTRY[key.lower()] = builder


def _complete(ctx: CheckContext) -> Check:
    ctx.dtype()
    return Check(ROW, ctx.column, "Completeness", ctx.column, ctx.col.isNotNull(), fallible=False)


def _unique(ctx: CheckContext) -> Check:
    ctx.dtype()
    return Check(UNIQUE, ctx.column, "Uniqueness", ctx.column)


def _contained_in(ctx: CheckContext) -> Check | None:
    values = list(ctx.param_list)
    if not values:
        return None
    # Compared as text, whatever the column type (no ANSI cast of the list).
    pred = F.coalesce(ctx.text().isin(values), F.lit(True))
    return Check(ROW, ctx.column, "Compliance", f"{ctx.column} contained in {','.join(values)}", pred, fallible=False)


def _non_negative(ctx: CheckContext) -> Check:
    x = ctx.col if isinstance(ctx.dtype(), NumericType) else ctx.text().try_cast("double")
    return Check(ROW, ctx.column, "Compliance", f"{ctx.column} is non-negative",
                 F.coalesce(x >= 0, F.lit(True)), fallible=False)


_REGEX: dict[str, str | None] = {}   # pattern -> None (compiles) or the error text
_REGEX_LOCK = threading.Lock()
REMEMBERED_PATTERNS = 10_000         # forgotten past this many, then compiled again


def _bad_pattern(e: Exception) -> bool:
    get = getattr(e, "getCondition", None)
    return bool(get) and (get() or "").startswith(("INVALID_PARAMETER_VALUE", "INVALID_REGEXP"))


def validate_patterns(spark, patterns) -> None:
    """Compile patterns on the driver, all in one go, without a Spark job. A pattern
    that does not compile is remembered with its error, and its rule fails alone
    instead of the scan. Any other failure (a cancelled job, a lost connection) says
    nothing about a pattern and is not remembered."""
    with _REGEX_LOCK:
        if len(_REGEX) > REMEMBERED_PATTERNS:
            _REGEX.clear()
        todo = sorted({p for p in patterns if p and p not in _REGEX})
    if not todo:
        return
    # an inline table is a local relation: the projection is folded into it and
    # evaluated on the driver (no job); a bad pattern raises right here
    probe = spark.sql("SELECT * FROM VALUES ('') AS t(s)")
    try:
        probe.select(*[F.regexp_extract("s", p, 0) for p in todo]).collect()
        found = {p: None for p in todo}
    except Exception:
        found = {}
        for p in todo:
            try:
                probe.select(F.regexp_extract("s", p, 0)).collect()
                found[p] = None
            except Exception as e:
                if _bad_pattern(e):
                    found[p] = " ".join(str(e).split())
    with _REGEX_LOCK:
        _REGEX.update(found)


_SPECIAL = set("\\^$.|?*+()[]{}")
# escapes that stand for one non-literal atom and carry no argument
_CLASS_ESCAPES = set("dDwWsSbBAzZGhHvVRX")


def required_literal(pattern: str) -> str | None:
    """Longest text that every match of ``pattern`` must contain, or ``None``.

    Conservative reading of a Java regex: only top-level literals that are not
    made optional by a quantifier count, and any construct that could change that
    (alternation, inline flags, groups' contents, quoting, nested classes, escapes
    with arguments) ends the search with ``None`` or is skipped as a non-literal.
    Used to skip the regex on text that lacks the literal: same result, less work.
    """
    if "|" in pattern or "(?" in pattern or "\\Q" in pattern:
        return None
    runs: list[str] = []
    run = ""
    depth = 0
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        lit = None          # literal char of this atom, if it is one at depth 0
        if ch == "\\":
            if i + 1 >= n:
                return None
            nxt = pattern[i + 1]
            if nxt.isalnum():
                if nxt not in _CLASS_ESCAPES:
                    return None
            elif depth == 0:
                lit = nxt
            i += 2
        elif ch == "[":
            j = i + 1
            if j < n and pattern[j] == "^":
                j += 1
            if j < n and pattern[j] == "]":
                return None  # a leading "]" reads differently across regex dialects
            while j < n and pattern[j] != "]":
                if pattern[j] == "[":
                    return None
                j += 2 if pattern[j] == "\\" else 1
            if j >= n:
                return None
            i = j + 1
        elif ch == "(":
            depth += 1
            i += 1
        elif ch == ")":
            depth -= 1
            i += 1
        elif ch in "^$.":
            i += 1
        elif ch in _SPECIAL:
            return None      # a quantifier with no atom, or a stray brace
        else:
            lit = ch if depth == 0 else None
            i += 1
        # quantifier of this atom
        optional, repeated = False, False
        if i < n and pattern[i] in "?*+{":
            q = pattern[i]
            if q == "{":
                m = re.match(r"\{(\d+)(,\d*)?\}", pattern[i:])
                if not m:
                    return None
                optional = int(m.group(1)) == 0
                repeated = True
                i += m.end()
            else:
                optional = q in "?*"
                repeated = True
                i += 1
            if i < n and pattern[i] in "?+":
                i += 1       # lazy or possessive form of the quantifier
        if lit is not None and not optional:
            run += lit
            if repeated:
                runs.append(run)
                run = ""
        else:
            if run:
                runs.append(run)
            run = ""
    if run:
        runs.append(run)
    return max(runs, key=len) if runs else None


def _pattern(ctx: CheckContext) -> Check | None:
    pattern = ctx.params
    if not pattern or not pattern.strip():
        return None
    validate_patterns(ctx.df.sparkSession, [pattern])
    if _REGEX.get(pattern):
        raise ValueError(_REGEX[pattern])
    # A row passes when the pattern *finds* a non-empty match (not rlike: a pattern
    # that matches the empty string would pass every row with rlike).
    text = ctx.text()
    found = F.regexp_extract(text, pattern, 0) != ""
    literal = required_literal(pattern)
    if literal:
        found = text.contains(literal) & found
    return Check(ROW, ctx.column, "PatternMatch", ctx.column, F.coalesce(found, F.lit(False)), fallible=False)


_DATETIME = (DateType, TimestampType, TimestampNTZType)


def _digits(bound: DataType) -> tuple[int, int]:
    """Whole and fraction digits of a whole or decimal type."""
    t = bound if isinstance(bound, DecimalType) else DecimalType(20, 0)
    return t.precision - t.scale, t.scale


def _reading_types(lo: DataType, hi: DataType) -> list[DataType]:
    """Types that read text for a comparison with two numeric bounds, the finest first: a double if a bound is one, else
    decimals, so that long ids keep every digit. The last one holds every value between the bounds (with as
    many fraction digits as there is room for, 18 at least where both bounds leave it); where it has fewer than a bound, a
    type with all of that bound's comes first, and text too large for it is left to the last."""
    if any(isinstance(t, FractionalType) and not isinstance(t, DecimalType) for t in (lo, hi)):
        return [DoubleType()]
    whole = max(_digits(t)[0] for t in (lo, hi))
    scale = max(_digits(t)[1] for t in (lo, hi))
    if whole + max(scale, 18) <= 38:
        return [DecimalType(38, max(scale, 18))]
    last = min(max(scale, 18), 38 - whole)
    return [*([DecimalType(38, scale)] if scale > last else []), DecimalType(38, last)]


def _text_between(x: Column, lo: Column, hi: Column, lot: DataType, hit: DataType) -> Column:
    """``lo <= x <= hi`` of text; text that is no number, or beyond every type, gives NULL."""
    reads = [x.try_cast(t) for t in _reading_types(lot, hit)]
    return F.coalesce(*[r >= lo for r in reads]) & F.coalesce(*[r <= hi for r in reads])


def _coerce(x: Column, xt: DataType, b: Column, bt: DataType) -> tuple[Column, Column]:
    """Make a comparison safe under ANSI mode: text is read with ``try_cast`` so that
    an unreadable value gives NULL (the row fails) instead of a runtime error."""
    if isinstance(xt, StringType) and isinstance(bt, NumericType):
        return x.try_cast(_reading_types(bt, bt)[-1]), b
    if isinstance(xt, NumericType) and isinstance(bt, StringType):
        return x, b.try_cast("double")
    if isinstance(xt, _DATETIME) and isinstance(bt, StringType):
        return x, b.try_cast(xt)
    if isinstance(xt, StringType) and isinstance(bt, _DATETIME):
        return x.try_cast(bt), b
    return x, b


_PLAIN_BOUND = re.compile(r"[+-]?\d+(\.\d+)?|'[^'\\]*'")


def _between(ctx: CheckContext) -> Check | None:
    bounds = ctx.param_list
    if len(bounds) != 2:
        return None
    lo, hi = F.expr(bounds[0]), F.expr(bounds[1])
    xt = ctx.dtype()
    lot, hit = ctx.types_of(lo, hi)
    if isinstance(xt, StringType) and isinstance(lot, NumericType) and isinstance(hit, NumericType):
        inside = _text_between(ctx.col, lo, hi, lot, hit)
    else:
        x1, lo = _coerce(ctx.col, xt, lo, lot)
        x2, hi = _coerce(ctx.col, xt, hi, hit)
        inside = (x1 >= lo) & (x2 <= hi)
    name = ctx.column
    return Check(ROW, name, "Compliance", f"{name} >= {bounds[0]} AND {name} <= {bounds[1]}", F.coalesce(inside, F.lit(False)),
                 fallible=not all(_PLAIN_BOUND.fullmatch(b.strip()) for b in bounds))


_INT = re.compile(r"[+-]?\d+")


def _length(ctx: CheckContext) -> Check | None:
    text = (ctx.params or "").strip()
    if not _INT.fullmatch(text):
        return None
    k = int(text)
    xt = ctx.dtype()
    x = ctx.col if isinstance(xt, (StringType, BinaryType)) else ctx.col.cast("string")
    pred = F.coalesce(F.length(x) == F.lit(k), F.lit(False))
    return Check(ROW, ctx.column, "Compliance", f"length({ctx.column}) = {k}", pred, fallible=False)


def _not_blank(ctx: CheckContext) -> Check:
    # trim removes the space character only: a tab is content.
    pred = F.coalesce(ctx.col.isNotNull() & (F.trim(ctx.text()) != ""), F.lit(False))
    name = ctx.column
    return Check(ROW, name, "Compliance", f"trim({name}) != '' AND {name} IS NOT NULL", pred, fallible=False)


def _satisfies(ctx: CheckContext) -> Check | None:
    text = (ctx.params or "").strip()
    if not text:
        return None
    e = F.expr(text)
    (t,) = ctx.types_of(e)
    if not isinstance(t, BooleanType):
        return None
    return Check(ROW, ctx.column, "Compliance", text, F.coalesce(e, F.lit(False)))


# --- Fixed values: method keys (normalized catalog method names) -------------------------
register_check("iscomplete", _complete)
register_check("collectnulls", _complete)
register_check("isunique", _unique)
register_check("iscontainedin", _contained_in)
register_check("isnonnegative", _non_negative)
register_check("haspattern", _pattern)
register_check("between", _between)
register_check("lengthequals", _length)
register_check("notnullorempty", _not_blank)
register_check("satisfies", _satisfies)


def build_check(method_key: str, df: DataFrame, column: str | None, params: str | None,
                schema: StructType | None = None, *, param_list: Sequence[str] = (),
                resolve: bool = True) -> Check | None:
    """Check of one rule, or ``None`` for unusable parameters (also: no column).

    Raises ``KeyError`` for an unknown method, and Spark's analysis errors for a
    column or expression that does not resolve on ``df``. ``resolve=False`` leaves
    the predicate unresolved, for a caller that resolves many at once. ``param_list``:
    the parameters as a list (see :func:`qualia.plans.rules.param_list`).
    """
    builder = REGISTRY[method_key]
    if column is None:
        return None
    check = builder(CheckContext(df, column, params or "", schema, param_list))
    if resolve and check is not None and check.predicate is not None:
        df.select(check.predicate)  # resolve now, so a bad rule fails alone
    return check
