"""Engine: rules + catalog + tables -> one result row per rule.

Plan of a run::

    rules --standardize--> join catalog --> active only --> collect (control rows)
      -> group by (schema, table, filter)
      -> per table (in parallel threads):
           one fused scan aggregate for every row-level rule of every filter
             (chunks of ``aggs_per_scan`` aggregates, side by side)
           one GROUPING SETS query for every uniqueness rule of every filter
             (chunks of ``unique_per_query`` columns, side by side)
      -> per-rule counts (a local relation) -> classification (SQL expressions)

Data never reaches the driver: each table returns one aggregate row per query.
Faults stay local: a missing table or a bad filter turns its own rules into
``ERROR_EJECUCION``; a rule whose column or expression does not resolve, or whose
parameters are unusable, becomes ``NO_EVALUADA`` alone. A predicate that raises an
error on some row does not end the scan: those rows are counted and its rule becomes
``NO_EVALUADA``, in lazy mode too. If a fused job still fails with a data error (a
filter, an aggregate check), its rules are bisected down to the ones at fault;
any other job failure fails the affected groups. ``eager=False`` builds all of
this as one unexecuted plan instead.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.util import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from qualia.functions.text import col_of, quote_ident
from qualia.operators.checks import AGGREGATE, REGISTRY, UNIQUE, Check, build_check, validate_patterns
from qualia.operators.classify import (
    ERROR,
    EVALUATED,
    METRICS_SCHEMA,
    SKIPPED,
    UNRESOLVED,
    check_outcomes,
    classify,
    metric_report,
)
from qualia.operators.metrics import RowGroup, UniqueSpec, bitmap_metrics, dense_keys, row_metrics, unique_metrics, weight
from qualia.plans.rules import (
    Rule,
    RuleGroup,
    active_rules,
    collect_rules,
    group_rules,
    join_catalog,
    number_rules,
    standardize_rules,
)
from qualia.schema import (
    MAX_ERROR_CHARS,
    MSG_BAD_PARAMS,
    MSG_FATAL,
    MSG_NOT_EVALUABLE,
    MSG_ROW_ERRORS,
    MSG_UNSUPPORTED,
    RESULT_BODY_COLUMNS,
    RESULT_COLUMNS,
    WIDE_COLUMNS,
)
from qualia.sources.tables import TableResolver, TableSource, full_table_name


def _err_text(e: BaseException) -> str:
    return " ".join(str(e).split())


def _inherit(src: DataFrame | SparkSession, fn):
    """``fn`` for a helper thread that keeps this thread's Spark job properties
    (description, tags), so its jobs are labelled like the caller's."""
    spark = src.sparkSession if isinstance(src, DataFrame) else src
    return inheritable_thread_target(spark)(fn)


def _rule_fault(e: BaseException) -> bool:
    """True for an error raised by an expression (SQLSTATE class 22: division by zero,
    invalid cast, bad pattern ...; class 42: an expression that cannot be planned), which
    re-running a subset of the rules can pin down. Anything else (lost executors past Spark's own retries, I/O) is a
    failure of the group as a whole and is not re-run rule by rule."""
    get = getattr(e, "getSqlState", None)
    try:
        state = get() if callable(get) else None
    except Exception:
        state = None
    return bool(state) and state.startswith(("22", "42"))


@dataclass
class _Planned:
    """A group after planning: its filter and what each rule became."""

    group: RuleGroup
    fcol: Column | None
    row: list[tuple[Rule, Check]] = field(default_factory=list)
    unique: list[tuple[Rule, Check]] = field(default_factory=list)
    broken: list[tuple[Rule, Check | None, str]] = field(default_factory=list)  # did not resolve
    skipped: list[tuple[Rule, str]] = field(default_factory=list)   # method / params
    error: str | None = None          # whole group failed
    total: int | None = None
    totals: dict[int, int] = field(default_factory=dict)       # rule index -> rows of its own scan
    passed: dict[int, int] = field(default_factory=dict)       # rule index -> count
    values: dict[int, float | None] = field(default_factory=dict)  # rule index -> metric of an aggregate check
    uniq: dict[int, tuple[int, int]] = field(default_factory=dict)
    rule_error: dict[int, str] = field(default_factory=dict)


def _plan_group(df: DataFrame, group: RuleGroup, resolve: bool = True) -> _Planned:
    """``resolve``: set aside at once the rules that do not resolve; else the scan that meets one does."""
    p = _Planned(group, None)
    schema = df.schema
    for r in group.rules:
        key = r.method_key or ""
        if key not in REGISTRY:
            p.skipped.append((r, MSG_UNSUPPORTED.format(method=r.metodo)))
            continue
        try:
            check = build_check(key, df, r.column_name, r.params, schema,
                                param_list=r.param_list, resolve=False)
        except Exception as e:  # analysis error of this rule only
            p.broken.append((r, None, _not_evaluable(e)))
            continue
        if check is None:
            p.skipped.append((r, MSG_BAD_PARAMS.format(method=r.metodo)))
        elif check.kind == UNIQUE:
            p.unique.append((r, check))
        else:
            p.row.append((r, check))
    if not resolve:
        return p
    p.row = _resolvable(p, p.row, lambda cs: row_metrics(df, [RowGroup(None, [replace(c, fallible=False) for c in cs])]))
    p.unique = _resolvable(p, p.unique, lambda cs: unique_metrics(df, [UniqueSpec(c.column) for c in cs]))
    return p


def _not_evaluable(e: BaseException) -> str:
    return MSG_NOT_EVALUABLE.format(error=_err_text(e))[:MAX_ERROR_CHARS]


def _resolvable(p: _Planned, items: list[tuple[Rule, Check]], aggregate) -> list[tuple[Rule, Check]]:
    """The rules whose aggregates resolve: all at once (analysis only, no job); if that
    fails, one by one, so that only the rules at fault are set aside."""
    if not items:
        return items
    try:
        aggregate([c for _, c in items])
        return items
    except Exception:
        good = []
    for r, c in items:
        try:
            aggregate([c])
            good.append((r, c))
        except Exception as e:
            p.broken.append((r, c, _not_evaluable(e)))
    return good


# Default of ``aggs_per_scan``: aggregate expressions per scan job. Beyond about a hundred output fields Spark
# turns whole-stage codegen off for the aggregate and it runs several times slower
# (measured: 50 rules 1 s, 100 rules 13 s on lineitem sf0.1), so a table with many
# rules is split into chunks of this size, run side by side. Raising
# spark.sql.codegen.maxFields does not help: the generated method then grows past
# what the JIT compiles (120 rules: 4.6 s -> 9.7 s; 400 rules: 44 s).
AGGS_PER_SCAN = 40

_Part = tuple  # (plan, [(rule, check), ...]): some rules of one filter


def _chunks(plans: list[_Planned], most: int) -> list[list[_Part]]:
    """Pack the rules of a table that one scan can count into scan jobs of at most
    ``most`` aggregates (one count per filter, one or two per rule; a single rule with more has a job of its own).
    Rules on the same column stay together, so each chunk reads few columns."""
    chunks: list[list[_Part]] = []
    cur: list[_Part] = []
    size = 0
    for p in plans:
        items = sorted(p.row, key=lambda rc: rc[1].column)
        i = 0
        while True:
            if cur and size + 1 + (weight(items[i][1]) if i < len(items) else 0) > most:
                chunks.append(cur)
                cur, size = [], 0
            size += 1
            take = []
            while i < len(items) and (size + weight(items[i][1]) <= most or size == 1 and not take):
                size += weight(items[i][1])
                take.append(items[i])
                i += 1
            cur.append((p, take))
            if i >= len(items):
                break
    if cur:
        chunks.append(cur)
    return chunks


def _group(p: _Planned, items: list[tuple[Rule, Check]]) -> RowGroup:
    return RowGroup(p.fcol, [c for _, c in items], p.group.filter)


def _row_errors(n: int) -> str:
    return MSG_NOT_EVALUABLE.format(error=MSG_ROW_ERRORS.format(n=n))


def _take_counts(p: _Planned, items: list[tuple[Rule, Check]], row, gi: int) -> None:
    """What one scan says of a filter's rules."""
    for i, (r, c) in enumerate(items):
        p.totals[r.index] = row[f"__n{gi}"]
        if c.kind == AGGREGATE:
            p.values[r.index] = row[f"__v{gi}_{i}"]
        elif c.fallible and row[f"__e{gi}_{i}"]:
            p.rule_error[r.index] = _row_errors(row[f"__e{gi}_{i}"])
        else:
            p.passed[r.index] = row[f"__p{gi}_{i}"]


def _resolved(base: DataFrame, p: _Planned, items: list[tuple[Rule, Check]]) -> list[tuple[Rule, Check]]:
    return _resolvable(p, items, lambda cs: row_metrics(base, [RowGroup(p.fcol, [replace(c, fallible=False) for c in cs], p.group.filter)]))


def _run_chunk(base: DataFrame, chunk: list[_Part]) -> None:
    groups = [_group(p, items) for p, items in chunk]
    try:
        if any(c.fallible for p, items in chunk for _, c in items):
            # a guarded predicate is projected first, where a window would pass for a predicate: not so inside an aggregate
            base.agg(F.count("*"), *[F.count_if(c.predicate) for _, items in chunk for _, c in items if c.predicate is not None and c.fallible])
        counts = row_metrics(base, groups)
    except AnalysisException:  # no job has run: the rules at fault are set aside, the others run together
        chunk = [(p, _resolved(base, p, items)) for p, items in chunk]
        counts = row_metrics(base, [_group(p, items) for p, items in chunk])
    try:
        row = counts.collect()[0]
        for gi, (p, items) in enumerate(chunk):
            p.total = row[f"__n{gi}"]
            _take_counts(p, items, row, gi)
        return
    except Exception as e:
        if not _rule_fault(e):
            for p, _ in chunk:
                p.error = _err_text(e)
            return
    for p, items in chunk:
        if p.error is not None:
            continue
        if p.total is None:
            try:
                p.total = row_metrics(base, [_group(p, [])]).collect()[0]["__n0"]
            except Exception as e:
                p.error = _err_text(e)
                continue
        half = len(items) // 2
        _bisect(base, p, items[:half])
        _bisect(base, p, items[half:])


def _run_row_level(base: DataFrame, plans: list[_Planned], most: int) -> None:
    """Fill ``total``, ``totals`` and ``passed`` of each plan: one scan job for all
    row-level rules of the table (several, side by side, past ``most`` aggregates). A
    rule's rows are counted by the scan that counts its passing rows.

    If a job fails at run time, each filter's count is re-run alone; a failing
    count makes the filter's rules an error group; otherwise the rules are bisected
    (halves re-run fused) down to the ones that fail, so one bad rule among n costs
    about 2*log2(n) extra scans, not n.
    """
    chunks = _chunks(plans, most)
    if len(chunks) == 1:
        _run_chunk(base, chunks[0])
    else:
        with ThreadPoolExecutor(max_workers=min(len(chunks), 8)) as pool:
            list(pool.map(_inherit(base, lambda ch: _run_chunk(base, ch)), chunks))
    for p in plans:
        broken = {r.index for r, _, _ in p.broken}
        p.row = [rc for rc in p.row if rc[0].index not in broken]


def _bisect(base: DataFrame, p: _Planned, items: list[tuple[Rule, Check]]) -> None:
    if not items:
        return
    try:
        _take_counts(p, items, row_metrics(base, [_group(p, items)]).collect()[0], 0)
        return
    except Exception as e:
        if not _rule_fault(e):
            p.error = _err_text(e)
            return
        if len(items) == 1:
            p.rule_error[items[0][0].index] = _not_evaluable(e)
            return
    half = len(items) // 2
    _bisect(base, p, items[:half])
    _bisect(base, p, items[half:])


# Default of ``unique_per_query``: uniqueness columns per GROUPING SETS query. Expand writes one copy of each row per
# column, padded with NULLs for the others, so a query over many columns has wide
# rows (and past ~50 columns its final aggregate leaves whole-stage codegen). Each
# column is read once either way, so wide rule sets are split into queries of
# this many columns, run side by side.
UNIQUE_PER_QUERY = 8


def _unique_specs(plans: list[_Planned]) -> tuple[list[UniqueSpec], dict[tuple[int, str], int]]:
    """One spec per distinct (filter, column) of the uniqueness rules."""
    specs: dict[tuple[int, str], int] = {}
    spec_list: list[UniqueSpec] = []
    for pi, p in enumerate(plans):
        if p.error is not None:
            continue
        for _, c in p.unique:
            if (pi, c.column) not in specs:
                specs[(pi, c.column)] = len(spec_list)
                spec_list.append(UniqueSpec(c.column, p.fcol))
    return spec_list, specs


def _unique_chunk(base: DataFrame, specs: list[UniqueSpec], first: int) -> dict[int, tuple[int, int] | str]:
    try:
        row = unique_metrics(base, specs).collect()[0]
        return {first + j: (row[f"__u{j}"], row[f"__d{j}"]) for j in range(len(specs))}
    except Exception as e:
        if not _rule_fault(e):
            raise
    out: dict[int, tuple[int, int] | str] = {}
    for j, s in enumerate(specs):
        try:
            unique_metrics(base, [s])
        except AnalysisException as e:
            out[first + j] = _not_evaluable(e)
    good = [j for j in range(len(specs)) if first + j not in out]
    if out:  # the others run together
        found = _unique_chunk(base, [specs[j] for j in good], 0) if good else {}
        return out | {first + good[k]: v for k, v in found.items()}
    for j, s in enumerate(specs):
        try:
            row = unique_metrics(base, [s]).collect()[0]
            out[first + j] = (row["__u0"], row["__d0"])
        except Exception as e:
            out[first + j] = _not_evaluable(e)
    return out


def _unique_by_bitmap(base: DataFrame, spec: UniqueSpec, at: int) -> dict[int, tuple[int, int] | str]:
    try:
        row = bitmap_metrics(base, spec).collect()[0]
        return {at: (row["__u0"], row["__d0"])}
    except Exception as e:
        if not _rule_fault(e):
            raise
        return {at: _not_evaluable(e)}


def _run_unique(base: DataFrame, plans: list[_Planned], step: int, key_bitmaps: bool = False) -> None:
    """Fill ``uniq`` of each plan: one GROUPING SETS job for the table's uniqueness
    rules (several, side by side, past ``step`` columns), and with ``key_bitmaps`` a bitmap job for each dense key."""
    spec_list, specs = _unique_specs(plans)
    if not spec_list:
        return
    results: dict[int, tuple[int, int] | str] = {}
    try:
        dense = dense_keys(base, spec_list) if key_bitmaps else []
        rest = [j for j in range(len(spec_list)) if j not in dense]
        work = [lambda j=j: _unique_by_bitmap(base, spec_list[j], j) for j in dense]
        for i in range(0, len(rest), step):
            some = rest[i:i + step]
            work.append(lambda some=some: {some[k]: v for k, v in _unique_chunk(base, [spec_list[j] for j in some], 0).items()})
        if len(work) == 1:
            results = work[0]()
        else:
            with ThreadPoolExecutor(max_workers=min(len(work), 8)) as pool:
                for part in pool.map(_inherit(base, lambda f: f()), work):
                    results.update(part)
    except Exception as e:
        for pi, _ in specs:
            plans[pi].error = _err_text(e)
        return
    for (pi, column), j in specs.items():
        p = plans[pi]
        for r, c in p.unique:
            if c.column == column:
                res = results[j]
                if isinstance(res, str):
                    p.rule_error[r.index] = res
                else:
                    p.uniq[r.index] = res


_IDENT = re.compile(r"`((?:[^`]|``)+)`|([A-Za-z_][A-Za-z0-9_]*)")


def _referenced_columns(base: DataFrame, plans: list[_Planned]) -> list[str]:
    """Columns of ``base`` named by the rules, their parameters or filters (by name
    match, so an over-selection is possible, an under-selection is not for plain
    identifiers)."""
    words: set[str] = set()
    for p in plans:
        texts = [p.group.filter] + [r.params or "" for r in p.group.rules]
        for r in p.group.rules:
            name = (r.column_name or "").lower()
            words.update((name, name.split(".")[0]))  # a nested path needs its struct
        for t in texts:
            for m in _IDENT.finditer(t):
                words.add((m.group(1).replace("``", "`") if m.group(1) else m.group(2)).lower())
    return [c for c in base.columns if c.lower() in words]


def _plan_table(resolver: TableResolver, groups: list[RuleGroup], resolve: bool = True
                ) -> tuple[DataFrame | None, list[_Planned], list[_Planned]]:
    """Resolve a table and plan its rule groups (analysis only, no job).
    Returns (table, all plans, plans that can run)."""
    g0 = groups[0]
    plans: list[_Planned] = []
    try:
        base = resolver(g0.schema, g0.table_name)
    except Exception as e:
        return None, [_Planned(g, None, error=_err_text(e)) for g in groups], []
    live: list[_Planned] = []
    for g in groups:
        try:
            fcol = F.expr(g.filter) if g.filter else None
            fdf = base.where(fcol) if fcol is not None else base
        except Exception as e:
            plans.append(_Planned(g, None, error=_err_text(e)))
            continue
        p = _plan_group(fdf, g, resolve)
        p.fcol = fcol
        plans.append(p)
        live.append(p)
    return base, plans, live


def _evaluate_table(resolver: TableResolver, groups: list[RuleGroup], cache: bool,
                    sizes: tuple[int, int], key_bitmaps: bool = False) -> list[_Planned]:
    base, plans, live = _plan_table(resolver, groups, resolve=cache or key_bitmaps)
    if not live:
        return plans
    g0 = groups[0]
    spark = base.sparkSession
    # the description reaches the jobs of the helper threads below (event logs)
    callers_text = spark.sparkContext.getLocalProperty("spark.job.description")
    spark.sparkContext.setJobDescription(f"table checks on {full_table_name(g0.schema, g0.table_name)}")
    data = base
    cache = cache and any(p.unique for p in live) and any(p.row for p in live)
    if cache:
        # Opt-in: keep only the named columns of the rows under any filter, for the
        # two queries below. Without it each query prunes its own scan.
        keep = _referenced_columns(base, live)
        filters = [p.fcol for p in live]
        data = base.where(reduce(lambda a, b: a | b, filters)) if all(f is not None for f in filters) else base
        pruned = data.select(*[F.col(quote_ident(c)) for c in keep]) if keep else data
        try:  # everything must still resolve on the pruned columns (analysis only)
            for p in live:
                pruned.agg(F.count("*"), *[F.expr(a) for _, c in p.row for a in (c.aggregates or {}).values()])
            pruned.select(*[f for f in filters if f is not None],
                          *[c.predicate for p in live for _, c in p.row if c.predicate is not None],
                          *[col_of(c.column, base.columns) for p in live for _, c in p.unique])
            data = pruned
        except Exception:
            pass  # keep every column rather than guess
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if any(p.unique for p in live):
            # the two queries of a table are independent: run them side by side
            with ThreadPoolExecutor(max_workers=2) as pool:
                jobs = [pool.submit(_inherit(data, _run_row_level), data, live, sizes[0]),
                        pool.submit(_inherit(data, _run_unique), data, live, sizes[1], key_bitmaps)]
                for j in jobs:
                    j.result()
        else:
            _run_row_level(data, live, sizes[0])
    finally:
        if cache:
            data.unpersist()
        spark.sparkContext.setJobDescription(callers_text)
    return plans


_NULL_LONG = "CAST(NULL AS BIGINT)"


_NULL_DOUBLE = "CAST(NULL AS DOUBLE)"


def _count_rows(agg: DataFrame, cells: list[tuple[int, str, str, str, str, str]]) -> DataFrame:
    """One-row aggregate -> one row per rule: (rule_index, total, passed, denom, value, errors)."""
    structs = ", ".join(f"named_struct('rule_index', CAST({i} AS BIGINT), 'total', {t}, 'passed', {p}, 'denom', {d}, "
                        f"'value', {v}, 'errors', {e})" for i, t, p, d, v, e in cells)
    return agg.select(F.expr(f"inline(array({structs}))"))


def _lazy_counts(base: DataFrame, live: list[_Planned], sizes: tuple[int, int]) -> list[DataFrame]:
    """The table's aggregates as unexecuted plans, reshaped to per-rule count rows."""
    frames = []
    with_total: set[int] = set()
    for chunk in _chunks(live, sizes[0]):
        agg = row_metrics(base, [_group(p, items) for p, items in chunk])
        cells = []
        for gi, (p, items) in enumerate(chunk):
            n = f"__n{gi}"
            for i, (r, c) in enumerate(items):
                if c.kind == AGGREGATE:
                    cells.append((r.index, n, _NULL_LONG, _NULL_LONG, f"__v{gi}_{i}", _NULL_LONG))
                else:
                    cells.append((r.index, n, f"__p{gi}_{i}", n, _NULL_DOUBLE, f"__e{gi}_{i}" if c.fallible else _NULL_LONG))
            if id(p) not in with_total:  # the group's total, for its other rules
                with_total.add(id(p))
                others = [r for r, _ in p.unique] + [r for r, _, _ in p.broken] + [r for r, _ in p.skipped]
                cells += [(r.index, n, _NULL_LONG, _NULL_LONG, _NULL_DOUBLE, _NULL_LONG) for r in others]
        if cells:
            frames.append(_count_rows(agg, cells))
    spec_list, specs = _unique_specs(live)
    step = sizes[1]
    for start in range(0, len(spec_list), step):
        cells = []
        for pi, p in enumerate(live):
            for r, c in p.unique:
                j = specs[(pi, c.column)]
                if start <= j < start + step:
                    cells.append((r.index, _NULL_LONG, f"__u{j - start}", f"__d{j - start}", _NULL_DOUBLE, _NULL_LONG))
        frames.append(_count_rows(unique_metrics(base, spec_list[start:start + step]), cells))
    return frames


def _metric_rows(plans: list[_Planned]) -> list[tuple[tuple, dict]]:
    out = []
    for p in plans:
        g = p.group
        full = full_table_name(g.schema, g.table_name)
        pos = {r.index: i for i, r in enumerate(g.rules)}

        def row(r: Rule, phase: int, outcome: str, total=None, passed=None, denom=None, value=None,
                message=None, check: Check | None = None) -> tuple[tuple, dict]:
            return ((g.index, phase, r.index), {
                "rule_index": r.index, "schema": r.schema, "table_name": r.table_name, "column_name": r.column_name,
                "rule_code": r.rule_code, "dimension": r.dimension, "metodo": r.metodo,
                "params": r.params, "threshold": r.threshold, "outcome": outcome,
                "total": total, "passed": passed, "denom": denom, "value": value, "message": message,
                "metric_name": check.metric if check else None,
                "instance": check.instance if check else None,
                "check_name": f"{r.rule_code}:{r.column_name}:{pos[r.index]}",
            })

        if p.error is not None:
            msg = MSG_FATAL.format(table=full, error=p.error)[:MAX_ERROR_CHARS]
            out += [row(r, 0, ERROR, total=0, message=msg) for r in g.rules]
            continue
        for r, c in p.row + p.unique:
            n = p.totals.get(r.index, p.total)
            if r.index in p.rule_error:
                out.append(row(r, 0, UNRESOLVED, total=n, message=p.rule_error[r.index], check=c))
            elif c.kind == UNIQUE:
                u, d = p.uniq.get(r.index, (None, None))
                out.append(row(r, 0, EVALUATED, n, u, d, check=c))
            elif c.kind == AGGREGATE:
                out.append(row(r, 0, EVALUATED, n, value=p.values.get(r.index), check=c))
            else:
                out.append(row(r, 0, EVALUATED, n, p.passed.get(r.index), n, check=c))
        out += [row(r, 0, UNRESOLVED, total=p.total, message=m, check=c) for r, c, m in p.broken]
        out += [row(r, 1, SKIPPED, total=p.total, message=m) for r, m in p.skipped]
    return out


def evaluate_rules(
    spark: SparkSession,
    rules: DataFrame,
    catalog: DataFrame | None = None,
    *,
    dataset: str | None = None,
    tables: Mapping[str, TableSource] | None = None,
    fuse_filters: bool = True,
    parallelism: int = 4,
    cache: bool = False,
    eager: bool = True,
    aggs_per_scan: int = AGGS_PER_SCAN,
    unique_per_query: int = UNIQUE_PER_QUERY,
    key_bitmaps: bool = False,
) -> DataFrame:
    """Run the active rules and return the *metrics relation*: one row per rule with
    its counts (``total``, ``passed``, ``denom``) and outcome, in result order.

    ``fuse_filters``: all filters of one table share one scan (default); off gives
    one scan per (table, filter) as the rule groups are written. ``parallelism``:
    how many tables are checked at the same time (Spark jobs from driver threads).
    ``cache``: persist the needed columns of each table between its two queries.
    ``eager=False``: run nothing yet; return the unexecuted plan of every table's
    aggregates, so that the caller's action checks all tables in one Spark job.
    Analysis faults are still isolated per rule and per group, and so are rows on which a predicate
    raises an error, but an error in a filter or an aggregate check
    then fails that action (no re-run, no cache). ``key_bitmaps``: check the uniqueness of whole-number
    and date columns whose values lie close together by bitmaps, without moving a row for each value
    (not in lazy mode, which cannot look first). ``aggs_per_scan`` (2 or more): counts
    in one scan job, one per filter and one or two per rule; ``unique_per_query`` (1 or more):
    columns in one uniqueness query. A table with more runs several jobs side by side;
    every rule is evaluated either way.
    """
    if aggs_per_scan < 2 or unique_per_query < 1:
        raise ValueError("aggs_per_scan must be at least 2 and unique_per_query at least 1")
    sizes = (aggs_per_scan, unique_per_query)
    kept = number_rules(active_rules(standardize_rules(rules, with_seq=False), dataset))
    plan = join_catalog(kept, catalog)
    active = collect_rules(plan)
    groups = group_rules(active)
    resolver = TableResolver(spark, tables)
    validate_patterns(spark, [r.params for r in active if r.method_key == "haspattern"])

    units: dict[tuple, list[RuleGroup]] = {}
    for g in groups:
        key = (g.schema, g.table_name) if fuse_filters else (g.schema, g.table_name, g.index)
        units.setdefault(key, []).append(g)
    work = list(units.values())
    if not eager:
        return _lazy_metrics(spark, resolver, work, sizes)

    if parallelism > 1 and len(work) > 1:
        with ThreadPoolExecutor(max_workers=min(parallelism, len(work))) as pool:
            done = list(pool.map(_inherit(spark, lambda gs: _evaluate_table(resolver, gs, cache, sizes, key_bitmaps)), work))
    else:
        done = [_evaluate_table(resolver, gs, cache, sizes, key_bitmaps) for gs in work]

    return _metrics_frame(spark, done)


_ARROW_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _metrics_frame(spark: SparkSession, done: list[list[_Planned]], schema=METRICS_SCHEMA) -> DataFrame:
    """The per-rule rows as a local relation (built from an Arrow table): the
    classification on top of it is folded into it and evaluated on the driver."""
    rows = sorted((r for plans in done for r in _metric_rows(plans)), key=lambda kv: kv[0])
    data = [dict(d, seq=i) for i, (_, d) in enumerate(rows)]
    table = pa.table({f.name: pa.array([d[f.name] for d in data], type=_ARROW_TYPES[f.dataType.typeName()])
                      for f in schema.fields})
    return spark.createDataFrame(table, schema)


_LAZY_SCHEMA = StructType(METRICS_SCHEMA.fields + [StructField("rule_index", LongType(), False)])


def _lazy_metrics(spark: SparkSession, resolver: TableResolver, work: list[list[RuleGroup]],
                  sizes: tuple[int, int]) -> DataFrame:
    """Metrics relation as one plan: per-rule rows of every table's aggregates, merged
    by rule (a group-by over one row per rule and query), joined to the rule rows."""
    done, frames = [], []
    for groups in work:
        base, plans, live = _plan_table(resolver, groups)
        done.append(plans)
        if live:
            frames += _lazy_counts(base, live, sizes)
    meta = _metrics_frame(spark, done, _LAZY_SCHEMA)
    if not frames:
        return meta.drop("rule_index")
    counts = (reduce(DataFrame.unionByName, frames).groupBy("rule_index")
              .agg(F.max("total").alias("c_total"), F.max("passed").alias("c_passed"),
                   F.max("denom").alias("c_denom"), F.max("value").alias("c_value"), F.max("errors").alias("c_errors")))
    before, after = _row_errors("\n").split("\n")
    merged = meta.join(counts, "rule_index", "left").withColumns({
        "total": F.coalesce("c_total", "total"),
        "passed": F.coalesce("c_passed", "passed"),
        "denom": F.coalesce("c_denom", "denom"),
        "value": F.coalesce("c_value", "value"),
        "outcome": F.when(F.col("c_errors") > 0, F.lit(UNRESOLVED)).otherwise(F.col("outcome")),
        "message": F.when(F.col("c_errors") > 0, F.concat(F.lit(before), F.col("c_errors").cast("string"), F.lit(after))).otherwise(F.col("message")),
    })
    return merged.select(*METRICS_SCHEMA.fieldNames()).orderBy("seq")


def assemble(metrics: DataFrame, *, policy: str = "strict", as_of: _dt.datetime | None = None,
             wide: bool = False, stamps: bool = True) -> DataFrame:
    """Metrics relation -> result table (the 11 columns; ``wide`` adds schema, rule
    code and dimension; ``stamps=False`` leaves the run date and time out)."""
    res = classify(metrics, policy)
    if as_of is None:
        periodo, fecha = F.current_date(), F.current_timestamp()
    else:
        # from text, so the stamp reads the same in any session time zone
        periodo = F.to_date(F.lit(as_of.date().isoformat()))
        fecha = F.to_timestamp(F.lit(as_of.isoformat(sep=" ")))
    res = res.withColumns({"periodo": periodo, "fecha_proceso": fecha})
    cols = list(RESULT_COLUMNS if stamps else RESULT_BODY_COLUMNS)
    if wide:
        res = res.withColumns({"coleccion": F.col("schema"), "id_calidad_regla": F.col("rule_code")})
        cols += WIDE_COLUMNS
    return res.select(*cols)


def run_rules(
    spark: SparkSession,
    rules: DataFrame,
    catalog: DataFrame | None = None,
    *,
    dataset: str | None = None,
    tables: Mapping[str, TableSource] | None = None,
    policy: str = "strict",
    as_of: _dt.datetime | None = None,
    wide: bool = False,
    stamps: bool = True,
    fuse_filters: bool = True,
    parallelism: int = 4,
    cache: bool = False,
    eager: bool = True,
    aggs_per_scan: int = AGGS_PER_SCAN,
    unique_per_query: int = UNIQUE_PER_QUERY,
    key_bitmaps: bool = False,
) -> DataFrame:
    """Check a table's data against its rules: one result row per active rule.

    ``rules``: the rule table (``id_calidad_tabla, coleccion, nombre_columna,
    id_calidad_regla, parametros, filtros, estado, umbral`` ...). ``catalog``: the
    method catalog (``id_calidad_regla, dimension, descripcion, metodo``); without
    it every rule is ``NO_EVALUADA``. ``dataset``: only rules of this table.
    ``tables``: DataFrames by ``schema.table`` or ``table`` name, instead of the
    session catalog. ``policy``: ``"strict"`` (every row must pass) or
    ``"threshold"`` (percentage >= ``umbral``). ``as_of``: fixed run stamp.
    ``eager=False`` returns an unexecuted plan that checks all tables in one job
    (see :func:`evaluate_rules`, also for the other options).
    """
    metrics = evaluate_rules(spark, rules, catalog, dataset=dataset, tables=tables,
                             fuse_filters=fuse_filters, parallelism=parallelism, cache=cache,
                             eager=eager, aggs_per_scan=aggs_per_scan, unique_per_query=unique_per_query,
                             key_bitmaps=key_bitmaps)
    return assemble(metrics, policy=policy, as_of=as_of, wide=wide, stamps=stamps)


def verification_report(spark: SparkSession, rules: DataFrame, catalog: DataFrame | None = None,
                        **kwargs) -> tuple[DataFrame, DataFrame]:
    """The run as (metric report, check outcomes), the two relations of a verification run."""
    metrics = evaluate_rules(spark, rules, catalog, **kwargs)
    return metric_report(metrics), check_outcomes(metrics)
