"""Rule table: standardize, attach the catalog, keep the active rules, group them.

The rule table is configuration (one row per rule, independent of the data size).
It is read once; its rows then steer one Spark job or two per checked table.
"""

from __future__ import annotations

import warnings
from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.functions.text import quote_ident, split_params_col
from qualia.schema import REQUIRED_RULE_COLUMNS, RULE_COLUMNS
from qualia.sources.catalog import standardize_catalog


def standardize_rules(rules: DataFrame, *, with_seq: bool = True) -> DataFrame:
    """Trim the text columns, read ``estado`` as boolean and ``umbral`` as double,
    and give the standard names. Unreadable flags or thresholds become NULL
    (``try_cast``), so one bad row does not stop a run. Optional columns that are
    missing come out NULL; ``seq`` keeps the input order.
    """
    present = set(rules.columns)
    missing = [c for c in REQUIRED_RULE_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"rule table lacks column(s): {', '.join(missing)}")

    def src(name: str):
        return F.col(quote_ident(name)) if name in present else F.lit(None)

    out = []
    for name, std in RULE_COLUMNS:
        if std == "is_active":
            out.append(src(name).try_cast("boolean").alias(std))
        elif std == "threshold":
            out.append(src(name).try_cast("double").alias(std))
        else:
            out.append(F.trim(src(name).cast("string")).alias(std))
    std = rules.select(*out)
    return number_rules(std) if with_seq else std


def number_rules(rules: DataFrame) -> DataFrame:
    """Add ``seq``, the input order. Number after filtering where both are wanted: a
    filter is not pushed below the numbering."""
    return rules.withColumn("seq", F.monotonically_increasing_id())


def param_list(rules: DataFrame) -> DataFrame:
    """Standardized rules plus ``param_list``: the comma list of the parameters."""
    return rules.withColumn("param_list", split_params_col(F.col("params")))


def join_catalog(rules: DataFrame, catalog: DataFrame | None) -> DataFrame:
    """Left join of the rules with the standardized catalog on the rule code.

    A rule whose code is not in the catalog (or with no catalog at all) keeps a
    NULL method. Both sides are small control tables; the join strategy is left to
    the optimizer, which broadcasts by measured size.
    """
    spark = rules.sparkSession
    if catalog is None:
        from qualia.sources.catalog import empty_catalog
        catalog = empty_catalog(spark)
    cat = standardize_catalog(catalog)
    return rules.join(cat, rules["rule_code"] == cat["id_calidad_regla"], "left")


def active_rules(rules: DataFrame, dataset: str | None = None) -> DataFrame:
    """Rules whose flag is TRUE (NULL counts as inactive), of one table if given."""
    cond = F.col("is_active") == F.lit(True)
    if dataset:
        cond = cond & (F.col("table_name") == F.lit(dataset))
    return rules.where(cond)


@dataclass
class Rule:
    """One active rule on the driver, in the order of the rule table."""

    index: int
    table_name: str | None
    schema: str | None
    column_name: str | None
    rule_code: str | None
    params: str | None
    filters: str | None
    threshold: float | None
    metodo: str | None
    method_key: str | None
    dimension: str | None
    param_list: list[str] = field(default_factory=list)


@dataclass
class RuleGroup:
    """Rules that share (schema, table, row filter)."""

    index: int
    schema: str | None
    table_name: str | None
    filter: str
    rules: list[Rule] = field(default_factory=list)


_RULE_FIELDS = ["table_name", "schema", "column_name", "rule_code", "params", "filters",
                "threshold", "metodo", "method_key", "dimension"]


def collect_rules(plan: DataFrame) -> list[Rule]:
    """Bring the (small) active rule set to the driver, in rule-table order.

    A rule code listed twice in the catalog makes its rules appear twice (left
    join); they are kept, as the join says, and a warning names the codes."""
    rows = param_list(plan).select("seq", *_RULE_FIELDS, "param_list").collect()
    rows = sorted(rows, key=lambda r: r["seq"])
    seen, doubled = set(), set()
    for r in rows:
        (doubled if r["seq"] in seen else seen).add(r["seq"])
    if doubled:
        codes = sorted({r["rule_code"] for r in rows if r["seq"] in doubled})
        warnings.warn(f"rule codes listed more than once in the catalog: {', '.join(codes)}", stacklevel=2)
    return [Rule(i, *[r[f] for f in _RULE_FIELDS], r["param_list"]) for i, r in enumerate(rows)]


def group_rules(rules: list[Rule]) -> list[RuleGroup]:
    """Group by (schema, table, filter), a NULL filter being ``''``; groups keep the
    order of their first rule."""
    groups: OrderedDict[tuple, RuleGroup] = OrderedDict()
    for r in rules:
        key = (r.schema, r.table_name, r.filters or "")
        if key not in groups:
            groups[key] = RuleGroup(len(groups), r.schema, r.table_name, r.filters or "")
        groups[key].rules.append(r)
    return list(groups.values())
