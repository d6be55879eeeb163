"""Small helpers shared by the tests."""

from __future__ import annotations

from qualia import run_rules
from sample import RULE_DDL, RULE_FIELDS, rule


def rules_df(spark, rules):
    return spark.createDataFrame([tuple(r.get(f) for f in RULE_FIELDS) for r in rules], RULE_DDL)


def run(spark, rules, catalog, tables, **kw):
    """Result rows (dicts, body columns) of a run over literal tables."""
    kw.setdefault("stamps", False)
    res = run_rules(spark, rules_df(spark, rules), catalog, tables=tables, **kw)
    return [r.asDict() for r in res.collect()]


def one(spark, column, code, params, catalog, df, **kw):
    """Result row of a single rule on ``df`` (table ``t``)."""
    r = rule(column, code, params, kw.pop("threshold", 100.0), table="t", schema=None,
             filters=kw.pop("filters", ""))
    rows = run(spark, [r], catalog, {"t": df}, **kw)
    assert len(rows) == 1
    return rows[0]
