"""Physical plans: one scan per query, pruned columns, filters pushed to the scan."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from qualia.operators.checks import build_check
from qualia.operators.metrics import RowGroup, UniqueSpec, row_metrics, unique_metrics

SF = "/root/testdata/sf0.001"


def scans(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", text, re.M))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_row_level_checks_share_one_pruned_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    preds = [build_check("iscomplete", li, "l_orderkey", "").predicate,
             build_check("between", li, "l_quantity", "5,45", param_list=["5", "45"]).predicate,
             build_check("iscontainedin", li, "l_returnflag", "A,N", param_list=["A", "N"]).predicate]
    groups = [RowGroup(F.expr("l_linestatus = 'O'"), preds), RowGroup(F.expr("l_linestatus = 'F'"), preds[:1])]
    text = plan_text(row_metrics(li, groups))
    assert scans(text) == 1
    assert "Expand" not in text
    schema_line = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    for c in ("l_orderkey", "l_quantity", "l_returnflag", "l_linestatus"):
        assert c in schema_line
    assert "l_extendedprice" not in schema_line and "l_shipdate" not in schema_line
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "Or(EqualTo(l_linestatus,O),EqualTo(l_linestatus,F))" in pushed
    # only one shuffle: the partial counts to a single partition
    assert text.count("Exchange (") == 1 and "SinglePartition" in text


def test_uniqueness_of_many_columns_is_one_scan_and_one_shuffle_by_value(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    specs = [UniqueSpec("o_orderkey"), UniqueSpec("o_custkey"),
             UniqueSpec("o_orderstatus", F.expr("o_totalprice > 1000"))]
    text = plan_text(unique_metrics(o, specs))
    assert scans(text) == 1
    assert "Expand" in text
    assert text.count("hashpartitioning") == 1
    schema_line = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "o_orderdate" not in schema_line and "o_orderpriority" not in schema_line


def test_single_uniqueness_is_a_plain_group_by(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan_text(unique_metrics(o, [UniqueSpec("o_custkey")]))
    assert "Expand" not in text and scans(text) == 1
    assert "IsNotNull(o_custkey)" in text


def test_checks_stay_in_whole_stage_codegen(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    preds = [build_check("haspattern", li, "l_returnflag", "^[AR]$").predicate,
             build_check("notnullorempty", li, "l_linestatus", "").predicate]
    buf = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the codegen stage marks
    try:
        with contextlib.redirect_stdout(buf):
            row_metrics(li, [RowGroup(None, preds)]).explain()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    text = buf.getvalue()
    assert "*(1) HashAggregate" in text or "*(1) Project" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_pattern_with_required_literal_is_guarded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pred = build_check("haspattern", docs, "text", r"[a-z]+@[a-z]+\.[a-z]{2,}").predicate
    text = plan_text(docs.select(pred))
    assert "Contains(text, @)" in text or "contains(text, @)" in text.lower()


def test_uniqueness_filters_reach_the_scan(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan_text(unique_metrics(o, [UniqueSpec("o_custkey", F.expr("o_orderstatus = 'F'")),
                                        UniqueSpec("o_orderkey")]))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert "EqualTo(o_orderstatus,F)" in pushed and "IsNotNull(o_orderkey)" in pushed
