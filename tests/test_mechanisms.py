"""Guarded predicates, aggregate checks, key bitmaps and sinks that keep the last result."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from qualia import run_rules
from qualia.operators.checks import AGGREGATE, ROW, Check, register_check
from qualia.operators.metrics import RowGroup, UniqueSpec, bitmap_metrics, dense_keys, guarded, row_metrics, unique_metrics
from qualia.plans import engine
from qualia.sources import read_result_csv, save_table, write_result_csv

RULES = "id_calidad_tabla string, nombre_columna string, id_calidad_regla string, parametros string, filtros string, estado boolean, umbral double"


def rules_of(spark, rows):
    return spark.createDataFrame([("t", c, code, p, f, True, 100.0) for c, code, p, f in rows], RULES)


def catalog_of(spark, *methods):
    return spark.createDataFrame([(m, "d", "x", f"{m}()") for m in methods], "id_calidad_regla string, dimension string, descripcion string, metodo string")


# --- predicates that raise errors -------------------------------------------------------
@pytest.mark.parametrize("predicate, want", [
    ("x / y > 1", [True, False, None, False]), ("CAST(s AS INT) > 2", [None, True, False, False]), ("x + 2147483647 > 0", [None, None, None, False]),
    ("element_at(array(1, 2), coalesce(x, 1)) > 0", [None, True, True, True]), ("x > 1", [True, True, False, False]), ("raise_error('q') IS NULL", [None] * 4)])
def test_guard_tells_errors_from_failures(spark, predicate, want):
    df = spark.createDataFrame([(3, 2, "a"), (2, 2, "3"), (1, 0, "1"), (None, 1, None)], "x int, y int, s string").coalesce(1)
    got = [r[0] for r in df.select(guarded(F.expr(predicate), F.lit(True))).collect()]
    assert [None if g is None else g.total_seconds() == 1 for g in got] == want


@pytest.mark.parametrize("eager", [True, False])
def test_failing_rows_end_their_rule_alone(spark, eager):
    df = spark.createDataFrame([(i, i % 5, "x" if i == 7 else str(i)) for i in range(100)], "a int, b int, s string")
    rules = rules_of(spark, [("a", "satisfies", "a / b >= 0", ""), ("a", "satisfies", "a >= 0", ""), ("s", "satisfies", "CAST(s AS INT) >= 0", ""),
                             ("a", "satisfies", "a / b >= 0", "b > 0"), ("a", "between", "0, a / b", ""), ("a", "iscomplete", "", "")])
    got = run_rules(spark, rules, catalog_of(spark, "satisfies", "between", "iscomplete"), tables={"t": df}, eager=eager).collect()
    state = [(r.parametros, r.estado_calidad, r.total_registros) for r in got]
    assert state[:3] == [("a / b >= 0", "NO_EVALUADA", 100), ("a >= 0", "CUMPLE", 100), ("CAST(s AS INT) >= 0", "NO_EVALUADA", 100)]
    assert ("a / b >= 0", "CUMPLE", 80) in state and ("0, a / b", "NO_EVALUADA", 100) in state and ("", "CUMPLE", 100) in state
    text = {(r.parametros, r.total_registros): r.observacion_tecnica for r in got}
    assert "20 fila(s)" in text["a / b >= 0", 100] and "1 fila(s)" in text["CAST(s AS INT) >= 0", 100]


def test_failing_rows_need_no_second_scan(spark, monkeypatch):
    df = spark.createDataFrame([(1, 0), (2, 1)], "a int, b int")
    runs = []
    monkeypatch.setattr(engine, "row_metrics", lambda *a: runs.append(1) or row_metrics(*a))
    # the rules share a / b, which Spark would else compute once, ahead of all of them
    rules = rules_of(spark, [("a", "satisfies", f"a / b > {k}", "") for k in range(6)] + [("a", "iscomplete", "", "")])
    got = run_rules(spark, rules, catalog_of(spark, "satisfies", "iscomplete"), tables={"t": df}).collect()
    assert [r.estado_calidad for r in got] == ["NO_EVALUADA"] * 6 + ["CUMPLE"]
    assert len(runs) == 1


def test_predicates_of_tables_need_no_column(spark):
    df = spark.createDataFrame([("a", {"k": 1}, [1]), (None, None, None)], "s string, m map<string,int>, l array<int>")
    rules = rules_of(spark, [(c, "satisfies", "1 / size(l) > 0", "") for c in ("whole table", "s", "m", "l")])
    got = run_rules(spark, rules, catalog_of(spark, "satisfies"), tables={"t": df}).collect()
    assert [(r.estado_calidad, r.registros_fallidos) for r in got] == [("NO_CUMPLE", 1)] * 4


# --- aggregate checks --------------------------------------------------------------------
def _range_check(ctx):
    return Check(AGGREGATE, ctx.column, "Range", ctx.params, aggregates={"lo": f"min({ctx.column})", "hi": f"max({ctx.column})"},
                 finish=lambda a: F.when(a["hi"] - a["lo"] <= F.lit(float(ctx.params)), 1.0).when(a["hi"].isNotNull(), 0.0))


@pytest.mark.parametrize("eager", [True, False])
def test_aggregate_checks(spark, eager):
    register_check("rangeatmost", _range_check)
    register_check("nanmetric", lambda ctx: Check(AGGREGATE, ctx.column, "M", "m", aggregates={"s": f"sum({ctx.column})"}, finish=lambda a: a["s"] * F.lit(float("nan"))))
    df = spark.createDataFrame([(i, i % 3, None) for i in range(50)], "a int, b int, c int")
    rules = rules_of(spark, [("a", "rangeatmost", "49", ""), ("a", "rangeatmost", "48", ""), ("b", "rangeatmost", "0", "b = 1"), ("a", "rangeatmost", "48", "b = 7"),
                             ("nope", "rangeatmost", "1", ""), ("c", "rangeatmost", "1", ""), ("a", "nanmetric", "", ""), ("a", "iscomplete", "", "b = 1")])
    got = run_rules(spark, rules, catalog_of(spark, "rangeatmost", "nanmetric", "iscomplete"), tables={"t": df}, eager=eager).collect()
    state = {(r.columna, r.parametros, r.total_registros): (r.estado_calidad, r.registros_fallidos) for r in got}
    assert state["a", "49", 50] == ("CUMPLE", 0) and state["a", "48", 50] == ("NO_CUMPLE", 50)
    assert state["b", "0", 17] == ("CUMPLE", 0) and state["a", "48", 0] == ("CUMPLE", 0)
    assert state["nope", "1", 50][0] == state["c", "1", 50][0] == state["a", "", 50][0] == "NO_EVALUADA"
    assert state["a", "", 17] == ("CUMPLE", 0)


def test_aggregate_checks_share_the_scan(spark):
    df = spark.range(1000).withColumn("b", F.col("id") % 7)
    ctx = type("C", (), {"column": "id", "params": "10"})
    plan = row_metrics(df, [RowGroup(F.expr("b > 1"), [_range_check(ctx), Check(ROW, "b", "", "", F.expr("b < 5"))], "b > 1")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (0, 1000") == 1
    assert plan.collect()[0].asDict() == {"__n0": 714, "__v0_0": 0.0, "__p0_1": 429, "__e0_1": 0}


def test_chunks_hold_every_rule_once(spark):
    wide = Check(AGGREGATE, "w", "", "", aggregates={f"x{i}": "count(1)" for i in range(9)}, finish=lambda a: a["x0"])
    slow, fast = Check(ROW, "s", "", "", F.lit(True)), Check(ROW, "f", "", "", F.lit(True), fallible=False)
    plans = [engine._Planned(None, None, row=[(k, c) for k, c in enumerate([wide, slow, fast] * 7)]), engine._Planned(None, None), engine._Planned(None, None, row=[(99, wide)])]
    for most in (2, 3, 5, 10, 40):
        chunks = engine._chunks(plans, most)
        seen = [(id(p), k) for chunk in chunks for p, items in chunk for k, _ in items]
        assert len(seen) == len(set(seen)) == 22 and {id(p) for chunk in chunks for p, _ in chunk} == {id(p) for p in plans}
        assert all(sum(1 + sum(engine.weight(c) for _, c in items) for _, items in chunk) <= max(most, 10) for chunk in chunks)


# --- key bitmaps ------------------------------------------------------------------------
def test_bitmaps_equal_grouping(spark):
    df = spark.range(200_000).select(
        F.col("id").alias("dense"), (F.col("id") - 100_000).alias("around_zero"), F.when(F.col("id") % 1000 == 5, F.col("id") - 1).otherwise(F.col("id")).cast("int").alias("doubled"),
        (F.col("id") * 1_000_003).alias("sparse"), F.expr("date_add(DATE '1970-01-01', cast(id % 5000 as int))").alias("day"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("half"),
        F.lit(None).cast("long").alias("none"), F.col("id").cast("string").alias("text"))
    specs = [UniqueSpec(c, f) for c in df.columns[:7] for f in (None, F.expr("dense % 3 = 0"))]
    for s in specs:
        a, b = bitmap_metrics(df, s).collect()[0], unique_metrics(df, [s]).collect()[0]
        assert tuple(a) == tuple(b), s.column
    got = dense_keys(df, [UniqueSpec(c) for c in df.columns])
    names = [df.columns[j] for j in got]
    assert "dense" in names and "doubled" in names and "around_zero" in names
    assert not {"sparse", "none", "text"} & set(names)


def test_bitmaps_move_less_than_a_tenth_of_the_keys(spark):
    df = spark.range(0, 1_000_000, 1, 4).withColumnRenamed("id", "k")
    assert dense_keys(df, [UniqueSpec("k")]) == [0]
    stretches = df.groupBy(F.spark_partition_id(), F.bitmap_bucket_number("k")).count().count()  # what the tasks send on
    assert stretches * (4096 + 24) < 1_000_000 * 8 / 10
    assert tuple(bitmap_metrics(df, UniqueSpec("k")).collect()[0]) == (1_000_000, 1_000_000)


# --- sinks ------------------------------------------------------------------------------
def _bad(spark):
    return spark.range(10, numPartitions=2).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("long")).alias("v"))


def test_failed_table_write_keeps_the_old_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE keep_db LOCATION 'file://{tmp_path}/db'")
    try:
        save_table(spark.range(3).withColumnRenamed("id", "v"), "keep_db", "r")
        with pytest.raises(Exception, match="stop"):
            save_table(_bad(spark), "keep_db", "r")
        assert sorted(r.v for r in spark.table("keep_db.r").collect()) == [0, 1, 2]
        save_table(spark.table("keep_db.r").selectExpr("v * 2 AS w"), "keep_db", "r")  # reads what it replaces, other columns
        assert sorted(r.w for r in spark.table("keep_db.r").collect()) == [0, 2, 4]
        assert [t.name for t in spark.catalog.listTables("keep_db")] == ["r"]
    finally:
        spark.sql("DROP DATABASE keep_db CASCADE")


def test_failed_csv_write_keeps_the_old_files(spark, catalog, tmp_path):
    res = run_rules(spark, rules_of(spark, [("a", "COM_NULOS", "", "")]), catalog, tables={"t": spark.createDataFrame([(1,)], "a int")})
    path = f"file://{tmp_path}/out"
    write_result_csv(res, path)
    with pytest.raises(Exception, match="stop"):
        write_result_csv(res.withColumn("umbral", F.raise_error(F.lit("stop")).cast("double")), path)
    assert read_result_csv(spark, path).count() == 1 and glob.glob(f"{tmp_path}/*") == [f"{tmp_path}/out"]
    write_result_csv(res.union(res), path)
    assert read_result_csv(spark, path).count() == 2 and os.listdir(tmp_path) == ["out"]


# --- ranges of text under bounds of any width ---------------------------------------------
@pytest.mark.parametrize("bounds, inside", [
    ("0,10000000000000000000000000", {"10000000000000000000000", "0", "7.25"}),
    ("0.000000000000000000000000000001, 9", {"7.25"}),
    ("0.000000000000000000000000000001, 100000000000000000000000000", {"10000000000000000000000", "7.25"}),
    ("-99999999999999999999999999999999999999, 0", {"0", "-3"}),
    ("0, 1e30", {"10000000000000000000000", "0", "7.25"})])
def test_text_between_wide_bounds(spark, bounds, inside):
    values = ["10000000000000000000000", "0", "7.25", "-3", "abc", "", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    ctx_rules = rules_of(spark, [("s", "between", bounds, f"s <=> {'NULL' if v is None else repr(v)}") for v in values])
    got = run_rules(spark, ctx_rules, catalog_of(spark, "between"), tables={"t": df}).collect()
    state = [r.estado_calidad == "CUMPLE" for r in got]
    assert {v for v, ok in zip(values, state) if ok} == inside
