"""Cases the sample does not exercise (FIXTURES.md section 5)."""

import pytest

from helpers import one, run
from sample import rule


def _df(spark, values, ddl="v string"):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_not_blank(spark, catalog):
    df = _df(spark, [None, "", "   ", "\t", "text"])
    r = one(spark, "v", "COM_OBLIGATORIO", "", catalog, df)
    assert (r["total_registros"], r["registros_fallidos"]) == (5, 3)


@pytest.mark.parametrize("code,params,ddl,value,passes", [
    ("VAL_PERMITIDOS", "a,b", "v string", "a", True),
    ("VAL_POSITIVOS", "", "v double", 1.0, True),
    ("COM_NULOS", "", "v string", "a", False),
    ("CONF_REGEX", "a", "v string", "a", False),
    ("VAL_RANGO_VALORES", "0,10", "v double", 1.0, False),
    ("CONF_LONG_EXACTA", "1", "v string", "a", False),
    ("COM_OBLIGATORIO", "", "v string", "a", False),
])
def test_null_rule_per_check(spark, catalog, code, params, ddl, value, passes):
    df = _df(spark, [value, None], ddl)
    r = one(spark, "v", code, params, catalog, df)
    assert r["registros_fallidos"] == (0 if passes else 1), r


def test_uniqueness_leaves_nulls_out_of_the_metric(spark, catalog):
    r = one(spark, "v", "COM_DUPLICADOS", "", catalog, _df(spark, ["a", "a", "b", None]))
    assert r["porcentaje_cumplimiento"] == pytest.approx(100 / 3)
    assert r["registros_fallidos"] == 3  # half-even round of 4 * 2/3
    assert r["estado_calidad"] == "NO_CUMPLE"


def test_failing_rounds_half_to_even(spark, catalog):
    # total 3, metric 1/2 -> 1.5 failing rows -> 2; total 5, metric 1/2 -> 2.5 -> 2
    r3 = one(spark, "v", "COM_DUPLICADOS", "", catalog, _df(spark, ["a", "b", "b"]))
    assert r3["registros_fallidos"] == 2
    r5 = one(spark, "v", "COM_DUPLICADOS", "", catalog, _df(spark, ["a", "b", "c", "c", None]))
    assert (r5["total_registros"], r5["registros_fallidos"]) == (5, 2)


def test_empty_after_filter(spark, catalog):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for code in ("COM_NULOS", "COM_DUPLICADOS"):
        r = one(spark, "v", code, "", catalog, df, filters="k > 5")
        assert (r["estado_calidad"], r["porcentaje_cumplimiento"], r["total_registros"],
                r["registros_fallidos"]) == ("CUMPLE", 100.0, 0, 0)
        assert r["observacion_tecnica"] == "Sin registros tras aplicar filtros; regla considerada cumplida."


def test_all_null_column_uniqueness_is_not_evaluated(spark, catalog):
    r = one(spark, "v", "COM_DUPLICADOS", "", catalog, _df(spark, [None, None]))
    assert r["estado_calidad"] == "NO_EVALUADA"
    assert r["registros_fallidos"] == 2 and r["porcentaje_cumplimiento"] == 0.0


def test_inactive_and_null_flag_give_no_row(spark, catalog):
    df = _df(spark, ["a"])
    rules = [rule("v", "COM_NULOS", table="t", schema=None, active=False),
             rule("v", "COM_NULOS", table="t", schema=None, active=None),
             rule("v", "COM_DUPLICADOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    assert len(rows) == 1


def test_no_active_rules_gives_empty_result(spark, catalog):
    from qualia import RESULT_SCHEMA, run_rules
    from helpers import rules_df

    res = run_rules(spark, rules_df(spark, [rule("v", "COM_NULOS", active=False)]), catalog)
    assert res.count() == 0
    assert res.schema.fieldNames() == RESULT_SCHEMA.fieldNames()


def test_unknown_method_and_unknown_code(spark, catalog):
    from qualia import default_catalog

    cat = default_catalog(spark, [("VAL_RARO", "validez", "x", "isPositive()")])
    df = _df(spark, ["a", "b", None])
    rows = run(spark, [rule("v", "VAL_RARO", table="t", schema=None),
                       rule("v", "NO_EXISTE", table="t", schema=None)], cat, {"t": df})
    assert [r["observacion_tecnica"] for r in rows] == [
        "Método 'isPositive()' no soportado", "Método 'None' no soportado"]
    assert all(r["estado_calidad"] == "NO_EVALUADA" and r["registros_fallidos"] == 3
               and r["total_registros"] == 3 for r in rows)


@pytest.mark.parametrize("code,params,method", [
    ("VAL_RANGO_VALORES", "1", "between()"),
    ("VAL_RANGO_VALORES", "1,2,3", "between()"),
    ("VAL_PERMITIDOS", " , ", "isContainedIn()"),
    ("CONF_REGEX", "", "hasPattern()"),
    ("COM_BLANCOS", "", "hasPattern()"),
    ("CONF_LONG_EXACTA", "abc", "lengthEquals()"),
])
def test_invalid_parameters(spark, catalog, code, params, method):
    r = one(spark, "v", code, params, catalog, _df(spark, ["a"]))
    assert r["estado_calidad"] == "NO_EVALUADA"
    assert r["observacion_tecnica"] == f"Parámetros inválidos para el método {method}."


def test_missing_table_and_bad_filter(spark, catalog):
    df = _df(spark, ["a"])
    rules = [rule("v", "COM_NULOS", table="no_such_table_xyz", schema="no_db"),
             rule("v", "COM_NULOS", table="t", schema=None, filters="nope > 1"),
             rule("v", "COM_NULOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    err = [r for r in rows if r["estado_calidad"] == "ERROR_EJECUCION"]
    assert len(err) == 2
    for r in err:
        assert (r["total_registros"], r["registros_fallidos"], r["porcentaje_cumplimiento"]) == (0, 0, 0.0)
        assert r["observacion_tecnica"].startswith("Error fatal procesando ")
        assert len(r["observacion_tecnica"]) <= 250
    assert [r["estado_calidad"] for r in rows if r not in err] == ["CUMPLE"]


def test_broken_rule_beside_good_ones(spark, catalog):
    df = spark.createDataFrame([("a", 1), ("b", -1)], "v string, n int")
    rules = [rule("v", "COM_NULOS", table="t", schema=None),
             rule("no_such_column", "COM_NULOS", table="t", schema=None),
             rule("no_such_column", "COM_DUPLICADOS", table="t", schema=None),
             rule("n", "VAL_POSITIVOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    assert [r["estado_calidad"] for r in rows] == ["CUMPLE", "NO_EVALUADA", "NO_EVALUADA", "NO_CUMPLE"]
    assert rows[3]["registros_fallidos"] == 1


def test_invalid_regex_fails_alone(spark, catalog):
    df = _df(spark, ["abc", "x"])
    rules = [rule("v", "CONF_REGEX", "[a-", table="t", schema=None),
             rule("v", "CONF_REGEX", "^a", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    assert rows[0]["estado_calidad"] == "NO_EVALUADA"
    assert "regexp" in rows[0]["observacion_tecnica"] or "pattern" in rows[0]["observacion_tecnica"].lower()
    assert rows[1]["registros_fallidos"] == 1


def test_runtime_error_is_pinned_to_its_rule(spark, catalog):
    # division by zero raises at run time under ANSI mode: the fused job fails, the
    # engine re-runs rule by rule and only the faulty rule is set aside
    df = spark.createDataFrame([(1, 0), (2, 1)], "a int, b int")
    rules = [rule("a", "COM_PREDICADO", "a / b > 0", table="t", schema=None),
             rule("a", "COM_NULOS", table="t", schema=None),
             rule("b", "VAL_POSITIVOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    assert rows[0]["estado_calidad"] == "NO_EVALUADA"
    assert [r["estado_calidad"] for r in rows[1:]] == ["CUMPLE", "CUMPLE"]
    assert rows[1]["total_registros"] == 2


def test_two_rules_on_one_column_and_name_inside_another(spark, catalog):
    df = spark.createDataFrame([("a", "a"), ("b", "z"), ("c", "z")], "code string, code_ext string")
    rules = [rule("code", "VAL_PERMITIDOS", "a", table="t", schema=None),
             rule("code", "VAL_PERMITIDOS", "a,b", table="t", schema=None),
             rule("code_ext", "VAL_PERMITIDOS", "z", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df})
    assert [r["registros_fallidos"] for r in rows] == [2, 1, 1]


def test_pattern_matching_the_empty_string_fails(spark, catalog):
    r = one(spark, "v", "CONF_REGEX", "^x*", catalog, _df(spark, ["abc", "xyz"]))
    assert r["registros_fallidos"] == 1


def test_type_mismatch_under_ansi(spark, catalog):
    nums = spark.createDataFrame([(1.0,), (2.0,), (None,)], "v double")
    r = one(spark, "v", "VAL_PERMITIDOS", "1.0,x", catalog, nums)
    assert r["registros_fallidos"] == 1           # compared as text: '2.0' is not listed
    texts = _df(spark, ["150", "abc", "999", None])
    r = one(spark, "v", "VAL_RANGO_VALORES", "100,500", catalog, texts)
    assert r["registros_fallidos"] == 3           # 'abc' and NULL fail, no error
    r = one(spark, "v", "VAL_POSITIVOS", "", catalog, _df(spark, ["-1", "abc", "5"]))
    assert r["registros_fallidos"] == 1           # unreadable text passes, as NULL does


def test_date_bounds_in_quotes(spark, catalog):
    df = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-06-01', DATE'2025-01-01')) AS d")
    r = one(spark, "d", "VAL_RANGO_VALORES", "'2024-01-01','2024-12-31'", catalog, df)
    assert r["registros_fallidos"] == 1


def test_odd_column_name(spark, catalog):
    df = spark.createDataFrame([("a",), (None,)], "`odd name.x` string")
    r = one(spark, "odd name.x", "COM_NULOS", "", catalog, df)
    assert r["registros_fallidos"] == 1


def test_rounding_of_percentage_text(spark, catalog):
    # 31 of 32 rows fail -> 3.125 % passes -> shown as 3.12 (binary value, ties to even)
    df = _df(spark, ["ok"] + ["bad"] * 31)
    r = one(spark, "v", "VAL_PERMITIDOS", "ok", catalog, df, threshold=50.0)
    assert r["porcentaje_cumplimiento"] == 3.125
    assert "Solo el 3.12% " in r["observacion_tecnica"]


def test_threshold_policy(spark, catalog):
    df = _df(spark, ["a"] * 9 + ["b"])
    strict = one(spark, "v", "VAL_PERMITIDOS", "a", catalog, df, threshold=80.0)
    lenient = one(spark, "v", "VAL_PERMITIDOS", "a", catalog, df, threshold=80.0, policy="threshold")
    above = one(spark, "v", "VAL_PERMITIDOS", "a", catalog, df, threshold=95.0, policy="threshold")
    assert strict["estado_calidad"] == "NO_CUMPLE"
    assert lenient["estado_calidad"] == "CUMPLE"
    assert above["estado_calidad"] == "NO_CUMPLE"


def test_no_catalog(spark):
    df = _df(spark, ["a", "b"])
    rows = run(spark, [rule("v", "COM_NULOS", table="t", schema=None)], None, {"t": df})
    assert rows[0]["estado_calidad"] == "NO_EVALUADA"
    assert rows[0]["observacion_tecnica"] == "Método 'None' no soportado"
    assert rows[0]["registros_fallidos"] == 2


@pytest.mark.parametrize("opts", [{"fuse_filters": False}, {"parallelism": 1}, {"cache": True},
                                  {"eager": False}])
def test_execution_options_do_not_change_results(spark, catalog, opts):
    df = spark.createDataFrame([(i, i % 3, None if i % 5 == 0 else f"v{i % 7}") for i in range(50)],
                               "k int, g int, v string")
    df2 = spark.createDataFrame([(i,) for i in range(10)], "k int")
    rules = [rule("v", "COM_NULOS", table="t", schema=None),
             rule("v", "COM_DUPLICADOS", table="t", schema=None, filters="g = 1"),
             rule("v", "VAL_PERMITIDOS", "v1,v2", table="t", schema=None, filters="g = 1"),
             rule("k", "VAL_RANGO_VALORES", "5,40", table="t", schema=None, filters="g = 2"),
             rule("v", "COM_DUPLICADOS", table="t", schema=None),
             rule("k", "COM_DUPLICADOS", table="u", schema=None),
             rule("nope", "COM_NULOS", table="t", schema=None),
             rule("k", "NO_EXISTE", table="t", schema=None),
             rule("k", "COM_NULOS", table="missing_table", schema=None),
             rule("k", "COM_NULOS", table="t", schema=None, filters="g = 9")]
    base = run(spark, rules, catalog, {"t": df, "u": df2})
    other = run(spark, rules, catalog, {"t": df, "u": df2}, **opts)
    assert base == other


def test_bisection_finds_every_faulty_rule(spark, catalog):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "a int, b int")
    rules = [rule("a", "COM_NULOS", table="t", schema=None)]
    rules += [rule("a", "COM_PREDICADO", f"a + {i} > 0", table="t", schema=None) for i in range(6)]
    rules.insert(3, rule("a", "COM_PREDICADO", "a / b > 0", table="t", schema=None))
    rules.append(rule("a", "COM_PREDICADO", "b / (b - b) > 0", table="t", schema=None))
    rows = run(spark, rules, catalog, {"t": df})
    status = [r["estado_calidad"] for r in rows]
    assert status.count("NO_EVALUADA") == 2
    assert status[3] == "NO_EVALUADA" and status[-1] == "NO_EVALUADA"
    assert all(s == "CUMPLE" for i, s in enumerate(status) if i not in (3, len(status) - 1))


def test_many_rules_are_chunked_with_same_results(spark, catalog):
    df = spark.createDataFrame([(i, i % 7, f"v{i % 5}") for i in range(60)], "a int, b int, v string")
    rules = [rule("a", "VAL_RANGO_VALORES", f"{i},{i + 30}", table="t", schema=None) for i in range(12)]
    rules += [rule("b", "COM_PREDICADO", f"b <> {i}", table="t", schema=None, filters="a > 10")
              for i in range(5)]
    rules += [rule("v", "COM_PREDICADO", "a / (b - b) > 0", table="t", schema=None),
              rule("v", "COM_DUPLICADOS", table="t", schema=None)]
    whole = run(spark, rules, catalog, {"t": df})
    chunked = run(spark, rules, catalog, {"t": df}, aggs_per_scan=4)
    assert chunked == whole
    assert [r["estado_calidad"] for r in whole].count("NO_EVALUADA") == 1
    filtered = next(r for r in whole if r["parametros"] == "b <> 0")
    assert whole[0]["registros_fallidos"] == 29 and filtered["total_registros"] == 49


@pytest.mark.parametrize("eager", [True, False])
def test_many_uniqueness_columns_are_chunked(spark, catalog, eager):
    cols = [f"c{i}" for i in range(7)]
    df = spark.createDataFrame([tuple((r * (i + 1)) % (3 + i) for i in range(7)) for r in range(40)],
                               ", ".join(f"{c} int" for c in cols))
    rules = [rule(c, "COM_DUPLICADOS", table="t", schema=None) for c in cols]
    rules += [rule(c, "COM_DUPLICADOS", table="t", schema=None, filters="c0 = 1") for c in cols[:3]]
    whole = run(spark, rules, catalog, {"t": df}, eager=eager)
    chunked = run(spark, rules, catalog, {"t": df}, eager=eager, unique_per_query=3)
    assert chunked == whole
    alone = [run(spark, [x], catalog, {"t": df})[0] for x in rules]
    assert alone == whole


def test_only_data_errors_are_pinned_to_rules(spark):
    from qualia.plans.engine import _rule_fault

    df = spark.createDataFrame([(1, 0)], "a int, b int")
    try:
        df.selectExpr("a / b").collect()
    except Exception as e:
        assert _rule_fault(e)
    else:
        raise AssertionError("expected a division by zero")
    assert not _rule_fault(RuntimeError("executor lost"))
    assert not _rule_fault(ValueError("x"))


def test_cache_keeps_columns_named_only_inside_expressions(spark, catalog):
    df = spark.createDataFrame([(1, 2, "a"), (3, 0, "b")], "`x y` int, b int, v string")
    rules = [rule("v", "COM_PREDICADO", "`x y` + b > 2", table="t", schema=None, filters="b >= 0"),
             rule("v", "COM_DUPLICADOS", table="t", schema=None, filters="b >= 0")]
    assert run(spark, rules, catalog, {"t": df}, cache=True) == run(spark, rules, catalog, {"t": df})


def test_nested_field_and_dotted_name(spark, catalog):
    df = spark.sql("SELECT named_struct('city', c) AS address, c AS `a.b` FROM VALUES ('x'), ('y'), ('x'), (NULL) AS t(c)")
    nested = one(spark, "address.city", "COM_NULOS", "", catalog, df)
    dotted = one(spark, "a.b", "COM_NULOS", "", catalog, df)
    assert nested["registros_fallidos"] == dotted["registros_fallidos"] == 1
    uniq = one(spark, "address.city", "COM_DUPLICADOS", "", catalog, df)
    assert uniq["porcentaje_cumplimiento"] == pytest.approx(100 / 3)


def test_predicates_run_only_under_their_filter(spark, catalog):
    from qualia import run_rules

    t = spark.createDataFrame([(1, 0, 2.0), (4, 2, 1.0), (None, 1, 3.0)], "a int, b int, x double")
    ddl = ("id_calidad_tabla string, coleccion string, nombre_columna string, id_calidad_regla string, "
           "parametros string, filtros string, estado boolean, umbral double")
    rules = spark.createDataFrame([("t", "d", "a", "COM_PREDICADO", "a / b > 1", "b <> 0", True, 50.0),
                                   ("t", "d", "a", "COM_PREDICADO", "a / b < 9", "b <> 0", True, 50.0),
                                   ("t", "d", "x", "COM_NULOS", "", "", True, 100.0)], ddl)
    for eager in (True, False):
        got = [(r["total_registros"], r["registros_fallidos"]) for r in run_rules(spark, rules, catalog, tables={"d.t": t}, eager=eager).collect()]
        assert got == [(2, 1), (2, 1), (3, 0)]


@pytest.mark.parametrize("eager", [True, False])
def test_guarded_filter_next_to_an_unfiltered_rule(spark, catalog, eager):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "a int, b int")
    rules = [rule("a", "COM_PREDICADO", "a / b > 4", table="t", schema=None, filters="b <> 0"),
             rule("a", "COM_PREDICADO", "a / b < 9", table="t", schema=None, filters="b <> 0"),
             rule("a", "COM_NULOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df}, eager=eager)
    assert [r["total_registros"] for r in rows] == [20, 20, 30]
    want = [sum(not ok(i / (i % 3)) for i in range(30) if i % 3) for ok in (lambda x: x > 4, lambda x: x < 9)]
    assert [r["registros_fallidos"] for r in rows] == want + [0]


@pytest.mark.parametrize("eager", [True, False])
def test_one_unplannable_rule_leaves_its_group_alone(spark, catalog, eager):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").selectExpr("*", "parse_json('1') AS j")
    rules = [rule("k", "COM_PREDICADO", "max(k) > 0", table="t", schema=None),
             rule("k", "COM_PREDICADO", "row_number() OVER (ORDER BY k) > 0", table="t", schema=None),
             rule("j", "COM_DUPLICADOS", table="t", schema=None),
             rule("k", "COM_DUPLICADOS", table="t", schema=None),
             rule("v", "COM_NULOS", table="t", schema=None)]
    rows = run(spark, rules, catalog, {"t": df}, eager=eager)
    by = {(r["columna"], r["parametros"]): r["estado_calidad"] for r in rows}
    assert [by[("k", "max(k) > 0")], by[("k", "row_number() OVER (ORDER BY k) > 0")], by[("j", "")]] == ["NO_EVALUADA"] * 3
    assert by[("k", "")] == by[("v", "")] == "CUMPLE"


def test_text_against_whole_bounds_is_exact(spark, catalog):
    df = _df(spark, ["9007199254740993", "9007199254740992", "x", None, "1.5"])
    r = one(spark, "v", "VAL_RANGO_VALORES", "0,9007199254740992", catalog, df)
    assert r["registros_fallidos"] == 3


def test_uniqueness_of_long_and_short_text(spark, catalog):
    long = "x" * 31
    vals = [long, long + "a", long + "a", long + "b", "a", "a", "b", None, ""]
    r = one(spark, "v", "COM_DUPLICADOS", "", catalog, _df(spark, vals))
    assert r["porcentaje_cumplimiento"] == pytest.approx(100 * 4 / 8)


def test_uniqueness_shuffles_no_long_text(spark):
    from qualia.operators.metrics import UniqueSpec, unique_metrics

    df = spark.range(10).selectExpr("id", "repeat(cast(id AS string), 1000) AS t")
    plan = unique_metrics(df, [UniqueSpec("t"), UniqueSpec("id")])._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and "Aggregate [t#" not in plan


def test_unresolvable_rule_on_an_empty_group_is_met(spark, catalog):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    r = one(spark, "no_such", "COM_NULOS", "", catalog, df, filters="k > 5")
    assert (r["estado_calidad"], r["total_registros"]) == ("CUMPLE", 0)


def test_sizes_of_a_job_are_checked(spark, catalog):
    with pytest.raises(ValueError, match="aggs_per_scan"):
        run(spark, [rule("v", "COM_NULOS", table="t", schema=None)], catalog, {"t": _df(spark, ["a"])}, aggs_per_scan=1)
