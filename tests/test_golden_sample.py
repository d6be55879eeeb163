"""Eight cargo rows with planted faults, eight rules (FIXTURES.md 3-4)."""

import pytest

import sample as S
from helpers import run

EXPECTED = {
    # column: (metric, failing, status)
    "destino": (7 / 8, 1, "NO_CUMPLE"),
    "guia": (1.0, 0, "CUMPLE"),
    "situacion": (7 / 8, 1, "NO_CUMPLE"),
    "peso_kg": (6 / 8, 2, "NO_CUMPLE"),
    "contenedor": (5 / 8, 3, "NO_CUMPLE"),
    "codigo": (0.0, 8, "NO_CUMPLE"),
    "bultos": (5 / 8, 3, "NO_CUMPLE"),
    "nota": (6 / 8, 2, "NO_CUMPLE"),
}


@pytest.fixture(scope="module")
def result(spark, catalog):
    tables = {f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)}
    return run(spark, S.SAMPLE_RULES, catalog, tables)


def test_one_row_per_rule_in_rule_order(result):
    assert [r["columna"] for r in result] == [r["nombre_columna"] for r in S.SAMPLE_RULES]
    assert all(r["id_calidad_tabla"] == S.TABLE for r in result)
    assert all(r["total_registros"] == 8 for r in result)


def test_metrics_failing_and_status(result):
    for r in result:
        metric, failing, status = EXPECTED[r["columna"]]
        assert r["porcentaje_cumplimiento"] == pytest.approx(metric * 100), r
        assert r["registros_fallidos"] == failing, r
        assert r["estado_calidad"] == status, r


def test_remarks(result):
    first = result[0]
    assert first["observacion_tecnica"] == (
        "Alerta: Solo el 87.50% de los datos cumple la regla. Se exigía el 99.0%.")
    assert result[1]["observacion_tecnica"] == "Regla cumplida exitosamente."
    assert result[5]["observacion_tecnica"].startswith("Alerta: Solo el 0.00% ")


def test_parameters_and_thresholds_are_shown(result):
    by_col = {r["columna"]: r for r in result}
    assert by_col["situacion"]["parametros"] == "cargado,en ruta,entregado"
    assert by_col["destino"]["parametros"] == ""
    assert by_col["peso_kg"]["umbral"] == 70.5


def test_corrected_pattern(spark, catalog):
    rules = [S.rule("codigo", "CONF_REGEX", S.CODE_FIXED, 80.0)]
    (r,) = run(spark, rules, catalog, {f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)})
    assert r["registros_fallidos"] == 2
    assert r["porcentaje_cumplimiento"] == pytest.approx(75)


def test_full_result_schema_with_stamps(spark, catalog):
    import datetime as dt

    from qualia import RESULT_SCHEMA, run_rules
    from helpers import rules_df

    res = run_rules(spark, rules_df(spark, S.SAMPLE_RULES), catalog,
                    tables={f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)},
                    as_of=dt.datetime(2026, 3, 1, 12, 0, 0))
    assert [f.name for f in res.schema.fields] == RESULT_SCHEMA.fieldNames()
    assert [f.dataType for f in res.schema.fields] == [f.dataType for f in RESULT_SCHEMA.fields]
    row = res.first()
    assert row["periodo"] == dt.date(2026, 3, 1)


def test_wide_result_names_rule_code_and_dimension(spark, catalog):
    rows = run(spark, S.SAMPLE_RULES[:2], catalog, {f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)}, wide=True)
    assert rows[0]["id_calidad_regla"] == "COM_NULOS"
    assert rows[0]["dimension"] == "completitud"
    assert rows[0]["coleccion"] == S.SCHEMA


def test_lazy_run_gives_the_same_result(spark, catalog, result):
    tables = {f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)}
    assert run(spark, S.SAMPLE_RULES, catalog, tables, eager=False) == result


def test_verification_report(spark, catalog):
    from qualia import verification_report
    from helpers import rules_df

    metrics, outcomes = verification_report(spark, rules_df(spark, S.SAMPLE_RULES), catalog,
                                            tables={f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)})
    m = {r["name"] + ":" + r["check"].split(":")[1]: r["value"] for r in metrics.collect()}
    assert m["Completeness:destino"] == pytest.approx(7 / 8)
    assert m["Uniqueness:guia"] == 1.0
    assert m["PatternMatch:codigo"] == 0.0
    o = {r["check"].split(":")[1]: r for r in outcomes.collect()}
    assert o["guia"]["constraint_status"] == "Success" and o["guia"]["constraint_message"] == ""
    assert o["peso_kg"]["constraint_status"] == "Failure"
    assert o["peso_kg"]["constraint_message"].startswith("Value: 0.75 ")
