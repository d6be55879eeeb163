"""Sources and sinks: catalog CSV, result CSV, managed table, export format."""

import datetime as dt

from qualia import DEFAULT_CATALOG, run_rules
from qualia.sources import (
    default_catalog,
    export_format,
    fresh_path,
    read_catalog_csv,
    read_result_csv,
    save_table,
    shared_dir,
    write_catalog_csv,
    write_result_csv,
)
from qualia.schema import RESULT_BODY_COLUMNS

import sample as S
from helpers import rules_df

AS_OF = dt.datetime(2026, 2, 3, 4, 5, 6, 789000)


def _result(spark, catalog):
    return run_rules(spark, rules_df(spark, S.SAMPLE_RULES), catalog,
                     tables={f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)}, as_of=AS_OF)


def test_shared_dir_comes_from_the_session(spark):
    d = shared_dir(spark)
    assert d and d == spark.sparkContext.getCheckpointDir().rstrip("/")
    assert fresh_path(spark, "x").startswith(d + "/qualia-x-")


def test_catalog_csv_roundtrip(spark):
    path = fresh_path(spark, "cat")
    write_catalog_csv(default_catalog(spark), path)
    back = read_catalog_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(DEFAULT_CATALOG)
    assert all(f.dataType.typeName() == "string" for f in back.schema.fields)


def test_catalog_csv_by_header_name(spark):
    path = fresh_path(spark, "cat2")
    mixed = default_catalog(spark).selectExpr("metodo", "'x' AS nota", "descripcion", "id_calidad_regla", "dimension")
    mixed.coalesce(1).write.option("header", True).csv(path)
    assert sorted(tuple(r) for r in read_catalog_csv(spark, path).collect()) == sorted(DEFAULT_CATALOG)


def test_result_csv_roundtrip(spark, catalog):
    res = _result(spark, catalog)
    path = fresh_path(spark, "res")
    write_result_csv(res, path)
    back = read_result_csv(spark, path)
    assert sorted(back.select(*RESULT_BODY_COLUMNS).collect()) == \
        sorted(res.select(*RESULT_BODY_COLUMNS).collect())
    first = back.first()
    assert first["periodo"] == "2026-02-03"
    assert first["fecha_proceso"] == "2026-02-03 04:05:06.789"


def test_export_format(spark, catalog):
    row = export_format(_result(spark, catalog)).first()
    assert (row["periodo"], row["fecha_proceso"]) == ("2026-02-03", "2026-02-03 04:05:06.789")


def test_managed_table_overwrite(spark, catalog):
    res = _result(spark, catalog)
    loc = fresh_path(spark, "db")
    name = save_table(res, "qualia_test_db", "resultados", location=loc)
    save_table(res, "qualia_test_db", "resultados", location=loc)  # overwrite, no error
    back = spark.table(name)
    assert back.count() == len(S.SAMPLE_RULES)
    assert sorted(back.select(*RESULT_BODY_COLUMNS).collect()) == \
        sorted(res.select(*RESULT_BODY_COLUMNS).collect())


def test_rules_on_a_metastore_table(spark, catalog):
    loc = fresh_path(spark, "db2")
    save_table(S.cargo_df(spark), "qualia_cargo_db", S.TABLE, location=loc)
    rules = [S.rule("guia", "COM_DUPLICADOS", schema="qualia_cargo_db")]
    (row,) = run_rules(spark, rules_df(spark, rules), catalog, stamps=False).collect()
    assert (row["estado_calidad"], row["total_registros"]) == ("CUMPLE", 8)
