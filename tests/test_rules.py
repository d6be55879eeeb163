"""Control plane: rule standardization, catalog, join, active filter, grouping."""

import pytest
from pyspark.sql import functions as F

from qualia.plans.rules import (
    active_rules,
    collect_rules,
    group_rules,
    join_catalog,
    param_list,
    standardize_rules,
)
from qualia.sources.catalog import DEFAULT_CATALOG, standardize_catalog

RAW_DDL = ("id_calidad_tabla string, coleccion string, nombre_columna string, id_calidad_regla string, "
           "parametros string, filtros string, estado string, umbral string")


def test_standardize_trims_and_casts(spark):
    raw = spark.createDataFrame([("  t ", " db", " c ", " X ", " a , b ,, ", "  ", " TRUE", " 97.5 "),
                                 ("t", "db", "c", "X", None, None, "S", "99,5")], RAW_DDL)
    rows = standardize_rules(raw).collect()
    assert (rows[0]["table_name"], rows[0]["schema"], rows[0]["column_name"], rows[0]["rule_code"]) == \
        ("t", "db", "c", "X")
    assert rows[0]["params"] == "a , b ,," and rows[0]["filters"] == ""
    assert rows[0]["is_active"] is True and rows[0]["threshold"] == 97.5
    assert rows[1]["is_active"] is None and rows[1]["threshold"] is None
    assert rows[0]["description"] is None  # optional column missing -> NULL
    assert rows[0]["seq"] < rows[1]["seq"]


def test_standardize_requires_key_columns(spark):
    with pytest.raises(ValueError, match="nombre_columna"):
        standardize_rules(spark.createDataFrame([("t", "X")], "id_calidad_tabla string, id_calidad_regla string"))


def test_param_list(spark):
    raw = spark.createDataFrame([("t", "db", "c", "X", " a , b ,, \t", "", "true", "1")], RAW_DDL)
    (row,) = param_list(standardize_rules(raw)).collect()
    assert row["param_list"] == ["a", "b"]


@pytest.mark.parametrize("text,key", [("isComplete()", "iscomplete"), ("  HasPattern() ", "haspattern"),
                                      ("isUnique", "isunique"), ("a()()", "a()"), (None, ""), ("", "")])
def test_normalize_method(spark, text, key):
    from qualia.functions.text import normalize_method_col

    got = spark.createDataFrame([(text,)], "m string").select(normalize_method_col(F.col("m"))).first()[0]
    assert got == key


def test_catalog_standardize_and_join(spark):
    cat = spark.createDataFrame([(" A ", " d ", " x ", " isComplete() ")],
                                "id_calidad_regla string, dimension string, descripcion string, metodo string")
    (c,) = standardize_catalog(cat).collect()
    assert (c["id_calidad_regla"], c["dimension"], c["catalog_description"], c["metodo"], c["method_key"]) == \
        ("A", "d", "x", "isComplete()", "iscomplete")
    raw = spark.createDataFrame([("t", "db", "c", "A", "", "", "true", "1"),
                                 ("t", "db", "c", "B", "", "", "true", "1")], RAW_DDL)
    rows = sorted(join_catalog(standardize_rules(raw), cat).collect(), key=lambda r: r["seq"])
    assert rows[0]["method_key"] == "iscomplete" and rows[1]["metodo"] is None


def test_join_without_catalog_keeps_rules(spark):
    raw = spark.createDataFrame([("t", "db", "c", "A", "", "", "true", "1")], RAW_DDL)
    (row,) = join_catalog(standardize_rules(raw), None).collect()
    assert row["metodo"] is None


def test_active_rules_and_dataset(spark):
    raw = spark.createDataFrame([("t", "db", "c", "A", "", "", "true", "1"),
                                 ("u", "db", "c", "A", "", "", "true", "1"),
                                 ("t", "db", "c", "A", "", "", "false", "1"),
                                 ("t", "db", "c", "A", "", "", None, "1")], RAW_DDL)
    std = standardize_rules(raw)
    assert active_rules(std).count() == 2
    assert [r["table_name"] for r in active_rules(std, "t").collect()] == ["t"]


def test_grouping_keeps_first_appearance(spark):
    raw = spark.createDataFrame([("t", "db", "a", "A", "", "f1", "true", "1"),
                                 ("u", "db", "b", "A", "", None, "true", "1"),
                                 ("t", "db", "c", "A", "", "f1", "true", "1"),
                                 ("t", "db", "d", "A", "", "", "true", "1"),
                                 ("u", "db", "e", "A", "", "  ", "true", "1")], RAW_DDL)
    plan = active_rules(join_catalog(standardize_rules(raw), spark.createDataFrame(DEFAULT_CATALOG[:1],
                        "id_calidad_regla string, dimension string, descripcion string, metodo string")))
    groups = group_rules(collect_rules(plan))
    assert [(g.table_name, g.filter, [r.column_name for r in g.rules]) for g in groups] == [
        ("t", "f1", ["a", "c"]), ("u", "", ["b", "e"]), ("t", "", ["d"])]


def test_input_bundle(spark, catalog):
    import sample as S
    from helpers import rules_df
    from qualia import transform
    from qualia.plans.inputs import pick_inputs

    rules = rules_df(spark, S.SAMPLE_RULES[:2])
    tables = {f"{S.SCHEMA}.{S.TABLE}": S.cargo_df(spark)}
    assert pick_inputs(rules) == (rules, None)
    assert pick_inputs({"reglas": rules, "otro": catalog}) == (rules, catalog)
    assert pick_inputs({"x": rules, "catalogo_metodos": catalog}) == (rules, catalog)
    assert pick_inputs({"r": rules, "c": catalog}, {"rules_input_name": "r", "catalog_input_name": "c"}) \
        == (rules, catalog)
    res = transform(spark, {"reglas": rules, "catalogo_metodos": catalog},
                    {"dataset": S.TABLE}, tables=tables, stamps=False).collect()
    assert [r["estado_calidad"] for r in res] == ["NO_CUMPLE", "CUMPLE"]
    assert transform(spark, rules, {"dataset": "other"}, tables=tables).count() == 0


def test_duplicate_catalog_codes_warn_and_multiply(spark):
    import warnings as w

    from qualia.plans.rules import collect_rules

    raw = spark.createDataFrame([("t", "db", "c", "A", "", "", "true", "1")], RAW_DDL)
    cat = spark.createDataFrame([("A", "d", "x", "isComplete()"), ("A", "d", "y", "isUnique()")],
                                "id_calidad_regla string, dimension string, descripcion string, metodo string")
    with w.catch_warnings(record=True) as caught:
        w.simplefilter("always")
        rules = collect_rules(active_rules(join_catalog(standardize_rules(raw), cat)))
    assert len(rules) == 2
    assert any("A" in str(c.message) for c in caught)
