"""

Every query runs the rule engine over the given tables (or tables Spark derives
from them with a join or a projection): the rule rows are configuration, the work
is the scan and aggregation of the checked tables. Each oracle is written by hand
in DuckDB SQL from the meaning of the check, not from the engine's code.
"""


import datetime as _dt
import os
import sys
from collections.abc import Callable
from dataclasses import dataclass, replace

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

import pyarrow as pa  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from qualia import run_rules, transform  # noqa: E402
from qualia.plans.engine import evaluate_rules  # noqa: E402
from qualia.operators.checks import AGGREGATE, ROW, Check, CheckContext, register_check  # noqa: E402
from qualia.operators.classify import check_outcomes, metric_report  # noqa: E402
from qualia.schema import RESULT_BODY_COLUMNS  # noqa: E402
from qualia.sources import (  # noqa: E402
    default_catalog,
    export_format,
    fresh_path,
    read_catalog_csv,
    read_result_csv,
    save_table,
    write_result_csv,
)

try:  # the corpus operators and their pipeline are optional parts
    import corpus_pipeline as _pipeline  # noqa: E402
    from qualia.llm import queries as _corpus  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "qualia.llm"):
        raise
    _pipeline = _corpus = None

SCHEMA = "tpch"
SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = _dt.datetime(2026, 1, 31, 8, 30, 0)

# Catalog rows beyond the shipped nine, used by some queries.
EXTRA_CATALOG = [
    ("COM_NULOS_LISTA", "completitud", "Cuenta los nulos de la columna", "collectNulls()"),
    ("CONF_PREDICADO", "conformidad", "Valida un predicado SQL", "satisfies()"),
    ("VAL_MAYOR_CERO", "validez", "Valores estrictamente positivos", "isPositive()"),
    ("CONF_MULTIPLO", "conformidad", "Múltiplo de un número", "isMultipleOf()"),
    ("CONF_SUMA", "conformidad", "Suma dentro de límites", "sumBetween()"),
    ("CONF_PESO", "conformidad", "Parte del total de la columna bajo un predicado", "weightedShare()"),
]

# --- Fixed values: remark texts
MSG_OK = "Regla cumplida exitosamente."
MSG_EMPTY = "Sin registros tras aplicar filtros; regla considerada cumplida."
MSG_NO_VALUES = "Sin valores no nulos: la métrica no se puede calcular."
MSG_NOT_EVALUABLE = "Regla no evaluable"


# ---------------------------------------------------------------------------------------
# Rule specs: what the engine gets (rule row) and what the oracle computes (SQL)
# ---------------------------------------------------------------------------------------
@dataclass
class R:
    table: str
    column: str
    code: str
    params: str = ""
    threshold: float | None = 100.0
    filters: str = ""
    active: bool | None = True
    schema: str | None = SCHEMA
    # oracle: "row" with a pass predicate, "unique", "metric" with the metric, or a NO_EVALUADA message ("skip")
    kind: str = "row"
    pred: str = ""
    message: str = ""
    ofilter: str | None = None      # DuckDB filter when it differs from ``filters``


# --- Fixed values: columns of the rule table
RULE_DDL = ("id_calidad_tabla string, coleccion string, nombre_columna string, "
            "id_calidad_regla string, parametros string, filtros string, estado boolean, "
            "descripcion string, umbral double, macrodominio string, dominio string, "
            "usuario_cambio string, fecha_cambio string")


def _rule_rows(rules: list[R]) -> list[tuple]:
    return [(r.table, r.schema, r.column, r.code, r.params, r.filters, r.active,
             f"{r.code} sobre {r.column}", r.threshold, "TPCH", "ventas", "analista",
             "2026-01-15 10:00:00") for r in rules]


def _rules_df(spark: SparkSession, rules: list[R]) -> DataFrame:
    """The rule rows as a local relation (via an Arrow table)."""
    schema = spark.createDataFrame([], RULE_DDL).schema
    arrow = {"string": pa.string(), "boolean": pa.bool_(), "double": pa.float64()}
    rows = _rule_rows(rules)
    table = pa.table({f.name: pa.array([r[i] for r in rows], type=arrow[f.dataType.typeName()])
                      for i, f in enumerate(schema.fields)})
    return spark.createDataFrame(table, schema)


def _catalog(spark: SparkSession) -> DataFrame:
    return default_catalog(spark, EXTRA_CATALOG)


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _tables(spark: SparkSession, d: str) -> dict[str, Callable[[SparkSession], DataFrame]]:
    """Checked tables by name: the driver tables, plus three derived by Spark."""
    base = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
            "events", "documents", "pages", "labels", "conversations", "benchmark", "embeddings"]
    out: dict[str, Callable[[SparkSession], DataFrame]] = {
        n: (lambda s, n=n: _read(s, d, n)) for n in base}

    def doc_labels(s):
        docs = _read(s, d, "documents").select("doc_id", "text", "lang")
        return docs.join(_read(s, d, "labels").toDF("doc_id", "rating", "toxic"), "doc_id", "left")

    def doc_tags(s):
        t = doc_labels(s)
        tag = (F.when(F.col("rating").isNull(), F.lit(None).cast("string"))
               .when(F.col("toxic") == 1, F.lit("   "))
               .when(F.col("rating") == 0, F.lit(""))
               .when(F.col("lang") == "de", F.lit("\t"))
               .otherwise(F.col("lang")))
        return t.withColumn("tag", tag)

    def orders_n(s):
        o = _read(s, d, "orders")
        return o.withColumns({
            "o_priority_n": F.expr("nullif(o_orderpriority, '5-LOW')"),
            "o_nothing": F.expr("nullif(o_orderstatus, o_orderstatus)"),
            "o_wide": F.expr("CAST(9007199254740992 + o_orderkey AS STRING)"),
            "o_wider": F.expr("CAST(10000000000000000000000 + o_orderkey AS STRING)"),
        })

    out["doc_labels"] = doc_labels
    out["doc_tags"] = doc_tags
    out["orders_n"] = orders_n
    return {f"{SCHEMA}.{k}": v for k, v in out.items()}


# DuckDB text of the derived tables.
ORACLE_FROM = {
    "doc_labels": "(SELECT d.doc_id, d.text, d.lang, l.rating, l.toxic FROM documents d "
                  "LEFT JOIN labels l(doc_id, rating, toxic) ON d.doc_id = l.doc_id)",
    "doc_tags": "(SELECT *, CASE WHEN rating IS NULL THEN NULL WHEN toxic = 1 THEN '   ' "
                "WHEN rating = 0 THEN '' WHEN lang = 'de' THEN chr(9) ELSE lang END AS tag "
                "FROM (SELECT d.doc_id, d.text, d.lang, l.rating, l.toxic FROM documents d "
                "LEFT JOIN labels l(doc_id, rating, toxic) ON d.doc_id = l.doc_id))",
    "orders_n": "(SELECT *, nullif(o_orderpriority, '5-LOW') AS o_priority_n, "
                "CAST(NULL AS VARCHAR) AS o_nothing, "
                "CAST(9007199254740992 + o_orderkey AS VARCHAR) AS o_wide, "
                "CAST(10000000000000000000000::HUGEINT + o_orderkey AS VARCHAR) AS o_wider FROM orders)",
}


# ---------------------------------------------------------------------------------------
# Oracle SQL
# ---------------------------------------------------------------------------------------
def _lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _dbl(x: float | None) -> str:
    return "CAST(0.0 AS DOUBLE)" if x is None else f"CAST({x!r} AS DOUBLE)"


def _from(r: R) -> str:
    src = ORACLE_FROM.get(r.table, r.table)
    f = r.filters if r.ofilter is None else r.ofilter
    return f"{src} AS t" + (f" WHERE {f}" if f else "")


def _stats(r: R) -> str:
    """Subquery with total, passed, denom for one rule."""
    if r.kind == "row":
        return (f"SELECT count(*) AS total, count(*) FILTER (WHERE coalesce({r.pred}, false)) AS passed, "
                f"count(*) AS denom FROM {_from(r)}")
    if r.kind == "unique":
        c = f'"{r.column}"'
        return (f"SELECT (SELECT count(*) FROM {_from(r)}) AS total, "
                f"count(*) FILTER (WHERE n = 1) AS passed, coalesce(sum(n), 0) AS denom "
                f"FROM (SELECT {c} AS v, count(*) AS n FROM {_from(r)} "
                f"{'AND' if (r.filters or r.ofilter) else 'WHERE'} {c} IS NOT NULL GROUP BY {c})")
    if r.kind == "metric":
        return (f"SELECT total, m AS passed, CASE WHEN m IS NULL THEN 0 ELSE 1 END AS denom "
                f"FROM (SELECT count(*) AS total, ({r.pred})::DOUBLE AS m FROM {_from(r)})")
    return f"SELECT count(*) AS total, NULL::BIGINT AS passed, NULL::BIGINT AS denom FROM {_from(r)}"


def _oracle_rule(r: R, policy: str = "strict") -> str:
    thr = _dbl(r.threshold)
    m = "(passed::DOUBLE / denom)"
    if r.kind == "skip":
        return (f"SELECT {_lit(r.table)} AS id_calidad_tabla, {_lit(r.column)} AS columna, "
                f"{_lit(r.params or '')} AS parametros, {thr} AS umbral, 'NO_EVALUADA' AS estado_calidad, "
                f"total AS total_registros, total AS registros_fallidos, "
                f"CAST(0.0 AS DOUBLE) AS porcentaje_cumplimiento, {_lit(r.message)} AS observacion_tecnica "
                f"FROM ({_stats(r)})")
    ok = "passed = denom" if policy == "strict" else f"{m} * 100 >= {thr}"
    return f"""SELECT {_lit(r.table)} AS id_calidad_tabla, {_lit(r.column)} AS columna,
  {_lit(r.params or '')} AS parametros, {thr} AS umbral,
  CASE WHEN total = 0 THEN 'CUMPLE' WHEN denom = 0 THEN 'NO_EVALUADA'
       WHEN {ok} THEN 'CUMPLE' ELSE 'NO_CUMPLE' END AS estado_calidad,
  total AS total_registros,
  CAST(CASE WHEN total = 0 THEN 0 WHEN denom = 0 THEN total
            ELSE round_even(total * (1.0 - {m}), 0) END AS BIGINT) AS registros_fallidos,
  CASE WHEN total = 0 THEN CAST(100.0 AS DOUBLE) WHEN denom = 0 THEN CAST(0.0 AS DOUBLE)
       ELSE {m} * 100 END AS porcentaje_cumplimiento,
  CASE WHEN total = 0 THEN {_lit(MSG_EMPTY)} WHEN denom = 0 THEN {_lit(MSG_NO_VALUES)}
       WHEN {ok} THEN {_lit(MSG_OK)}
       ELSE 'Alerta: Solo el ' || printf('%.2f', {m} * 100) || '% de los datos cumple la regla. Se exigía el '
            || CAST({thr} AS VARCHAR) || '%.' END AS observacion_tecnica
FROM ({_stats(r)})"""


def _oracle(rules: list[R], policy: str = "strict") -> str:
    return "\nUNION ALL\n".join(_oracle_rule(r, policy) for r in rules if r.active)


# ---------------------------------------------------------------------------------------
# Rule sets
# ---------------------------------------------------------------------------------------
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"

ORDERS_RULES = [
    R("orders", "o_orderkey", "COM_NULOS", pred="o_orderkey IS NOT NULL"),
    R("orders", "o_orderkey", "COM_DUPLICADOS", kind="unique"),
    R("orders", "o_custkey", "COM_DUPLICADOS", threshold=50.0, kind="unique"),
    R("orders", "o_orderstatus", "VAL_PERMITIDOS", "F,O", 95.0,
      pred="o_orderstatus IS NULL OR o_orderstatus IN ('F', 'O')"),
    R("orders", "o_totalprice", "VAL_POSITIVOS", threshold=99.9,
      pred="o_totalprice IS NULL OR o_totalprice >= 0"),
    R("orders", "o_totalprice", "VAL_RANGO_VALORES", "1000, 450000", 98.0,
      pred="o_totalprice >= 1000 AND o_totalprice <= 450000"),
    R("orders", "o_orderpriority", "CONF_LONG_EXACTA", "6", 20.0, pred="length(o_orderpriority) = 6"),
    R("orders", "o_orderpriority", "CONF_REGEX", "^[1-5]-[A-Z]+$", 90.0,
      pred="regexp_extract(o_orderpriority, '^[1-5]-[A-Z]+$', 0) <> ''"),
    R("orders", "o_orderstatus", "COM_OBLIGATORIO", threshold=100.0,
      pred="trim(o_orderstatus) <> '' AND o_orderstatus IS NOT NULL"),
]

LINEITEM_RULES = [
    R("lineitem", "l_orderkey", "COM_NULOS", pred="l_orderkey IS NOT NULL"),
    R("lineitem", "l_partkey", "COM_NULOS", pred="l_partkey IS NOT NULL"),
    R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "5,45", 90.0, pred="l_quantity BETWEEN 5 AND 45"),
    R("lineitem", "l_quantity", "VAL_POSITIVOS", pred="l_quantity IS NULL OR l_quantity >= 0"),
    R("lineitem", "l_extendedprice", "VAL_POSITIVOS", pred="l_extendedprice IS NULL OR l_extendedprice >= 0"),
    R("lineitem", "l_discount", "VAL_RANGO_VALORES", "0,0.08", 95.0, pred="l_discount BETWEEN 0 AND 0.08"),
    R("lineitem", "l_tax", "VAL_RANGO_VALORES", "0.0,0.06", 95.0, pred="l_tax BETWEEN 0.0 AND 0.06"),
    R("lineitem", "l_returnflag", "VAL_PERMITIDOS", "A,N", 90.0,
      pred="l_returnflag IS NULL OR l_returnflag IN ('A', 'N')"),
    R("lineitem", "l_linestatus", "CONF_LONG_EXACTA", "1", pred="length(l_linestatus) = 1"),
    R("lineitem", "l_shipdate", "VAL_RANGO_VALORES", "'1995-06-01','2001-06-30'", 99.0,
      pred="l_shipdate BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-06-30'"),
]

CUSTOMER_RULES = [
    R("customer", "c_custkey", "COM_DUPLICADOS", kind="unique"),
    R("customer", "c_acctbal", "VAL_POSITIVOS", threshold=90.0, pred="c_acctbal IS NULL OR c_acctbal >= 0"),
    R("customer", "c_mktsegment", "VAL_PERMITIDOS", "BUILDING,MACHINERY,HOUSEHOLD", 50.0,
      pred="c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"),
    R("customer", "c_name", "COM_OBLIGATORIO", threshold=99.0,
      pred="trim(c_name) <> '' AND c_name IS NOT NULL"),
]


# Rules that divide by a column that only their filter keeps from being zero.
GUARDED_RULES = [
    R("lineitem", "l_tax", "CONF_PREDICADO", "l_tax / l_discount > 0.5", 50.0, filters="l_discount > 0",
      pred="l_tax / l_discount > 0.5"),
    R("lineitem", "l_tax", "CONF_PREDICADO", "l_tax / l_discount < 2", 50.0, filters="l_discount > 0",
      pred="l_tax / l_discount < 2"),
    R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "5,45", 90.0, pred="l_quantity BETWEEN 5 AND 45"),
]

# More counts than one scan takes (45 rules under three filters) and more uniqueness
# columns than one query takes.
MANY_RULES = [
    R("lineitem", "l_quantity", "VAL_RANGO_VALORES", f"{i},{i + 30}", 50.0, filters=flt,
      pred=f"l_quantity BETWEEN {i} AND {i + 30}")
    for flt in ("", "l_returnflag = 'R'", "l_returnflag = 'A'") for i in range(1, 16)
] + [R("lineitem", c, "COM_DUPLICADOS", threshold=0.0, kind="unique")
     for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_shipdate")]


# Predicates that raise an error on some rows, beside good ones, and one that a filter saves.
FAILING_RULES = [
    R("lineitem", "l_tax", "CONF_PREDICADO", "l_tax / l_discount > 0.5", 50.0, kind="skip", message=MSG_NOT_EVALUABLE),
    R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "5,45", 90.0, pred="l_quantity BETWEEN 5 AND 45"),
    R("lineitem", "l_returnflag", "CONF_PREDICADO", "CAST(l_returnflag AS INT) > 0", 50.0, kind="skip", message=MSG_NOT_EVALUABLE),
    R("lineitem", "l_tax", "CONF_PREDICADO", "l_tax / l_discount > 0.5", 50.0, filters="l_discount > 0", pred="l_tax / l_discount > 0.5"),
    R("lineitem", "l_linenumber", "CONF_PREDICADO", "l_linenumber * 2 > 4", 50.0, pred="l_linenumber * 2 > 4"),
]

KEY_RULES = [
    R("orders", "o_orderkey", "COM_DUPLICADOS", kind="unique"),
    R("orders", "o_custkey", "COM_DUPLICADOS", threshold=50.0, kind="unique"),
    R("lineitem", "l_orderkey", "COM_DUPLICADOS", threshold=50.0, filters="l_linenumber = 1", kind="unique"),
    R("lineitem", "l_orderkey", "COM_DUPLICADOS", threshold=50.0, kind="unique"),
    R("lineitem", "l_returnflag", "COM_DUPLICADOS", threshold=50.0, kind="unique"),
    R("events", "event_id", "COM_DUPLICADOS", kind="unique"),
    R("doc_labels", "rating", "COM_DUPLICADOS", threshold=1.0, kind="unique"),
]


def _run(rules: list[R], *, catalog: str = "full", body: bool = True, **kw) -> Callable:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        cat = {"full": _catalog, "none": lambda s: None}[catalog](spark)
        return run_rules(spark, _rules_df(spark, rules), cat, tables=_tables(spark, sf_dir),
                         stamps=not body, **kw)
    return q


# Rule sets of the single-check queries
Q: dict[str, tuple[list[R], dict]] = {
    "table_row_count": ([R("lineitem", "l_orderkey", "COM_NULOS", pred="l_orderkey IS NOT NULL")], {}),
    "chk_complete": ([R("doc_labels", "rating", "COM_NULOS", threshold=95.0, pred="rating IS NOT NULL"),
                      R("doc_labels", "toxic", "COM_NULOS", threshold=None, pred="toxic IS NOT NULL")], {}),
    "chk_collect_nulls": ([R("orders_n", "o_priority_n", "COM_NULOS_LISTA", threshold=99.0,
                             pred="o_priority_n IS NOT NULL")], {}),
    "chk_unique": ([R("orders", "o_custkey", "COM_DUPLICADOS", kind="unique"),
                    R("documents", "text", "COM_DUPLICADOS", threshold=90.0, kind="unique"),
                    R("doc_labels", "rating", "COM_DUPLICADOS", threshold=1.0, kind="unique")], {}),
    "chk_unique_multi": ([R("orders_n", "o_orderkey", "COM_DUPLICADOS", kind="unique"),
                          R("orders_n", "o_custkey", "COM_DUPLICADOS", kind="unique"),
                          R("orders_n", "o_priority_n", "COM_DUPLICADOS", kind="unique"),
                          R("orders_n", "o_orderstatus", "COM_DUPLICADOS", kind="unique",
                            filters="o_totalprice > 400000")], {}),
    "chk_unique_all_null": ([R("orders_n", "o_nothing", "COM_DUPLICADOS", kind="unique"),
                             R("orders_n", "o_orderkey", "COM_DUPLICADOS", kind="unique")], {}),
    "chk_contained_in": ([R("orders", "o_orderstatus", "VAL_PERMITIDOS", "F, O ,,", 60.0,
                            pred="o_orderstatus IS NULL OR o_orderstatus IN ('F', 'O')"),
                          R("doc_labels", "rating", "VAL_PERMITIDOS", "1", 50.0,
                            pred="rating IS NULL OR CAST(rating AS VARCHAR) IN ('1')")], {}),
    "chk_non_negative": ([R("customer", "c_acctbal", "VAL_POSITIVOS", threshold=90.0,
                            pred="c_acctbal IS NULL OR c_acctbal >= 0"),
                          R("lineitem", "l_discount", "VAL_POSITIVOS",
                            pred="l_discount IS NULL OR l_discount >= 0")], {}),
    "chk_pattern": ([R("documents", "text", "CONF_REGEX", EMAIL, 1.0,
                       pred=f"regexp_extract(text, '{EMAIL}', 0) <> ''"),
                     R("pages", "url", "CONF_REGEX", "utm_", 10.0,
                       pred="regexp_extract(url, 'utm_', 0) <> ''"),
                     R("pages", "url", "CONF_REGEX", "^https?://", 100.0,
                       pred="regexp_extract(url, '^https?://', 0) <> ''"),
                     R("part", "p_name", "CONF_REGEX", "^x*", 50.0,
                       pred="regexp_extract(p_name, '^x*', 0) <> ''")], {}),
    "chk_between_number": ([R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "5,45", 90.0,
                              pred="l_quantity BETWEEN 5 AND 45"),
                            R("part", "p_size", "VAL_RANGO_VALORES", "10, 40", 50.0,
                              pred="p_size BETWEEN 10 AND 40"),
                            R("orders_n", "o_wide", "VAL_RANGO_VALORES", "9007199254740993,9007199254741992", 10.0,
                              pred="CAST(o_wide AS HUGEINT) BETWEEN 9007199254740993 AND 9007199254741992"),
                            R("orders_n", "o_wider", "VAL_RANGO_VALORES", "0,10000000000000000000500", 10.0,
                              pred="CAST(o_wider AS HUGEINT) BETWEEN 0 AND 10000000000000000000500"),
                            R("orders_n", "o_wider", "VAL_RANGO_VALORES", "0.1234567890123456789,10000000000000000000900", 10.0,
                              pred="CAST(o_wider AS HUGEINT) BETWEEN 1 AND 10000000000000000000900"),
                            R("orders_n", "o_wider", "VAL_RANGO_VALORES", "10000000000000000000100,10000000000000000000000000", 10.0,
                              pred="CAST(o_wider AS HUGEINT) >= 10000000000000000000100")], {}),
    "chk_between_date": ([R("orders", "o_orderdate", "VAL_RANGO_VALORES", "'1995-01-01','1999-12-31'", 90.0,
                            pred="o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1999-12-31'"),
                          R("events", "ts", "VAL_RANGO_VALORES", "'2024-01-05', '2024-01-25 12:00:00'", 50.0,
                            pred="ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 12:00:00'")], {}),
    "chk_length": ([R("part", "p_brand", "CONF_LONG_EXACTA", "8", 60.0, pred="length(p_brand) = 8"),
                    R("orders", "o_orderkey", "CONF_LONG_EXACTA", "4", 10.0,
                      pred="length(CAST(o_orderkey AS VARCHAR)) = 4")], {}),
    "chk_not_blank": ([R("doc_tags", "tag", "COM_OBLIGATORIO", threshold=30.0,
                         pred="trim(tag) <> '' AND tag IS NOT NULL")], {}),
    "chk_predicate": ([R("lineitem", "l_discount", "CONF_PREDICADO", "l_discount <= 0.05 AND l_tax < 0.08", 50.0,
                         pred="l_discount <= 0.05 AND l_tax < 0.08")], {}),
    "filter_then_check": ([R("orders", "o_totalprice", "VAL_RANGO_VALORES", "5000,400000", 95.0,
                             filters="o_orderstatus = 'F'", pred="o_totalprice BETWEEN 5000 AND 400000"),
                           R("orders", "o_custkey", "COM_DUPLICADOS", filters="o_orderstatus = 'F'",
                             kind="unique"),
                           R("lineitem", "l_quantity", "VAL_POSITIVOS",
                             filters="l_shipdate >= '1999-01-01' AND l_returnflag = 'R'",
                             ofilter="l_shipdate >= TIMESTAMP '1999-01-01' AND l_returnflag = 'R'",
                             pred="l_quantity IS NULL OR l_quantity >= 0")], {}),
    "check_after_empty_filter": ([R("orders", "o_orderkey", "COM_NULOS", filters="o_orderstatus = 'Z'",
                                    pred="o_orderkey IS NOT NULL"),
                                  R("orders", "o_custkey", "COM_DUPLICADOS", filters="o_orderstatus = 'Z'",
                                    kind="unique"),
                                  R("orders", "no_such_column", "COM_NULOS", filters="o_orderstatus = 'Z'",
                                    pred="false")], {}),
    "report_cached": ([R("doc_labels", "rating", "VAL_PERMITIDOS", "1", 50.0,
                         pred="rating IS NULL OR CAST(rating AS VARCHAR) IN ('1')"),
                       R("doc_labels", "lang", "COM_OBLIGATORIO", pred="trim(lang) <> '' AND lang IS NOT NULL"),
                       R("doc_labels", "doc_id", "COM_DUPLICADOS", kind="unique")], {"cache": True}),
    "report_guarded_filters": (GUARDED_RULES, {}),
    "report_guarded_filters_lazy": (GUARDED_RULES, {"eager": False}),
    "report_many_rules": (MANY_RULES, {}),
    "chk_unique_bitmaps": (KEY_RULES, {"key_bitmaps": True}),
    "check_groups": ([R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "1,25", 50.0, filters="l_returnflag = 'R'",
                        pred="l_quantity BETWEEN 1 AND 25"),
                      R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "1,25", 50.0, filters="l_returnflag = 'A'",
                        pred="l_quantity BETWEEN 1 AND 25"),
                      R("lineitem", "l_discount", "VAL_RANGO_VALORES", "0,0.05", 50.0, filters="l_returnflag = 'A'",
                        pred="l_discount BETWEEN 0 AND 0.05"),
                      R("lineitem", "l_orderkey", "COM_NULOS", pred="l_orderkey IS NOT NULL"),
                      R("orders", "o_totalprice", "VAL_RANGO_VALORES", "1000,100000", 10.0,
                        filters="o_orderpriority = '1-URGENT'", pred="o_totalprice BETWEEN 1000 AND 100000"),
                      R("orders", "o_orderkey", "COM_DUPLICADOS", filters="o_orderpriority = '1-URGENT'",
                        kind="unique")], {}),
    "report_orders": (ORDERS_RULES, {}),
    "report_two_groups": (ORDERS_RULES[:4] + LINEITEM_RULES[:4], {}),
    "report_lineitem_fused": (LINEITEM_RULES, {}),
    "report_remarks": ([R("orders", "o_orderstatus", "VAL_PERMITIDOS", "F,O", 97.25,
                          pred="o_orderstatus IS NULL OR o_orderstatus IN ('F', 'O')"),
                        R("orders", "o_orderstatus", "VAL_PERMITIDOS", "F", 0.0001,
                          pred="o_orderstatus IS NULL OR o_orderstatus IN ('F')"),
                        R("orders", "o_orderstatus", "VAL_PERMITIDOS", "O", 1e-05,
                          pred="o_orderstatus IS NULL OR o_orderstatus IN ('O')"),
                        R("orders", "o_orderstatus", "VAL_PERMITIDOS", "P", 12345678.9,
                          pred="o_orderstatus IS NULL OR o_orderstatus IN ('P')"),
                        R("orders", "o_orderpriority", "VAL_PERMITIDOS", "1-URGENT,2-HIGH", None,
                          pred="o_orderpriority IS NULL OR o_orderpriority IN ('1-URGENT', '2-HIGH')"),
                        R("orders", "o_orderstatus", "VAL_PERMITIDOS", "O,P", 1e16,
                          pred="o_orderstatus IS NULL OR o_orderstatus IN ('O', 'P')"),
                        R("orders", "o_custkey", "COM_DUPLICADOS", threshold=5.0, kind="unique")], {}),
    "report_events": ([R("events", "event_id", "COM_DUPLICADOS", kind="unique"),
                       R("events", "event_type", "VAL_PERMITIDOS", "view,click,purchase", 60.0,
                         pred="event_type IS NULL OR event_type IN ('view', 'click', 'purchase')"),
                       R("events", "value", "VAL_RANGO_VALORES", "1,400", 90.0, pred="value BETWEEN 1 AND 400"),
                       R("events", "value", "VAL_POSITIVOS", pred="value IS NULL OR value >= 0"),
                       R("events", "props", "CONF_REGEX", r'^\{"k": [0-9]+\}$', 99.0,
                         pred=r"""regexp_extract(props, '^\{"k": [0-9]+\}$', 0) <> ''"""),
                       R("events", "ts", "VAL_RANGO_VALORES", "'2024-01-01','2024-01-15'", 50.0,
                         filters="event_type = 'error'",
                         pred="ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-15'"),
                       R("events", "user_id", "COM_DUPLICADOS", threshold=0.0, filters="event_type = 'purchase'",
                         kind="unique")], {}),
    "report_conversations": ([R("conversations", "role", "VAL_PERMITIDOS", "user,assistant", 95.0,
                                pred="role IS NULL OR role IN ('user', 'assistant')"),
                              R("conversations", "text", "COM_OBLIGATORIO",
                                pred="trim(text) <> '' AND text IS NOT NULL"),
                              R("conversations", "turn", "VAL_POSITIVOS", pred="turn IS NULL OR turn >= 0"),
                              R("conversations", "turn", "VAL_RANGO_VALORES", "0,5", 90.0, pred="turn BETWEEN 0 AND 5"),
                              R("conversations", "text", "CONF_REGEX", r"\?", 10.0,
                                pred=r"regexp_extract(text, '\?', 0) <> ''"),
                              R("conversations", "conv_id", "COM_DUPLICADOS", threshold=0.0, kind="unique")], {}),
    "report_pages": ([R("pages", "page_id", "COM_DUPLICADOS", kind="unique"),
                      R("pages", "url", "COM_DUPLICADOS", kind="unique"),
                      R("pages", "url", "CONF_REGEX", "^https://", 50.0,
                        pred="regexp_extract(url, '^https://', 0) <> ''"),
                      R("pages", "html", "CONF_REGEX", "<title>[^<]+</title>",
                        pred="regexp_extract(html, '<title>[^<]+</title>', 0) <> ''"),
                      R("pages", "html", "CONF_REGEX", EMAIL, 0.0, pred=f"regexp_extract(html, '{EMAIL}', 0) <> ''"),
                      R("pages", "html", "COM_OBLIGATORIO", pred="trim(html) <> '' AND html IS NOT NULL")], {}),
    "report_embeddings": ([R("embeddings", "vec_id", "COM_DUPLICADOS", kind="unique"),
                           R("embeddings", "embedding", "COM_NULOS", pred="embedding IS NOT NULL"),
                           R("embeddings", "label", "VAL_RANGO_VALORES", "0,8", 80.0, pred="label BETWEEN 0 AND 8"),
                           R("embeddings", "label", "VAL_PERMITIDOS", "1,3,5,7,9", 40.0,
                             pred="label IS NULL OR CAST(label AS VARCHAR) IN ('1', '3', '5', '7', '9')")], {}),
    "report_threshold_policy": ([R("customer", "c_acctbal", "VAL_POSITIVOS", threshold=90.0,
                                   pred="c_acctbal IS NULL OR c_acctbal >= 0"),
                                 R("customer", "c_acctbal", "VAL_POSITIVOS", threshold=95.0,
                                   pred="c_acctbal IS NULL OR c_acctbal >= 0"),
                                 R("customer", "c_mktsegment", "VAL_PERMITIDOS", "BUILDING,MACHINERY", 40.0,
                                   pred="c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'MACHINERY')"),
                                 R("customer", "c_nationkey", "COM_DUPLICADOS", threshold=0.0, kind="unique"),
                                 R("customer", "c_custkey", "COM_DUPLICADOS", threshold=None, kind="unique")],
                                {"policy": "threshold"}),
    "report_unknown_method": ([R("orders", "o_orderkey", "COM_NULOS", pred="o_orderkey IS NOT NULL"),
                               R("orders", "o_totalprice", "VAL_MAYOR_CERO", kind="skip",
                                 message="Método 'isPositive()' no soportado"),
                               R("orders", "o_custkey", "COM_INEXISTENTE", kind="skip",
                                 message="Método 'None' no soportado"),
                               R("orders", "o_totalprice", "VAL_POSITIVOS",
                                 pred="o_totalprice IS NULL OR o_totalprice >= 0")], {}),
    "report_invalid_params": ([R("customer", "c_acctbal", "VAL_RANGO_VALORES", "0", kind="skip",
                                 message="Parámetros inválidos para el método between()."),
                               R("customer", "c_acctbal", "VAL_RANGO_VALORES", "0,1,2", kind="skip",
                                 message="Parámetros inválidos para el método between()."),
                               R("customer", "c_mktsegment", "VAL_PERMITIDOS", ", ,", kind="skip",
                                 message="Parámetros inválidos para el método isContainedIn()."),
                               R("customer", "c_name", "CONF_REGEX", "", kind="skip",
                                 message="Parámetros inválidos para el método hasPattern()."),
                               R("customer", "c_name", "COM_BLANCOS", "", kind="skip",
                                 message="Parámetros inválidos para el método hasPattern()."),
                               R("customer", "c_name", "CONF_LONG_EXACTA", "abc", kind="skip",
                                 message="Parámetros inválidos para el método lengthEquals()."),
                               R("customer", "c_acctbal", "VAL_POSITIVOS", threshold=90.0,
                                 pred="c_acctbal IS NULL OR c_acctbal >= 0")], {}),
}


# ---------------------------------------------------------------------------------------
# Queries with their own shape
# ---------------------------------------------------------------------------------------
def _missing_table_rules() -> list[R]:
    return [R("no_such_table", "x", "COM_NULOS"),
            R("orders", "o_orderkey", "COM_NULOS", filters="no_such_column > 1"),
            R("orders", "o_orderkey", "COM_NULOS", pred="o_orderkey IS NOT NULL")]


def q_report_missing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = _run(_missing_table_rules())(spark, sf_dir)
    return res.withColumn("observacion_tecnica", F.substring_index("observacion_tecnica", ": ", 1))


def o_report_missing_table() -> str:
    good = _oracle_rule(_missing_table_rules()[2])
    errors = [("no_such_table", "x"), ("orders", "o_orderkey")]
    lits = "\nUNION ALL\n".join(
        f"SELECT '{t}' AS id_calidad_tabla, '{c}' AS columna, '' AS parametros, CAST(100.0 AS DOUBLE) AS umbral, "
        f"'ERROR_EJECUCION' AS estado_calidad, CAST(0 AS BIGINT) AS total_registros, "
        f"CAST(0 AS BIGINT) AS registros_fallidos, CAST(0.0 AS DOUBLE) AS porcentaje_cumplimiento, "
        f"'Error fatal procesando {SCHEMA}.{t}' AS observacion_tecnica" for t, c in errors)
    return f"SELECT * REPLACE (split_part(observacion_tecnica, ': ', 1) AS observacion_tecnica) FROM ({good})\n" \
           f"UNION ALL\n{lits}"


_BROKEN = [
    R("orders", "o_totalprice", "CONF_PREDICADO", "max(o_totalprice) > 0", kind="skip", message=MSG_NOT_EVALUABLE),
    R("orders", "o_orderkey", "COM_NULOS", pred="o_orderkey IS NOT NULL"),
    R("orders", "o_totalprice", "CONF_PREDICADO", "row_number() OVER (ORDER BY o_orderkey) > 1", kind="skip",
      message=MSG_NOT_EVALUABLE),
    R("orders", "no_such_column", "COM_DUPLICADOS", kind="skip", message=MSG_NOT_EVALUABLE),
    R("orders", "o_custkey", "COM_DUPLICADOS", threshold=50.0, kind="unique"),
]


def _q_broken(eager: bool):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        res = _run(_BROKEN, eager=eager)(spark, sf_dir)
        return res.withColumn("observacion_tecnica", F.substring_index("observacion_tecnica", ": ", 1))
    return q


def o_report_broken_rules() -> str:
    return (f"SELECT * REPLACE (split_part(observacion_tecnica, ': ', 1) AS observacion_tecnica) "
            f"FROM ({_oracle(_BROKEN)})")


def _q_failing(eager: bool):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        res = _run(FAILING_RULES, eager=eager)(spark, sf_dir)
        return res.withColumn("observacion_tecnica", F.substring_index("observacion_tecnica", ": ", 1))
    return q


def o_report_failing_rows() -> str:
    return (f"SELECT * REPLACE (split_part(observacion_tecnica, ': ', 1) AS observacion_tecnica) "
            f"FROM ({_oracle(FAILING_RULES)})")


def q_report_session_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders rules over a table of the session's catalog, as most users run them."""
    loc = fresh_path(spark, "session-db")
    db = "qualia_" + os.path.basename(loc).replace("-", "_")
    save_table(_read(spark, sf_dir, "orders"), db, "orders", location=loc)
    try:
        rules = _rules_df(spark, [replace(r, schema=db) for r in ORDERS_RULES])
        return run_rules(spark, rules, _catalog(spark), stamps=False)
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")


def q_report_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = {"control": _rules_df(spark, _ACTIVE), "methods": _catalog(spark)}
    return transform(spark, inputs, {"dataset": "supplier"}, tables=_tables(spark, sf_dir), stamps=False)


_OWN_CHECK = [
    R("part", "p_size", "CONF_MULTIPLO", "5", 10.0, pred="p_size % 5 = 0"),
    R("part", "p_size", "CONF_MULTIPLO", "five", kind="skip",
      message="Parámetros inválidos para el método isMultipleOf()."),
]


def _multiple_of(ctx: CheckContext) -> Check | None:
    if not ctx.params.isdigit() or int(ctx.params) == 0:
        return None
    ok = F.coalesce(F.pmod(ctx.col, F.lit(int(ctx.params))) == 0, F.lit(False))
    return Check(ROW, ctx.column, "Compliance", f"{ctx.column} multiple of {ctx.params}", ok)


def q_report_own_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_check("ismultipleof", _multiple_of)
    return _run(_OWN_CHECK)(spark, sf_dir)


_OWN_AGGREGATE = [
    R("lineitem", "l_quantity", "CONF_SUMA", "0, 1000000000", pred="CASE WHEN sum(l_quantity) BETWEEN 0 AND 1000000000 THEN 1 ELSE 0 END", kind="metric"),
    R("lineitem", "l_quantity", "CONF_SUMA", "0, 10", pred="CASE WHEN sum(l_quantity) BETWEEN 0 AND 10 THEN 1 ELSE 0 END", kind="metric"),
    R("lineitem", "l_quantity", "CONF_PESO", "l_returnflag = 'N'", 40.0, kind="metric",
      pred="sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) / sum(l_quantity)"),
    R("lineitem", "l_quantity", "CONF_PESO", "l_returnflag = 'N'", 40.0, filters="l_linestatus = 'O'", kind="metric",
      pred="sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) / sum(l_quantity)"),
    R("lineitem", "l_quantity", "CONF_PESO", "l_returnflag = 'N'", 40.0, filters="l_linestatus = 'Z'", kind="metric",
      pred="sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) / sum(l_quantity)"),
    R("lineitem", "l_quantity", "CONF_SUMA", "0", kind="skip", message="Parámetros inválidos para el método sumBetween()."),
    R("lineitem", "l_quantity", "VAL_RANGO_VALORES", "5,45", 90.0, pred="l_quantity BETWEEN 5 AND 45"),
    R("orders_n", "o_nothing", "CONF_PESO", "true", 40.0, kind="metric", pred="CAST(NULL AS DOUBLE)"),
]


def _sum_between(ctx: CheckContext) -> Check | None:
    if len(ctx.param_list) != 2:
        return None
    lo, hi = (F.lit(float(p)) for p in ctx.param_list)
    return Check(AGGREGATE, ctx.column, "Sum", f"sum({ctx.column}) between {ctx.params}", aggregates={"s": f"sum({ctx.column})"},
                 finish=lambda a: F.when(a["s"].between(lo, hi), 1.0).when(a["s"].isNotNull(), 0.0))


def _weighted_share(ctx: CheckContext) -> Check | None:
    x = f"try_cast({ctx.column} AS DOUBLE)"
    return Check(AGGREGATE, ctx.column, "WeightedShare", f"{ctx.column} where {ctx.params}",
                 aggregates={"hit": f"sum(CASE WHEN {ctx.params} THEN {x} ELSE 0 END)", "all": f"sum({x})"},
                 finish=lambda a: F.when(a["all"] != 0, a["hit"] / a["all"]))


def _q_own_aggregate(eager: bool):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_check("sumbetween", _sum_between)
        register_check("weightedshare", _weighted_share)
        return _run(_OWN_AGGREGATE, eager=eager)(spark, sf_dir)
    return q


_NO_CAT = [R("orders", "o_orderkey", "COM_NULOS", kind="skip", message="Método 'None' no soportado"),
           R("orders", "o_custkey", "COM_DUPLICADOS", kind="skip", message="Método 'None' no soportado"),
           R("customer", "c_acctbal", "VAL_POSITIVOS", kind="skip", message="Método 'None' no soportado")]


def _standardize_rules() -> tuple[list[tuple], list[R]]:
    """Rule rows as raw text, with stray blanks and text flags / thresholds, and
    what they mean once standardized."""
    raw = [
        ("  customer ", f" {SCHEMA} ", " c_acctbal  ", " VAL_POSITIVOS", " ", None, "true", " 97.5 "),
        ("customer", SCHEMA, "c_mktsegment", "VAL_PERMITIDOS ", " BUILDING , AUTOMOBILE ,, ", "  ", " TRUE", "80"),
        ("customer", SCHEMA, "c_name", "COM_OBLIGATORIO", "", "", "1", "99,5"),
        ("customer", SCHEMA, "c_custkey", "COM_DUPLICADOS", None, None, "S", "100"),
        ("customer", SCHEMA, "c_nationkey", "COM_NULOS", None, None, None, "100"),
        ("customer", SCHEMA, "c_acctbal", "VAL_RANGO_VALORES", " -500 , 5000 ", " c_mktsegment = 'BUILDING' ",
         "yes", "not a number"),
    ]
    meant = [
        R("customer", "c_acctbal", "VAL_POSITIVOS", "", 97.5, pred="c_acctbal IS NULL OR c_acctbal >= 0"),
        R("customer", "c_mktsegment", "VAL_PERMITIDOS", "BUILDING , AUTOMOBILE ,,", 80.0,
          pred="c_mktsegment IS NULL OR c_mktsegment IN ('BUILDING', 'AUTOMOBILE')"),
        R("customer", "c_name", "COM_OBLIGATORIO", "", None, pred="trim(c_name) <> '' AND c_name IS NOT NULL"),
        R("customer", "c_acctbal", "VAL_RANGO_VALORES", "-500 , 5000", None,
          filters="c_mktsegment = 'BUILDING'", pred="c_acctbal BETWEEN -500 AND 5000"),
    ]
    return raw, meant


# --- Fixed values: columns of the rule table, all as text
RAW_RULE_DDL = ("id_calidad_tabla string, coleccion string, nombre_columna string, id_calidad_regla string, "
                "parametros string, filtros string, estado string, umbral string")


def q_rules_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, _ = _standardize_rules()
    rules = spark.createDataFrame(raw, RAW_RULE_DDL)
    return run_rules(spark, rules, _catalog(spark), tables=_tables(spark, sf_dir), stamps=False)


def _messy_catalog(spark: SparkSession) -> DataFrame:
    rows = [(f"  {c} ", f" {d}", f"{t} ", m) for c, d, t, m in [
        ("COM_NULOS", "completitud", "nulos", "  IsComplete() "),
        ("COM_DUPLICADOS", "completitud", "unicidad", "ISUNIQUE"),
        ("VAL_PERMITIDOS", "validez", "permitidos", "isContainedIn()()"),
        ("VAL_POSITIVOS", "validez", "positivos", "isnonnegative()"),
        ("CONF_LONG_EXACTA", "conformidad", "longitud", "lengthEquals ()"),
    ]]
    return spark.createDataFrame(rows, "id_calidad_regla string, dimension string, descripcion string, metodo string")


_CAT_STD = [
    R("part", "p_partkey", "COM_NULOS", pred="p_partkey IS NOT NULL"),
    R("part", "p_partkey", "COM_DUPLICADOS", kind="unique"),
    R("part", "p_type", "VAL_PERMITIDOS", "STANDARD", kind="skip",
      message="Método 'isContainedIn()()' no soportado"),
    R("part", "p_retailprice", "VAL_POSITIVOS", pred="p_retailprice IS NULL OR p_retailprice >= 0"),
    R("part", "p_brand", "CONF_LONG_EXACTA", "8", kind="skip", message="Método 'lengthEquals ()' no soportado"),
]


def q_catalog_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_rules(spark, _rules_df(spark, _CAT_STD), _messy_catalog(spark),
                     tables=_tables(spark, sf_dir), stamps=False)


_CAT_CSV = [
    R("part", "p_brand", "CONF_LONG_EXACTA", "8", 60.0, pred="length(p_brand) = 8"),
    R("part", "p_size", "CONF_PREDICADO", "p_retailprice > p_size * 30", 40.0, pred="p_retailprice > p_size * 30"),
    R("part", "p_name", "COM_NULOS_LISTA", pred="p_name IS NOT NULL"),
]


def q_catalog_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "catalog")
    # columns in another order, and one more
    _catalog(spark).selectExpr("metodo", "'x' AS nota", "id_calidad_regla", "descripcion", "dimension") \
        .coalesce(1).write.option("header", True).csv(path)
    cat = read_catalog_csv(spark, path)
    return run_rules(spark, _rules_df(spark, _CAT_CSV), cat, tables=_tables(spark, sf_dir), stamps=False)


_ACTIVE = [
    R("orders", "o_orderkey", "COM_NULOS", pred="o_orderkey IS NOT NULL"),
    R("orders", "o_custkey", "COM_DUPLICADOS", active=False, kind="unique"),
    R("orders", "o_orderstatus", "VAL_PERMITIDOS", "F,O", 50.0, active=None,
      pred="o_orderstatus IS NULL OR o_orderstatus IN ('F','O')"),
    R("orders", "o_totalprice", "VAL_RANGO_VALORES", "2000,300000", 50.0,
      pred="o_totalprice BETWEEN 2000 AND 300000"),
    R("supplier", "s_acctbal", "VAL_POSITIVOS", threshold=90.0, pred="s_acctbal IS NULL OR s_acctbal >= 0"),
    R("supplier", "s_suppkey", "COM_DUPLICADOS", kind="unique"),
    R("nation", "n_name", "COM_NULOS", active=False, pred="n_name IS NOT NULL"),
]


def _q_active(dataset: str | None):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_rules(spark, _rules_df(spark, _ACTIVE), _catalog(spark), dataset=dataset,
                         tables=_tables(spark, sf_dir), stamps=False)
    return q


_JOIN = [
    R("supplier", "s_acctbal", "VAL_POSITIVOS", threshold=90.0, pred="s_acctbal IS NULL OR s_acctbal >= 0"),
    R("supplier", "s_name", "SIN_CODIGO", kind="skip", message="Método 'None' no soportado"),
    R("supplier", "s_name", "COM_OBLIGATORIO", pred="trim(s_name) <> '' AND s_name IS NOT NULL"),
    R("supplier", "s_nationkey", "COM_DUPLICADOS", threshold=0.0, kind="unique"),
]

_METRIC_RULES = CUSTOMER_RULES


def q_metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = evaluate_rules(spark, _rules_df(spark, _METRIC_RULES), _catalog(spark), tables=_tables(spark, sf_dir))
    return metric_report(m)


def o_metric_report() -> str:
    parts = []
    inst = {"c_custkey": ("c_custkey", "Uniqueness"),
            "c_acctbal": ("c_acctbal is non-negative", "Compliance"),
            "c_mktsegment": ("c_mktsegment contained in BUILDING,MACHINERY,HOUSEHOLD", "Compliance"),
            "c_name": ("trim(c_name) != '' AND c_name IS NOT NULL", "Compliance")}
    for i, r in enumerate(_METRIC_RULES):
        instance, name = inst[r.column]
        parts.append(f"SELECT '{r.code}:{r.column}:{i}' AS \"check\", 'Column' AS entity, {_lit(instance)} AS instance, "
                     f"'{name}' AS name, passed::DOUBLE / denom AS value FROM ({_stats(r)})")
    return "\nUNION ALL\n".join(parts)


def q_check_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _METRIC_RULES + [R("customer", "no_such_column", "COM_NULOS")]
    m = evaluate_rules(spark, _rules_df(spark, rules), _catalog(spark), tables=_tables(spark, sf_dir))
    text = F.col("constraint_message")
    return check_outcomes(m).withColumn("constraint_message", F.when(
        text.startswith(MSG_NOT_EVALUABLE), F.lit(MSG_NOT_EVALUABLE)).otherwise(text))


def o_check_outcomes() -> str:
    inst = {"c_custkey": "Uniqueness(c_custkey)",
            "c_acctbal": "Compliance(c_acctbal is non-negative)",
            "c_mktsegment": "Compliance(c_mktsegment contained in BUILDING,MACHINERY,HOUSEHOLD)",
            "c_name": "Compliance(trim(c_name) != '' AND c_name IS NOT NULL)"}
    parts = []
    for i, r in enumerate(_METRIC_RULES):
        parts.append(
            f"SELECT '{r.code}:{r.column}:{i}' AS \"check\", 'Warning' AS check_level, {_lit(inst[r.column])} AS \"constraint\", "
            f"CASE WHEN passed = denom THEN 'Success' ELSE 'Failure' END AS constraint_status, "
            f"CASE WHEN passed = denom THEN '' ELSE 'Value: ' || CAST(passed::DOUBLE / denom AS VARCHAR) "
            f"|| ' does not meet the constraint requirement!' END AS constraint_message FROM ({_stats(r)})")
    parts.append(f"SELECT 'COM_NULOS:no_such_column:{len(_METRIC_RULES)}', 'Warning', 'isComplete(no_such_column)', "
                 f"'Failure', {_lit(MSG_NOT_EVALUABLE)}")
    return "\nUNION ALL\n".join(parts)


_STAMP = ORDERS_RULES[:3]


def q_result_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = run_rules(spark, _rules_df(spark, _STAMP), _catalog(spark), tables=_tables(spark, sf_dir), as_of=AS_OF)
    return res.withColumn("fecha_proceso", F.date_format("fecha_proceso", "yyyy-MM-dd HH:mm:ss"))


def o_result_stamp() -> str:
    return (f"SELECT DATE '2026-01-31' AS periodo, '2026-01-31 08:30:00' AS fecha_proceso, * "
            f"FROM ({_oracle(_STAMP)})")


def q_result_export_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = run_rules(spark, _rules_df(spark, _STAMP), _catalog(spark), tables=_tables(spark, sf_dir), as_of=AS_OF)
    return export_format(res)


def o_result_export_format() -> str:
    return (f"SELECT '2026-01-31' AS periodo, '2026-01-31 08:30:00.000' AS fecha_proceso, * "
            f"FROM ({_oracle(_STAMP)})")


_ROUNDTRIP = ORDERS_RULES[:2] + CUSTOMER_RULES[1:3]


def _kept(df: DataFrame) -> DataFrame:
    """A result (one row per rule) that outlives the place that it was read from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as a table, written again over rows read from it, and read back."""
    res = run_rules(spark, _rules_df(spark, _ROUNDTRIP), _catalog(spark), tables=_tables(spark, sf_dir), as_of=AS_OF)
    loc = fresh_path(spark, "db")
    db = "qualia_" + os.path.basename(loc).replace("-", "_")
    try:
        name = save_table(res, db, "resultados", location=loc)
        name = save_table(spark.table(name), db, "resultados")
        return _kept(spark.table(name).select(*RESULT_BODY_COLUMNS))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def q_result_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV twice, the second in place of the first, and read back."""
    res = run_rules(spark, _rules_df(spark, _ROUNDTRIP), _catalog(spark), tables=_tables(spark, sf_dir), as_of=AS_OF)
    path = fresh_path(spark, "result-csv")
    write_result_csv(res.where("columna = 'c_acctbal'"), path)
    write_result_csv(res, path)
    return read_result_csv(spark, path).select(*RESULT_BODY_COLUMNS)


# ---------------------------------------------------------------------------------------
# Contract
# ---------------------------------------------------------------------------------------
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the orders report (nine rules, one fused scan + one uniqueness query)."""
    return queries()["report_orders"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for key, (rules, kw) in Q.items():
        out[key] = _run(rules, **kw)
    out["report_missing_table"] = q_report_missing_table
    out["report_lazy_two_groups"] = _run(Q["report_two_groups"][0] + CUSTOMER_RULES, eager=False)
    out["report_broken_rules"] = _q_broken(True)
    out["report_broken_rules_lazy"] = _q_broken(False)
    out["report_session_tables"] = q_report_session_tables
    out["report_bundle"] = q_report_bundle
    out["report_own_check"] = q_report_own_check
    out["report_own_aggregate"] = _q_own_aggregate(True)
    out["report_own_aggregate_lazy"] = _q_own_aggregate(False)
    out["report_failing_rows"] = _q_failing(True)
    out["report_failing_rows_lazy"] = _q_failing(False)
    out["report_no_catalog"] = _run(_NO_CAT, catalog="none")
    out["rules_standardize"] = q_rules_standardize
    out["catalog_standardize"] = q_catalog_standardize
    out["catalog_csv_scan"] = q_catalog_csv_scan
    out["rules_active_one_table"] = _q_active("orders")
    out["rules_active_all"] = _q_active(None)
    out["rules_catalog_join"] = _run(_JOIN)
    out["metric_report"] = q_metric_report
    out["check_outcomes"] = q_check_outcomes
    out["result_stamp"] = q_result_stamp
    out["result_export_format"] = q_result_export_format
    out["table_roundtrip"] = q_table_roundtrip
    out["result_csv_roundtrip"] = q_result_csv_roundtrip
    if _corpus is not None:
        out.update(_corpus.QUERIES)
        out["pipeline"] = _pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = {key: _oracle(rules, kw.get("policy", "strict")) for key, (rules, kw) in Q.items()}
    out["report_missing_table"] = o_report_missing_table()
    out["report_lazy_two_groups"] = _oracle(Q["report_two_groups"][0] + CUSTOMER_RULES)
    out["report_broken_rules"] = out["report_broken_rules_lazy"] = o_report_broken_rules()
    out["report_session_tables"] = _oracle(ORDERS_RULES)
    out["report_bundle"] = _oracle([r for r in _ACTIVE if r.table == "supplier"])
    out["report_own_check"] = _oracle(_OWN_CHECK)
    out["report_own_aggregate"] = out["report_own_aggregate_lazy"] = _oracle(_OWN_AGGREGATE)
    out["report_failing_rows"] = out["report_failing_rows_lazy"] = o_report_failing_rows()
    out["report_no_catalog"] = _oracle(_NO_CAT)
    out["rules_standardize"] = _oracle(_standardize_rules()[1])
    out["catalog_standardize"] = _oracle(_CAT_STD)
    out["catalog_csv_scan"] = _oracle(_CAT_CSV)
    out["rules_active_one_table"] = _oracle([r for r in _ACTIVE if r.table == "orders"])
    out["rules_active_all"] = _oracle(_ACTIVE)
    out["rules_catalog_join"] = _oracle(_JOIN)
    out["metric_report"] = o_metric_report()
    out["check_outcomes"] = o_check_outcomes()
    out["result_stamp"] = o_result_stamp()
    out["result_export_format"] = o_result_export_format()
    out["table_roundtrip"] = _oracle(_ROUNDTRIP)
    out["result_csv_roundtrip"] = _oracle(_ROUNDTRIP)
    if _corpus is not None:
        out.update(_corpus.ORACLES)
        if _pipeline.ORACLE_SQL is not None:
            out["pipeline"] = _pipeline.ORACLE_SQL
    return out
