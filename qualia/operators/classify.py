"""From per-rule counts to the result row: status, failing rows, percentage, remark.

Input: the *metrics relation*, one row per rule (see ``METRICS_SCHEMA``). All of the
classification is Spark SQL expressions, so it runs wherever the metrics are (on
the driver, folded into a local relation, in the default eager mode).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from qualia.functions.text import PY_FLOAT_HELPERS, percent_text_sql, py_float_sql
from qualia.schema import (
    CUMPLE,
    ERROR_EJECUCION,
    FAILURE,
    MAX_ERROR_CHARS,
    MSG_ALERT_HEAD,
    MSG_ALERT_MID,
    MSG_ALERT_TAIL,
    MSG_EMPTY,
    MSG_NO_VALUES,
    MSG_OK,
    NO_CUMPLE,
    NO_EVALUADA,
    SUCCESS,
)

EVALUATED = "evaluated"
SKIPPED = "skipped"          # no check: unknown method, unusable parameters
UNRESOLVED = "unresolved"    # a check that could not run: unknown column, bad expression
ERROR = "error"

METRICS_SCHEMA = StructType([
    StructField("seq", LongType(), False),            # result order
    StructField("schema", StringType(), True),
    StructField("table_name", StringType(), True),
    StructField("column_name", StringType(), True),
    StructField("rule_code", StringType(), True),
    StructField("dimension", StringType(), True),
    StructField("metodo", StringType(), True),
    StructField("params", StringType(), True),
    StructField("threshold", DoubleType(), True),
    StructField("outcome", StringType(), False),      # evaluated / skipped / unresolved / error
    StructField("total", LongType(), True),           # rows after the row filter
    StructField("passed", LongType(), True),          # passing rows; unique values
    StructField("denom", LongType(), True),           # total; non-NULL rows (uniqueness)
    StructField("value", DoubleType(), True),         # metric of an aggregate check, instead of passed / denom
    StructField("message", StringType(), True),
    StructField("metric_name", StringType(), True),
    StructField("instance", StringType(), True),
    StructField("check_name", StringType(), True),
])

POLICIES = ("strict", "threshold")


def metric_value() -> Column:
    """The check's metric, a fraction in [0, 1]; NULL when nothing could be measured."""
    return F.coalesce("value", F.when(F.col("denom") > 0, F.col("passed").cast("double") / F.col("denom")))


def _sql_lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify(metrics: DataFrame, policy: str = "strict") -> DataFrame:
    """Add ``estado_calidad, registros_fallidos, porcentaje_cumplimiento,
    observacion_tecnica`` (and ``umbral``, ``parametros``) to a metrics relation.

    ``policy="strict"`` (default): a rule passes only if every row passes, whatever
    its threshold; the threshold is shown in the remark. ``policy="threshold"``:
    a rule passes when its percentage reaches the threshold.

    Each rule falls in one case (``__k``): E error, S skipped or not resolvable,
    Z no rows after the filter (also where the check could not run), N no metric (nothing to measure), C passed, F failed. The expressions
    are SQL text, one per column, so building them costs a handful of calls.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    ok = "coalesce(value = 1.0D, passed = denom)" if policy == "strict" else "__m * 100 >= umbral"
    umbral = "CAST(coalesce(threshold, 0.0D) AS DOUBLE)"
    _, helpers, thr_text = py_float_sql("umbral")
    # three projections: metric and threshold; case and number-text parts; outputs
    m = metrics.withColumns({
        "__m": F.expr("coalesce(value, CASE WHEN denom > 0 THEN CAST(passed AS DOUBLE) / denom END)"),
        "umbral": F.expr(umbral),
        PY_FLOAT_HELPERS[0]: F.expr(py_float_sql(umbral)[0]),
    })
    m = m.withColumns({
        "__k": F.expr(f"CASE WHEN outcome = '{ERROR}' THEN 'E' WHEN outcome = '{SKIPPED}' THEN 'S' "
                      f"WHEN total = 0 THEN 'Z' WHEN outcome = '{UNRESOLVED}' THEN 'S' WHEN __m IS NULL THEN 'N' WHEN {ok} THEN 'C' ELSE 'F' END"),
        **{k: F.expr(v) for k, v in helpers.items()},
    })
    alert = (f"concat({_sql_lit(MSG_ALERT_HEAD)}, {percent_text_sql('__m * 100')}, "
             f"{_sql_lit(MSG_ALERT_MID)}, {thr_text}, {_sql_lit(MSG_ALERT_TAIL)})")
    return m.withColumns({
        "id_calidad_tabla": F.col("table_name"),
        "columna": F.col("column_name"),
        "parametros": F.expr("coalesce(params, '')"),
        "estado_calidad": F.expr(
            f"CASE __k WHEN 'E' THEN '{ERROR_EJECUCION}' WHEN 'S' THEN '{NO_EVALUADA}' "
            f"WHEN 'Z' THEN '{CUMPLE}' WHEN 'N' THEN '{NO_EVALUADA}' WHEN 'C' THEN '{CUMPLE}' "
            f"ELSE '{NO_CUMPLE}' END"),
        "total_registros": F.expr("CAST(CASE WHEN __k = 'E' THEN 0 ELSE total END AS BIGINT)"),
        # failing rows as the metric implies: round half to even of total * (1 - metric)
        "registros_fallidos": F.expr(
            "CAST(CASE WHEN __k IN ('E', 'Z') THEN 0 WHEN __k IN ('S', 'N') THEN total "
            "ELSE bround(total * (1.0D - __m), 0) END AS BIGINT)"),
        "porcentaje_cumplimiento": F.expr(
            "CAST(CASE WHEN __k = 'Z' THEN 100.0D WHEN __k IN ('E', 'S', 'N') THEN 0.0D "
            "ELSE __m * 100 END AS DOUBLE)"),
        "observacion_tecnica": F.expr(
            f"CASE __k WHEN 'E' THEN substring(message, 1, {MAX_ERROR_CHARS}) WHEN 'S' THEN message "
            f"WHEN 'Z' THEN {_sql_lit(MSG_EMPTY)} WHEN 'N' THEN coalesce(message, {_sql_lit(MSG_NO_VALUES)}) "
            f"WHEN 'C' THEN {_sql_lit(MSG_OK)} ELSE {alert} END"),
    }).drop("__m", "__k", *PY_FLOAT_HELPERS)


def metric_report(metrics: DataFrame) -> DataFrame:
    """Computed metrics as a relation: ``check, entity, instance, name, value``
    (one row per evaluated rule that produced a metric)."""
    m = metric_value()
    return (metrics.where((F.col("outcome") == EVALUATED) & m.isNotNull())
            .select(F.col("check_name").alias("check"), F.lit("Column").alias("entity"),
                    F.col("instance"), F.col("metric_name").alias("name"), m.alias("value")))


def check_outcomes(metrics: DataFrame) -> DataFrame:
    """One row per check: ``check, check_level, constraint, constraint_status,
    constraint_message``. Success only for a metric of exactly 1.0 (every row passes). A
    check that could not run is a Failure with its error; a rule that makes no check
    (unknown method, unusable parameters) has no row."""
    m = metric_value()
    ok = m.isNotNull() & F.coalesce(F.col("value") == 1.0, F.col("passed") == F.col("denom"))
    message = (F.when(ok, F.lit(""))
               .when(m.isNull(), F.coalesce(F.col("message"), F.lit(MSG_NO_VALUES)))
               .otherwise(F.concat(F.lit("Value: "), m.cast("string"),
                                   F.lit(" does not meet the constraint requirement!"))))
    name = F.coalesce(F.col("metric_name"), F.regexp_replace("metodo", r"\(\)$", ""))
    instance = F.coalesce(F.col("instance"), F.col("column_name"))
    return (metrics.where(F.col("outcome").isin(EVALUATED, UNRESOLVED))
            .select(F.col("check_name").alias("check"), F.lit("Warning").alias("check_level"),
                    F.concat(name, F.lit("("), instance, F.lit(")")).alias("constraint"),
                    F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("constraint_status"),
                    message.alias("constraint_message")))
