"""Fixed schemas and texts of the rule engine."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- Fixed values: result schema, in this column order --------------------------------
RESULT_SCHEMA = StructType(
    [
        StructField("periodo", DateType(), True),
        StructField("fecha_proceso", TimestampType(), True),
        StructField("id_calidad_tabla", StringType(), True),
        StructField("columna", StringType(), True),
        StructField("parametros", StringType(), True),
        StructField("umbral", DoubleType(), True),
        StructField("estado_calidad", StringType(), True),
        StructField("total_registros", LongType(), True),
        StructField("registros_fallidos", LongType(), True),
        StructField("porcentaje_cumplimiento", DoubleType(), True),
        StructField("observacion_tecnica", StringType(), True),
    ]
)
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]
# Result columns without the run stamps: what a repeatable comparison looks at.
RESULT_BODY_COLUMNS = RESULT_COLUMNS[2:]
# Extra columns of the opt-in wide result.
WIDE_COLUMNS = ["coleccion", "id_calidad_regla", "dimension"]

# --- Fixed values: rule table input columns (name in the rule table, standard name) ---
RULE_COLUMNS = [
    ("id_calidad_tabla", "table_name"),
    ("coleccion", "schema"),
    ("nombre_columna", "column_name"),
    ("id_calidad_regla", "rule_code"),
    ("parametros", "params"),
    ("filtros", "filters"),
    ("estado", "is_active"),
    ("descripcion", "description"),
    ("umbral", "threshold"),
    ("macrodominio", "macro_domain"),
    ("dominio", "data_domain"),
    ("usuario_cambio", "changed_by"),
    ("fecha_cambio", "changed_at"),
]
REQUIRED_RULE_COLUMNS = ("id_calidad_tabla", "nombre_columna", "id_calidad_regla", "estado")

# --- Fixed values: catalog input columns -----------------------------------------------
CATALOG_INPUT_COLUMNS = ["id_calidad_regla", "dimension", "descripcion", "metodo"]
CATALOG_SCHEMA = StructType([StructField(c, StringType(), True) for c in CATALOG_INPUT_COLUMNS])

# --- Fixed values: statuses ---------------------------------------------------------------
CUMPLE = "CUMPLE"
NO_CUMPLE = "NO_CUMPLE"
NO_EVALUADA = "NO_EVALUADA"
ERROR_EJECUCION = "ERROR_EJECUCION"

# --- Fixed values: remark texts ------------------------------------------------------------
MSG_EMPTY = "Sin registros tras aplicar filtros; regla considerada cumplida."
MSG_OK = "Regla cumplida exitosamente."
MSG_ALERT_HEAD = "Alerta: Solo el "
MSG_ALERT_MID = "% de los datos cumple la regla. Se exigía el "
MSG_ALERT_TAIL = "%."
MSG_UNSUPPORTED = "Método '{method}' no soportado"
MSG_BAD_PARAMS = "Parámetros inválidos para el método {method}."
MSG_FATAL = "Error fatal procesando {table}: {error}"
MAX_ERROR_CHARS = 250

# Our own remarks (no counterpart text in the reference).
MSG_NO_VALUES = "Sin valores no nulos: la métrica no se puede calcular."
MSG_NOT_EVALUABLE = "Regla no evaluable: {error}"
MSG_ROW_ERRORS = "la expresión falla en {n} fila(s)"

# Check outcome vocabulary of the verification report.
SUCCESS = "Success"
FAILURE = "Failure"
