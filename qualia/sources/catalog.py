"""Method catalog: maps a rule code to a dimension and a check method."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.functions.text import normalize_method_col
from qualia.schema import CATALOG_SCHEMA

# --- Fixed values: the shipped catalog (code, dimension, description, method) ----------
DEFAULT_CATALOG = [
    ("COM_NULOS", "completitud", "Valida la cantidad de nulos", "isComplete()"),
    ("COM_DUPLICADOS", "completitud", "Valida la unicidad de la columna", "isUnique()"),
    ("COM_BLANCOS", "completitud", "Valida si el campo contiene espacios en blanco", "hasPattern()"),
    ("VAL_PERMITIDOS", "validez", "Valida que el valor pertenezca al catálogo permitido", "isContainedIn()"),
    ("VAL_POSITIVOS", "validez", "Verifica que los valores sean mayores o iguales a cero", "isNonNegative()"),
    ("VAL_RANGO_VALORES", "validez", "Valida que el valor esté dentro del rango parametrizado", "between()"),
    ("CONF_LONG_EXACTA", "conformidad", "Valida la longitud exacta parametrizada", "lengthEquals()"),
    ("CONF_REGEX", "conformidad", "Valida el formato mediante expresión regular", "hasPattern()"),
    ("COM_OBLIGATORIO", "completitud",
     "Valida que el dato no sea nulo ni contenga únicamente espacios en blanco", "notNullOrEmpty()"),
]


def _local(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Catalog rows as a local relation (from an Arrow table): its size is known to
    the optimizer, which can then pick a broadcast join by measured size."""
    cols = list(zip(*rows)) if rows else [[] for _ in CATALOG_SCHEMA.fields]
    table = pa.table({f.name: pa.array(list(c), type=pa.string()) for f, c in zip(CATALOG_SCHEMA.fields, cols)})
    return spark.createDataFrame(table, CATALOG_SCHEMA)


def default_catalog(spark: SparkSession, extra: list[tuple] | None = None) -> DataFrame:
    """The shipped catalog as a DataFrame (plus optional extra rows)."""
    return _local(spark, DEFAULT_CATALOG + list(extra or []))


def empty_catalog(spark: SparkSession) -> DataFrame:
    return _local(spark, [])


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV with a header; every column read as text (no inference). The four
    columns are taken by their header names, in any order; further columns are left out."""
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return rows.select(*CATALOG_SCHEMA.fieldNames())


def write_catalog_csv(catalog: DataFrame, path: str) -> None:
    """Write a catalog as one CSV file with a header (a catalog is a handful of rows)."""
    catalog.select(*CATALOG_SCHEMA.fieldNames()).coalesce(1).write.mode("overwrite") \
        .option("header", True).csv(path)


def standardize_catalog(catalog: DataFrame) -> DataFrame:
    """Trim the four catalog columns and add the normalized method key."""
    return catalog.select(
        F.trim(F.col("id_calidad_regla").cast("string")).alias("id_calidad_regla"),
        F.trim(F.col("dimension").cast("string")).alias("dimension"),
        F.trim(F.col("descripcion").cast("string")).alias("catalog_description"),
        F.trim(F.col("metodo").cast("string")).alias("metodo"),
    ).withColumn("method_key", normalize_method_col(F.col("metodo")))
