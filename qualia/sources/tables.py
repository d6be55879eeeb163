"""How a rule's (schema, table) becomes a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

TableSource = DataFrame | Callable[[SparkSession], DataFrame]


def full_table_name(schema: str | None, table: str | None) -> str:
    """``schema.table``; a missing schema gives the table name alone."""
    return f"{schema}.{table}" if schema else f"{table}"


class TableResolver:
    """Finds the table of a rule group.

    A ``tables`` mapping (keys ``schema.table`` or ``table``) wins; otherwise the
    name is looked up in the session catalog with ``spark.table``. Lookups are
    lazy plans: nothing is read until the group's aggregate runs.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, TableSource] | None = None):
        self.spark = spark
        self.tables = dict(tables or {})

    def __call__(self, schema: str | None, table: str | None) -> DataFrame:
        if table is None:
            raise ValueError("rule without a table name")
        for key in (full_table_name(schema, table), table):
            if key in self.tables:
                src = self.tables[key]
                return src(self.spark) if callable(src) else src
        return self.spark.table(full_table_name(schema, table))
