"""Where results go: a managed table, or CSV files, plus the export text format."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.functions.text import quote_ident


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder only when its master is local;
    elsewhere that is an error, as executors would write to disks of their own.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + tempfile.mkdtemp(prefix="qualia-")


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/qualia-{stem}-{uuid.uuid4().hex}"


def save_table(df: DataFrame, schema: str | None, table: str, *, location: str | None = None) -> str:
    """Overwrite a managed table ``schema.table`` (the database is created if missing).

    The rows are written to a table of another name first; only when all are there does it take the
    place of the old one, which stays as it was if anything fails before. ``df`` may read the old table.
    ``location`` places a new database in a given folder (e.g. the shared folder).
    Returns the qualified name.
    """
    spark = df.sparkSession
    before = ""
    if schema:
        text = (location or "").replace("\\", "\\\\").replace("'", "\\'")
        loc = f" LOCATION '{text}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(schema)}{loc}")
        before = f"{quote_ident(schema)}."
    tag = uuid.uuid4().hex
    name, new, old = (before + quote_ident(t) for t in (table, f"{table}__new_{tag}", f"{table}__old_{tag}"))
    try:
        df.write.saveAsTable(new)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    there = spark.catalog.tableExists(name)
    if there:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except BaseException:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")
    return name


def export_format(result: DataFrame) -> DataFrame:
    """Run stamps as text, the way the result is exported."""
    return result.withColumns({
        "periodo": F.date_format("periodo", "yyyy-MM-dd"),
        "fecha_proceso": F.date_format("fecha_proceso", "yyyy-MM-dd HH:mm:ss.SSS"),
    })


def write_result_csv(result: DataFrame, path: str, *, single_file: bool = True) -> None:
    """Write a result as CSV with a header, from the executors (no driver collect).

    A result holds one row per rule, so ``single_file`` (one part, one header) is
    the default; turn it off to keep the result's own partitioning. The files are written
    beside ``path`` and take its place when all are there, so a run that fails leaves the last result.
    """
    out = export_format(result)
    if single_file:
        out = out.coalesce(1)
    tag = uuid.uuid4().hex
    new, old = (f"{path.rstrip('/')}__{kind}_{tag}" for kind in ("new", "old"))
    jvm = result.sparkSession._jvm
    at = {p: jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old)}
    fs = at[path].getFileSystem(result.sparkSession._jsparkSession.sessionState().newHadoopConf())
    try:
        out.write.option("header", True).csv(new)
    except BaseException:
        fs.delete(at[new], True)
        raise
    there = fs.exists(at[path])
    if there and not fs.rename(at[path], at[old]):
        fs.delete(at[new], True)
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at[new], at[path]):
        if there:
            fs.rename(at[old], at[path])
        raise OSError(f"cannot move the new result to {path}")
    if there:
        fs.delete(at[old], True)


def read_result_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read back a result CSV written by :func:`write_result_csv` (stamps stay text)."""
    ddl = ("periodo string, fecha_proceso string, id_calidad_tabla string, columna string, "
           "parametros string, umbral double, estado_calidad string, total_registros long, "
           "registros_fallidos long, porcentaje_cumplimiento double, observacion_tecnica string")
    # CSV cannot tell an empty text from NULL; a result's parameters are never NULL.
    return (spark.read.schema(ddl).option("header", True).csv(path)
            .withColumn("parametros", F.coalesce(F.col("parametros"), F.lit(""))))
