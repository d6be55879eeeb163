"""Run every registered query against its DuckDB oracle and compare the results.

Usage: ``python tests/oracle_compare.py [sf_dir] [key ...]``. Also used by the tests.
"""

from __future__ import annotations

import math
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, float(f"{v:.12g}"))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, int):
        return (1, float(v))
    return (4, str(v))


def compare(spark_rows, spark_cols, duck_rows, duck_cols) -> str | None:
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: {sorted(spark_cols)} vs {sorted(duck_cols)}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in spark_rows)
    b = sorted(tuple(_norm(r[i]) for i in di) for r in duck_rows)
    if len(a) != len(b):
        return f"row count {len(a)} vs {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diff = [(c, x[k], y[k]) for k, c in enumerate(order) if x[k] != y[k]]
            return f"value mismatch: {diff}"
    return None


def run(spark, sf_dir: str, keys: list[str] | None = None) -> dict[str, str | None]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or list(qs):
        try:
            df = qs[k](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            if k not in sqls:
                out[k] = None
                continue
            rel = con.execute(sqls[k])
            drows = rel.fetchall()
            dcols = [d[0] for d in rel.description]
            out[k] = compare(rows, cols, drows, dcols)
        except Exception as e:  # report, keep going
            out[k] = f"error: {type(e).__name__}: {' '.join(str(e).split())[:400]}"
    return out


if __name__ == "__main__":
    from qualia.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = run(spark, sf, keys)
    bad = {k: v for k, v in res.items() if v}
    for k, v in res.items():
        print(f"{'OK  ' if not v else 'FAIL'} {k}" + (f": {v}" if v else ""))
    print(f"{len(res) - len(bad)}/{len(res)} match")
