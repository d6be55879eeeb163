"""Every registered query against its DuckDB oracle, on the smallest tables."""

import pytest

import __spark_entry__ as E
import oracle_compare

SF = "/root/testdata/sf0.001"
#: The corpus queries have tests of their own.
RULE_KEYS = sorted(k for k in E.oracle_sql() if k not in getattr(E._corpus, "QUERIES", {}))


def test_every_query_has_an_oracle():
    rules = {k for k in E.queries() if k not in getattr(E._corpus, "QUERIES", {}) and k != "pipeline"}
    assert rules <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == len(E.ORDERS_RULES)
    assert set(df.columns) >= {"estado_calidad", "total_registros", "observacion_tecnica"}


@pytest.fixture(scope="module")
def outcomes(spark):
    return oracle_compare.run(spark, SF, RULE_KEYS)


@pytest.mark.parametrize("key", RULE_KEYS)
def test_query_matches_oracle(outcomes, key):
    assert outcomes[key] is None, outcomes[key]


def test_entry_file_loads_by_path_without_registration():
    # a driver may execute the file without adding it to sys.modules
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_by_path", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.queries()) == set(E.queries())
