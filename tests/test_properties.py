"""Properties of the metrics: bounds, conservation, order, fused = alone."""

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import run
from sample import rule

VALUES = st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "", " ", "ab", "abc"])),
                  min_size=0, max_size=25)

RULES = [("COM_NULOS", ""), ("VAL_PERMITIDOS", "a,b"), ("CONF_REGEX", "^a"),
         ("CONF_LONG_EXACTA", "2"), ("COM_OBLIGATORIO", ""), ("COM_DUPLICADOS", "")]


def _rules():
    return [rule("v", c, p, table="t", schema=None) for c, p in RULES]


@settings(max_examples=8, deadline=None)
@given(VALUES)
def test_bounds_conservation_and_fusion(spark, catalog, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    fused = run(spark, _rules(), catalog, {"t": df})
    n = len(values)
    for r, (code, _) in zip(fused, RULES):
        assert r["total_registros"] == n
        assert 0.0 <= r["porcentaje_cumplimiento"] <= 100.0
        assert 0 <= r["registros_fallidos"] <= n
        if code != "COM_DUPLICADOS" and n:
            passing = round(r["porcentaje_cumplimiento"] * n / 100)
            assert passing + r["registros_fallidos"] == n
    alone = [run(spark, [x], catalog, {"t": df})[0] for x in _rules()]
    assert alone == fused


@settings(max_examples=5, deadline=None)
@given(VALUES, st.randoms())
def test_uniqueness_ignores_row_order(spark, catalog, values, rnd):
    shuffled = list(values)
    rnd.shuffle(shuffled)
    a = run(spark, [rule("v", "COM_DUPLICADOS", table="t", schema=None)], catalog,
            {"t": spark.createDataFrame([(v,) for v in values], "v string")})
    b = run(spark, [rule("v", "COM_DUPLICADOS", table="t", schema=None)], catalog,
            {"t": spark.createDataFrame([(v,) for v in shuffled], "v string")})
    assert a == b
