"""Scalar helpers: Python-style float text, percentage text, regex literal guard."""

import random
import re

import pytest

from pyspark.sql import functions as F

from qualia.functions.text import PY_FLOAT_HELPERS, percent_text_sql, py_float_sql
from qualia.operators.checks import required_literal

FLOATS = [0.0, 99.0, 98.5, 97.25, 100.0, 1e-05, 0.0001, 0.001, 1e7, 12345678.9, 1e16, 1.5e16,
          1e22, 2.5e-7, -3.0, -1e-05, 123456789012345.6, 0.1, 1 / 3, 1e-100, 1.7976931348623157e308]
# (Java 17 prints a few subnormals with more digits than needed, e.g. 4.9E-324; not covered)


def _float_texts(df):
    first, helpers, text = py_float_sql("x")
    df = df.withColumn(PY_FLOAT_HELPERS[0], F.expr(first)).withColumns({k: F.expr(v) for k, v in helpers.items()})
    return [r[0] for r in df.select(F.expr(text)).collect()]


def test_py_float_text_matches_python(spark):
    df = spark.createDataFrame([(x,) for x in FLOATS], "x double")
    got = _float_texts(df)
    assert got == [str(x) for x in FLOATS]


def test_py_float_text_on_threshold_like_values(spark):
    # thresholds are percentages with a few decimals; Java 17 can print 17-digit
    # doubles with one digit too many (fixed in later JDKs), so those are left out
    rnd = random.Random(5)
    xs = [round(rnd.uniform(0, 100), rnd.randint(0, 4)) for _ in range(1000)]
    xs += [float(f"{rnd.randint(1, 999999)}e{rnd.randint(-16, 6)}") for _ in range(1000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = _float_texts(df)
    assert got == [str(x) for x in xs]


def test_percent_text_rounds_the_binary_value(spark):
    xs = [3.125, 2.675, 0.295, 1.005, 83.33333333333334, 100.0, 0.0, 66.66666666666666]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(F.expr(percent_text_sql("x"))).collect()]
    assert got == [f"{x:.2f}" for x in xs]


@pytest.mark.parametrize("pattern,literal", [
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "@"), ("utm_", "utm_"), ("^x*", None),
    ("^https?://", "http"), ("a|b", None), ("(?i)abc", None), ("ab+c", "ab"), ("ab{0,2}c", "a"),
    (r"\Qa|b\E", None), ("x(abc)?y", "x"), (r"\p{L}+abc", None), ("[a-z&&[^b]]q", None),
])
def test_required_literal(pattern, literal):
    assert required_literal(pattern) == literal


def test_required_literal_is_in_every_match():
    rnd = random.Random(11)
    atoms = ["a", "b", "@", ".", r"\.", "[ab]", "[^a]", r"\d", "(ab)", "(a|b)", "x"]
    quants = ["", "", "?", "*", "+", "{0,2}", "{1,3}", "{2}", "+?", "*+"]
    for _ in range(5000):
        p = "".join(rnd.choice(atoms) + rnd.choice(quants) for _ in range(rnd.randint(1, 5)))
        lit = required_literal(p)
        if not lit:
            continue
        rx = re.compile(p)
        for _ in range(10):
            s = "".join(rnd.choice("ab@.x1 ") for _ in range(rnd.randint(0, 12)))
            m = rx.search(s)
            assert not (m and m.group(0)) or lit in s, (p, lit, s)
