"""Property tests: the Column builders agree with plain-Python statements of the rules."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import columns as C

TEXT = st.text(alphabet="0123456789$,.-h min abc\t", max_size=30)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def py_digits(s):
    if s is None:
        return None
    d = re.sub(r"[^0-9]", "", s)
    if not d:
        return None
    v = int(d)
    return v if v <= 2**63 - 1 else None


def py_duration(s):
    if s is None:
        return None
    h = re.search(r"(\d+)\s*h", s)
    m = re.search(r"(\d+)\s*min", s)
    if not h or not m:
        return None
    hv, mv = int(h.group(1)), int(m.group(1))
    if hv > 2**31 - 1 or mv > 2**31 - 1:
        return None
    total = hv * 60 + mv
    return total if -(2**31) <= total <= 2**31 - 1 else None


def py_normalize(s):
    return None if s is None else re.sub(r"\s*,\s*", ", ", s.strip(" "))


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_parse_digits_matches_python(spark, values):
    assert run(spark, values, C.parse_digits) == [py_digits(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789hmin ", max_size=20)), min_size=1, max_size=40))
def test_parse_duration_matches_python(spark, values):
    got = run(spark, values, C.parse_duration)
    exp = []
    for v in values:
        try:
            exp.append(py_duration(v))
        except OverflowError:
            exp.append(None)
    assert got == exp


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab ,", max_size=15)), min_size=1, max_size=40))
def test_normalize_list_matches_python(spark, values):
    assert run(spark, values, C.normalize_list) == [py_normalize(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 10**9)), st.one_of(st.none(), st.integers(-5, 10**9))),
                min_size=1, max_size=40))
def test_profit_is_revenue_minus_budget_when_known(spark, pairs):
    df = spark.createDataFrame(pairs, "b bigint, r bigint")
    out = df.select(
        C.positive_or_null("b").alias("b"), C.positive_or_null("r").alias("r")
    ).select("b", "r", (F.col("r") - F.col("b")).alias("p")).collect()
    for row in out:
        if row.b is None or row.r is None:
            assert row.p is None
        else:
            assert row.p == row.r - row.b and row.b > 0 and row.r > 0
