"""Hand rows for every column builder (expected values fixed by the rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lamina.functions import columns as C
from lamina.operators.relational import kpi


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_parse_digits(spark):
    got = one_col(spark, ["$25,000,000", "", "abc", None, "-$5", "$1.50", "9" * 20], C.parse_digits)
    assert got == [25000000, None, None, None, 5, 150, None]


def test_parse_iso_date(spark):
    vals = ["2020-01-02", "2020-1-2", "", None, "2020-13-45", "2021-02-30", "2020/01/02"]
    got = one_col(spark, vals, C.parse_iso_date)
    assert got == [dt.date(2020, 1, 2), None, None, None, None, None, None]


def test_parse_duration(spark):
    vals = ["2h 22 min", "1h 5min", "45 min", "2h", "", None]
    assert one_col(spark, vals, C.parse_duration) == [142, 65, None, None, None, None]


def test_duration_bucket(spark):
    got = one_col(spark, [89, 90, 150, 151, None], C.duration_bucket, "int")
    assert got == ["Corta", "Media", "Media", "Larga", "Larga"]


def test_score_bucket(spark):
    got = one_col(spark, [8.0, 7.99, 7.0, 5.0, 4.9, None], C.score_bucket, "double")
    assert got == ["Excelente", "Buena", "Buena", "Regular", "Baja", "Baja"]


def test_trim_keeps_tabs(spark):
    assert one_col(spark, ["\ta ", "  b  "], C.clean_text) == ["\ta", "b"]


def test_clean_code_and_list(spark):
    assert one_col(spark, ["  EN "], C.clean_code) == ["en"]
    assert one_col(spark, [" a ,b  ,  c ", None], C.normalize_list) == ["a, b, c", None]


def test_first_item(spark):
    assert one_col(spark, [" x , y", "solo", None, ""], C.first_item) == ["x", "solo", None, ""]


@pytest.mark.parametrize("value,expected", [
    (2.675, 2.68), (1.005, 1.01), (0.125, 0.13), (-1.005, -1.01), (7.4949998, 7.49), (2.4949996, 2.49), (0.0049996, 0.0),
])
def test_round_half_up(spark, value, expected):
    assert one_col(spark, [value], lambda c: C.round_half_up(c, 2), "double") == [expected]


def test_overflow_gives_null(spark):
    assert one_col(spark, ["99999999h 5 min", "9" * 30 + "h 1 min", "1h 5 min"], C.parse_duration) == [None, None, 65]
    df = spark.createDataFrame([(99_999_999, 5), (2**62, 5), (2, 3)], "h bigint, m bigint")
    assert [r[0] for r in df.select(C.minutes("h", "m")).collect()] == [None, None, 123]
    big = spark.createDataFrame([(2**62,), (2**62,), (2**62,)], "v bigint")
    assert kpi(big, [], [C.whole_sum("v").alias("s")]).first()[0] is None
    assert kpi(big.limit(1), [], [C.whole_sum("v").alias("s")]).first()[0] == 2**62


def test_list_separator_may_be_special(spark):
    assert one_col(spark, [" a $ b$c "], lambda c: C.normalize_list(c, "$")) == ["a$ b$ c"]


def test_amount_rules(spark):
    df = spark.createDataFrame(
        [(0, 7), (None, 7), (5, 7), (None, None)], "a bigint, b bigint"
    )
    got = [r[0] for r in df.select(C.positive_or_null(C.prefer("a", "b"))).collect()]
    assert got == [None, 7, 5, None]


def test_ratio_guards_zero(spark):
    df = spark.createDataFrame([(10, 4), (5, 0), (None, 3), (3, None)], "n bigint, d bigint")
    assert [r[0] for r in df.select(C.ratio("n", "d", 2)).collect()] == [2.5, None, None, None]


def test_minutes_and_decade(spark):
    df = spark.createDataFrame([(2, 5, 1999), (None, 5, 2000), (1, None, None)], "h int, m int, y int")
    rows = df.select(C.minutes("h", "m"), C.decade("y")).collect()
    assert [tuple(r) for r in rows] == [(125, 1990), (None, 2000), (None, None)]


def test_agrees_is_three_valued(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(C.agrees("a", "b")).collect()] == [True, False, None]
