"""Exact sums against rational arithmetic."""

import math
import random
from fractions import Fraction

import pytest
from lamina.functions import columns as C
from lamina.operators.relational import kpi
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rational(values, kind):
    known = [v for v in values if v is not None]
    if not known:
        return None
    odd = [v for v in known if isinstance(v, float) and not math.isfinite(v)]
    if odd:
        return sum(odd)
    total = sum(map(Fraction, known))
    return float(total / len(known)) if kind == "avg" else float(total)


def same(a, b):
    if a is None or b is None:
        return a is b
    return (math.isnan(a) and math.isnan(b)) or a == b


def groups():
    rng = random.Random(11)
    out = {
        "empty": [None, None], "tie": [7.4949998], "tie2": [2.4949996], "tiny": [4.9e-7] * 10 + [1e23],
        "zeros": [-0.0, 0.0, -0.0], "nan": [1.0, float("nan"), 2.0], "inf": [float("inf"), 3.0, None],
        "both": [float("inf"), float("-inf")], "ends": [5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.0],
        "cancel": [1e16, 1.0, -1e16, 1e-30], "half": [2.0 ** 53, 1.0, 2.0 ** -60], "even": [2.0 ** 53, 1.0],
        "negative": [-0.1] * 7 + [0.3], "edge": [2.0 ** -31, -(2.0 ** 32), math.nextafter(2.0 ** 32, 0), math.nextafter(2.0 ** -31, 0)],
        "subnormal": [5e-324] * 3,
    }
    for i in range(40):
        span = rng.choice([3, 20, 100, 600])
        out[f"r{i}"] = [None if rng.random() < 0.05 else rng.uniform(-1, 1) * 2.0 ** rng.uniform(-span, span)
                        for _ in range(rng.randint(1, 300))]
    for i in range(20):
        out[f"m{i}"] = [round(rng.uniform(-1e5, 1e5), 2) for _ in range(rng.randint(1, 500))]
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_sums_and_averages_equal_rationals(spark, parts):
    data = groups()
    rows = [(g, v) for g, values in data.items() for v in values]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    got = {r["g"]: r for r in kpi(df, ["g"], [C.exact_sum("v").alias("s"), C.exact_avg("v").alias("a"),
                                              C.row_count().alias("n")]).collect()}
    assert set(got) == set(data)
    for g, values in data.items():
        assert same(got[g]["s"], rational(values, "sum")), (g, got[g]["s"], rational(values, "sum"))
        assert same(got[g]["a"], rational(values, "avg")), (g, got[g]["a"], rational(values, "avg"))
        assert got[g]["n"] == len(values)


def test_whole_numbers_beyond_doubles(spark):
    rng = random.Random(3)
    data = {"big": [2 ** 63 - 1, 2 ** 63 - 3, -5], "low": [-(2 ** 63), -1, None], "r": [rng.randint(-2 ** 62, 2 ** 62) for _ in range(99)]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v bigint")
    got = {r["g"]: r for r in kpi(df, ["g"], [C.exact_sum("v").alias("s"), C.exact_avg("v").alias("a")]).collect()}
    for g, vs in data.items():
        assert got[g]["s"] == rational(vs, "sum") and got[g]["a"] == rational(vs, "avg"), g


def test_rounding_happens_once(spark):
    df = spark.createDataFrame([(1, 7.4949998), (2, 2.4949996), (3, 2.675), (4, 0.0049996)], "g int, v double")
    ours = kpi(df, ["g"], [C.exact_avg("v").rounded(2).alias("a"), C.exact_sum("v").rounded(2).alias("s")])
    plain = df.groupBy("g").agg(F.round(F.avg("v"), 2).alias("a"), F.round(F.sum("v"), 2).alias("s"))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


def test_mixed_with_plain_aggregates_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1.5, "a"), (None, 2.0, "b"), (1, 0.1, "a"), (1, None, "a")], "k int, v float, c string")
    out = kpi(df, ["k"], [C.row_count().alias("n"), C.exact_sum("v").alias("s"), F.count_distinct("c").alias("d")],
              min_rows=2, count_col="n").collect()
    f32 = 0.10000000149011612
    assert sorted((r["k"] or 0, r["n"], r["s"], r["d"]) for r in out) == [(0, 2, 3.5, 2), (1, 2, f32, 1)]


def test_no_rows_and_wrong_types(spark):
    empty = spark.createDataFrame([], T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType())]))
    assert kpi(empty, ["k"], [C.exact_sum("v").alias("s")]).collect() == []
    with pytest.raises(TypeError):
        kpi(spark.createDataFrame([(1, "x")], "k int, v string"), ["k"], [C.exact_sum("v").alias("s")])


def test_one_aggregation_pass_and_no_python(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id * 0.1D as v")
    plan = kpi(df, ["k"], [C.exact_sum("v").alias("s"), C.exact_avg("v").alias("a")])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Join" not in plan
