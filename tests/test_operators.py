"""Relational operators, quality gates and their edge semantics."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lamina.operators import quality as Q
from lamina.operators.ranking import asc, desc, global_rank
from lamina.operators.relational import (
    broadcast_if_small, dedupe_first, enrich_left, estimated_bytes, explode_list, kpi, top_k,
)


def test_dedupe_null_keys_compare_equal(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None), (3, "x", None)], "id int, t string, d string")
    got = sorted(r.id for r in dedupe_first(df, ["t", "d"], ["id"]).collect())
    assert got == [1, 3]


def test_dedupe_idempotent(spark):
    rows = [(i, i % 7, i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    once = dedupe_first(df, ["a", "b"], ["id"])
    twice = dedupe_first(once, ["a", "b"], ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.count() == 21


def test_explode_list_rules(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a, b,"), (4, "a,a")], "id int, l string")
    got = sorted((r.id, r.item) for r in explode_list(df, "l", "item").collect())
    assert got == [(3, "a"), (3, "b"), (4, "a"), (4, "a")]


def test_explode_count_property(spark):
    random.seed(3)
    lists = [",".join(random.choice(["x", " y ", "", "z"]) for _ in range(random.randint(0, 5))) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(lists)), "id int, l string")
    expected = sum(1 for s in lists for p in s.split(",") if p.strip()) if lists else 0
    assert explode_list(df, "l", "item").count() == expected


def test_enrich_left_fanout_and_null_key(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, v string")
    got = sorted(enrich_left(left, dim, on="id", dim_key="k").collect(), key=lambda r: (r.id is None, r.id or 0, r.v or ""))
    assert [(r.id, r.v) for r in got] == [(1, "a"), (1, "b"), (2, None), (None, None)]


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert estimated_bytes(small) is not None

    def logical(df):
        return df._jdf.queryExecution().logical().toString().lower()

    assert "broadcast" in logical(broadcast_if_small(small, 10**9))
    assert "broadcast" not in logical(broadcast_if_small(small, limit=1))


def test_negated_flag_drops_null(spark):
    df = spark.createDataFrame([(True,), (None,), (False,)], "f boolean")
    assert df.filter(~F.col("f")).count() == 1
    m = Q.metrics(df, conditions={"false": ~F.col("f"), "unknown": F.col("f").isNull()}).first()
    assert (m["rows"], m["false"], m["unknown"]) == (3, 1, 1)


def test_kpi_min_rows_needs_count(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "k int, v double")
    out = kpi(df, ["k"], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")], min_rows=2, count_col="n")
    assert [tuple(r) for r in out.collect()] == [(1, 2, 3.0)]
    with pytest.raises(ValueError):
        kpi(df, ["k"], [F.count(F.lit(1)).alias("n")], min_rows=2)


def test_top_k_subset_and_bound(spark):
    random.seed(5)
    rows = [(i, random.choice("abcd"), random.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    out = top_k(df, ["g"], [F.col("v").desc(), F.col("id").asc()], 3, "r").collect()
    per = {}
    for r in out:
        per.setdefault(r.g, []).append(r)
    assert all(len(v) == 3 for v in per.values())
    for g, rs in per.items():
        best = sorted([x for x in rows if x[1] == g], key=lambda x: (-x[2], x[0]))[:3]
        assert sorted((r.id for r in rs)) == sorted(b[0] for b in best)


def test_quality_gates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    m = Q.metrics(df, key="id").first()
    assert (m["rows"], m["null_keys"], m["distinct_keys"], m["duplicate_keys"]) == (3, 1, 1, 1)
    with pytest.raises(Q.DataQualityError, match="no_null_keys"):
        Q.check(m, {"no_null_keys": Q.no_null_keys, "unique": Q.unique_keys})
    with pytest.raises(Q.DataQualityError, match="no rows"):
        Q.check(Q.metrics(df.filter("false")), {"not_empty": Q.not_empty})
    assert Q.check({"rows": 2}, {"not_empty": Q.not_empty})["rows"] == 2


def _single_partition(df, order_cols, fn):
    return df.withColumn("expected", fn().over(Window.orderBy(*order_cols)))


@pytest.mark.parametrize("method,fn", [("row_number", F.row_number), ("dense_rank", F.dense_rank), ("rank", F.rank)])
@pytest.mark.parametrize("null_every", [0, 7])
def test_global_rank_equals_single_partition(spark, method, fn, null_every):
    random.seed(11 + null_every)
    rows = [
        (i, None if null_every and i % null_every == 0 else random.randint(0, 40), random.randint(0, 3))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    order = [desc("a"), asc("b"), asc("id")] if method == "row_number" else [desc("a"), asc("b")]
    got = global_rank(df, order, method, "r", ranges=6)
    exp = _single_partition(df, [k.column() for k in order], fn)
    joined = got.join(exp.select("id", "expected"), ["id"])
    assert joined.count() == 1500
    assert joined.filter(F.col("r") != F.col("expected")).count() == 0


def test_global_rank_string_key_and_nulls_first(spark):
    random.seed(2)
    rows = [(i, None if i % 9 == 0 else random.choice(["ab", "b", "c", "dd", "e"])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, s string")
    order = [asc("s"), asc("id")]
    got = global_rank(df, order, "row_number", "r", ranges=4)
    exp = _single_partition(df, [k.column() for k in order], F.row_number)
    assert got.join(exp, ["id"]).filter(F.col("r") != F.col("expected")).count() == 0


def test_global_rank_empty_input(spark):
    df = spark.createDataFrame([], "id int, a double")
    assert global_rank(df, [desc("a")], "dense_rank", "r").count() == 0


def test_key_report_one_row_per_table(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    b = spark.createDataFrame([(1,), (2,)], "id int")
    rows = {r["source"]: r for r in Q.key_report({"a": a, "b": b}).collect()}
    assert (rows["a"]["rows"], rows["a"]["null_keys"], rows["a"]["duplicate_keys"]) == (3, 1, 1)
    assert rows["b"]["duplicate_keys"] == 0
    with pytest.raises(Q.DataQualityError, match="a: 1 repeated keys"):
        Q.check_unique_keys(rows)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("nulls_last", [True, False])
def test_global_rank_null_orders_many_buckets(spark, descending, nulls_last):
    from lamina.operators.ranking import SortKey

    random.seed(23)
    rows = [(i, None if i % 5 == 0 else random.random() * 100) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double")
    order = [SortKey("x", descending, nulls_last), asc("id")]
    got = global_rank(df, order, "row_number", "r", ranges=37)
    exp = _single_partition(df, [k.column() for k in order], F.row_number)
    assert got.join(exp.select("id", "expected"), ["id"]).filter(F.col("r") != F.col("expected")).count() == 0


def test_global_rank_splits_hot_leading_value(spark):
    from lamina.operators.ranking import ranged

    random.seed(31)
    rows = [(i, 50 if i % 5 else random.randint(0, 100), random.randint(0, 9)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    placed, n = ranged(df, [desc("a")], 16)
    sizes = [r["count"] for r in placed.groupBy("__lamina_range").count().collect()]
    assert n == 16 and len(sizes) == 16 and max(sizes) < 1200  # 4800 rows tie on a = 50
    for method, fn in [("row_number", F.row_number), ("rank", F.rank), ("dense_rank", F.dense_rank)]:
        order = [desc("a"), desc("b")] + ([asc("id")] if method == "row_number" else [])
        got = global_rank(df, order, method, "r", ranges=16)
        exp = _single_partition(df, [k.column() for k in order], fn)
        assert got.join(exp.select("id", "expected"), ["id"]).filter(F.col("r") != F.col("expected")).count() == 0
    one_value = global_rank(df, [desc("a")], "rank", "r", ranges=16)
    exp = _single_partition(df, [desc("a").column()], F.rank)
    assert one_value.join(exp.select("id", "expected"), ["id"]).filter(F.col("r") != F.col("expected")).count() == 0


def test_global_rank_is_bigint_and_keeps_columns(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id int, s string")
    for method in ("row_number", "rank", "dense_rank"):
        got = global_rank(df, [asc("s")], method, "r")
        assert got.columns == ["id", "s", "r"] and got.schema["r"].dataType.simpleString() == "bigint"


def test_quantiles_are_those_of_all_values(spark):
    from lamina.operators import ranking

    rng = random.Random(3)
    for values in ([rng.gauss(0, 1) for _ in range(9000)], [7.0] * 5000 + [float(i) for i in range(500)], [1.0], []):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(5)
        ordered = sorted(values)
        want = list(dict.fromkeys(ordered[len(ordered) * k // 8] for k in range(1, 8))) if ordered else []
        assert ranking.quantiles(df, F.col("v"), 8) == want


def test_quantiles_over_many_ranges(spark, monkeypatch):
    from lamina.operators import ranking

    monkeypatch.setattr(ranking, "QUANTILE_VALUES", 50)
    texts = ["%05d" % (i * 7919 % 1000) for i in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert ranking.quantiles(df, F.col("t"), 16) == [sorted(texts)[4000 * k // 16] for k in range(1, 16)]
