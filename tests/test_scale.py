"""Hot keys are dealt out, lookups skip row groups, distinct counts are bitmaps, ranges are even."""

import random
from collections import Counter

import pytest
from lamina.functions import columns as C
from lamina.operators import quality as Q
from lamina.operators.ranking import asc, desc, ranged
from lamina.operators.relational import enrich_left, hot_keys, late_lookup, wanted_ranges
from lamina.sources.tables import stage
from pyspark.sql import functions as F


@pytest.fixture()
def no_aqe(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_hot_key_is_spread_over_tasks(spark, no_aqe):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 7 != 3, F.col("id") % 900).cast("int").alias("k"))
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 1000, 3)] + [(5, "a"), (5, "b"), (None, "none")], "k int, name string")
    assert 5 in hot_keys(df, "k")
    got = enrich_left(df, dim, on="k", spread_hot_keys=True)
    plain = enrich_left(df, dim, on="k")
    assert got.columns == plain.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    most = lambda x: max(r["count"] for r in x.filter("k = 5").groupBy(F.spark_partition_id()).count().collect())
    assert most(plain) >= 20_000 and most(got) < 9_000  # 8 partitions, 8 salts dealt by hash
    nulls = got.filter("k is null").groupBy(F.spark_partition_id()).count().count()
    assert nulls >= 4  # of 8, by hash


def test_no_hot_key_and_no_rows(spark):
    dim = spark.createDataFrame([(1, "x")], "k int, name string")
    empty = spark.createDataFrame([], "id int, k int")
    assert enrich_left(empty, dim, on="k", spread_hot_keys=True).collect() == []
    only_null = spark.createDataFrame([(1, None)], "id int, k int")
    assert [tuple(r) for r in enrich_left(only_null, dim, on="k", spread_hot_keys=True).collect()] == [(None, 1, None)]


def test_wanted_ranges_hold_all_keys_and_leave_gaps_out(spark):
    rng = random.Random(2)
    ids = [rng.randrange(-50, 50) for _ in range(30)] + [10**6 + i for i in range(40)] + [2**62, -(2**62), None]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    ranges = wanted_ranges(rows, "id", 5)
    assert 1 < len(ranges) <= 5 and all(any(a <= i <= b for a, b in ranges) for i in ids if i is not None)
    assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    near = wanted_ranges(rows.filter("abs(id) < 2000000"), "id", 2)
    assert len(near) == 2 and near[0][1] < 50 and near[1][0] == 10**6
    assert wanted_ranges(rows.filter("false"), "id") == [] and wanted_ranges(spark.createDataFrame([("a",), ("b",)], "id string"), "id") == [("a", "b")]


def scanned_rows(df):
    """Rows that the scans of a query read, by scan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            out.append(node.metrics().get("numOutputRows").get().value())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return out


def test_a_late_lookup_does_not_read_what_it_cannot_want(spark, tmp_path):
    path = f"file:{tmp_path}/big"
    spark.range(100_000).withColumn("v", F.col("id") * 2).repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(path)
    big = spark.read.parquet(path)
    top = stage(spark.createDataFrame([(7, "a"), (60_001, "b"), (60_003, "c"), (999_999, "d"), (None, "e")], "id bigint, t string"))
    out = late_lookup(top, big, "id", ["v"])
    assert {(r["id"], r["t"], r["v"]) for r in out.collect()} == {(7, "a", 14), (60_001, "b", 120_002), (60_003, "c", 120_006), (999_999, "d", None), (None, "e", None)}
    assert max(scanned_rows(out)) <= 15_000  # two of twenty files; the third wanted range holds none
    nothing = late_lookup(top.filter("false"), big, "id", ["v"])
    assert nothing.collect() == [] and nothing.columns == ["id", "t", "v"]


def test_distinct_counts_by_bitmaps(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(-40_000, 40_000) if rng.random() > 0.1 else None, rng.randrange(3), rng.randrange(2**62),
             rng.choice("abc"), None) for _ in range(5_000)]
    df = spark.createDataFrame(rows, "a int, b smallint, wide bigint, s string, n int")
    distinct = {"da": "a", "db": "b", "dw": "wide", "ds": "s", "dn": "n", "again": "a"}
    got = Q.metrics(df, key="a", conditions={"big": F.col("a") > 0, "unknown": F.col("n") > 0}, distinct=distinct).first().asDict()
    want = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a").isNull()).alias("null_keys"), F.count_distinct("a").alias("distinct_keys"),
                  (F.count("a") - F.count_distinct("a")).alias("duplicate_keys"), F.count_if(F.col("a") > 0).alias("big"), F.lit(0).alias("unknown"),
                  *[F.count_distinct(c).alias(n) for n, c in distinct.items()]).first().asDict()
    assert got == want
    empty = Q.metrics(df.filter("false"), key="a", distinct={"db": "b"}).first().asDict()
    assert empty == {"rows": 0, "null_keys": 0, "distinct_keys": 0, "duplicate_keys": 0, "db": 0}


def test_dense_distinct_counts_share_one_scan(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    plan = Q.metrics(li, key="l_orderkey", distinct={"p": "l_partkey", "s": "l_suppkey"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Expand" not in plan
    ends = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "k bigint")  # far apart: no bitmap
    assert Q.metrics(ends, key="k").first()["distinct_keys"] == 3


def test_ranges_are_even_on_a_skewed_key(spark):
    df = spark.range(60_000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.exp(F.rand(3) * 20))).alias("k"), "id")
    for order in ([desc("k")], [asc("k", nulls_last=True)]):
        placed, n = ranged(stage(df), order, 12)
        sizes = [r["count"] for r in placed.groupBy("__lamina_range").count().collect()]
        assert n == 12 and len(sizes) == 12 and max(sizes) <= 2 * 60_000 / 12 and sum(sizes) == 60_000


def test_parse_money(spark):
    cases = {"$1.50": 1.5, "-$5": -5.0, "$25,000,000": 25_000_000.0, "": None, "abc": None, None: None, "1.2.3": None, "5-3": None,
             ".5": 0.5, "7.": 7.0, "9" * 40: None, "-": None, "1.23456789": 1.234568}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    got = {r["t"]: None if r["m"] is None else float(r["m"]) for r in df.select("t", C.parse_money("t").alias("m")).collect()}
    assert got == cases


def test_null_labels_and_positive_preference(spark):
    df = spark.createDataFrame([(None, None, 3), (100, 0, 4), (10, 5, 6)], "m int, a int, b int")
    got = df.select(C.duration_bucket("m"), C.duration_bucket("m", "?"), C.score_bucket("a", "?"), C.prefer("a", "b"),
                    C.prefer("a", "b", null_if_nonpositive=True)).collect()
    assert [tuple(r) for r in got] == [("Larga", "?", "?", 3, 3), ("Media", "Media", "Baja", 0, 4), ("Corta", "Corta", "Regular", 5, 5)]
    with pytest.raises(ValueError):
        C.bucket([(F.col("m") > 1, "x")], "y", null_label="?")


