"""Plan shape: scale properties the operators promise."""

import re

import pytest

import __spark_entry__ as E
from lamina.operators.ranking import asc, desc, global_rank
from lamina.operators.relational import dedupe_first, top_k
from lamina.plans.queries import QUERIES
from pyspark.sql import functions as F


def physical(df):
    df.write.format("noop").mode("overwrite").save()  # finalise adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_query(spark, sf_small):
    for name, q in QUERIES.items():
        plan = q(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)


def test_window_group_limit_before_shuffle(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    d = dedupe_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey"])
    t = top_k(li, ["l_returnflag"], [F.col("l_quantity").desc()], 10)
    for df in (d, t):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_global_rank_has_no_single_partition_window_over_data(spark, sf_small):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    order = [desc("l_extendedprice"), asc("l_orderkey"), asc("l_linenumber")]
    for method in ("row_number", "rank", "dense_rank"):
        final = physical(global_rank(li, order, method, "r")).split("== Initial Plan ==")[0]
        # what follows the one write: the summary of the ranges, broadcast; rows are not moved again
        assert "SortMergeJoin" not in final and "rangepartitioning" not in final and "passthrough" not in final
        keys = re.findall(r"Join \[([^\]]*)\]", final)
        assert keys and all(k.startswith("__lamina_range") for k in keys)


def test_ranges_are_written_once_and_bounds_read_keys_only(spark, sf_small, monkeypatch):
    from lamina.operators import ranking

    written = []
    monkeypatch.setattr(ranking, "stage", lambda df, name: written.append(df) or df)
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    ranking.ranged(li, [desc("l_quantity")], ties=True)
    (df,) = written  # a scan is not staged first
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("passthrough") == 1 and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "ReadSchema: struct<l_quantity:double>" in plan  # the sample


def test_parquet_scans_are_pruned(spark, sf_small):
    q = E.queries()["kpi_one_key"](spark, sf_small)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_returnflag:string>" in plan
    events = spark.read.parquet(f"{sf_small}/events.parquet")
    f = top_k(events.filter(F.col("value") >= 100), ["event_type"], [F.col("value").desc()], 10)
    assert "GreaterThanOrEqual(value,100.0)" in f._jdf.queryExecution().executedPlan().toString()


def test_distinct_counts_do_not_expand_rows(spark, sf_small):
    assert "Expand" not in physical(QUERIES["quality_metrics"](spark, sf_small))


def test_late_lookup_computes_the_top_rows_once(spark, sf_small):
    for name in ("top_k_per_group", "film_top_films"):
        plan = physical(QUERIES[name](spark, sf_small)).split("== Initial Plan ==")[0]
        assert "WindowGroupLimit" not in plan, name  # written before, once


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from lamina.session import NoSharedFolder, checkpoint_root

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None))

    for master in ("yarn", "spark://x:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(NoSharedFolder):
            checkpoint_root(session(master))
    assert checkpoint_root(session("local[4]"))
