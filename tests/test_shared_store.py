"""Queries that publish tables, on a cluster that names a shared folder but no warehouse, and
whose store does not say its scheme."""

import os
import sys

import pytest

import __spark_entry__ as E
import lamina.session as S

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))
from oracle_check import compare  # noqa: E402


@pytest.fixture()
def data(spark, tmp_path):
    path = f"{tmp_path}/data"
    ids = spark.range(300)
    ids.selectExpr("id + 1 as c_custkey", "concat('Customer#', id) as c_name", "cast(id % 25 as int) as c_nationkey",
                   "id * 7.25D - 500 as c_acctbal", "concat('SEG', id % 5) as c_mktsegment").write.parquet(f"{path}/customer.parquet")
    ids.selectExpr("id as o_orderkey", "(id * 37) % 90 / 4 as o_totalprice", "id % 40 as o_custkey").selectExpr(
        "o_orderkey", "o_custkey", "cast(o_totalprice as double) as o_totalprice").write.parquet(f"{path}/orders.parquet")
    ids.selectExpr("id + 1 as p_partkey", "concat('hot part ', id % 90) as p_name", "concat('Brand#', id % 25) as p_brand",
                   "concat('TYPE ', id % 12) as p_type", "cast(id % 50 + 1 as int) as p_size").write.parquet(f"{path}/part.parquet")
    return path


@pytest.fixture()
def shared(spark, tmp_path, monkeypatch):
    """The shared folder of a session that passes for a cluster without a warehouse."""
    folder = tmp_path / "shared"
    settings = {"spark.sql.warehouse.dir": f"file:{spark._jvm.java.lang.System.getProperty('user.dir')}/spark-warehouse",
                "spark.checkpoint.dir": f"file://{folder}"}
    get = type(spark.conf).get
    monkeypatch.setattr(S, "_one_machine", lambda _: False)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: settings.get(key) or get(self, key, *a))
    store = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    hadoop = spark._jsc.hadoopConfiguration()
    before = {k: hadoop.get(k) for k in store}
    for k, v in store.items():
        hadoop.set(k, v)
    yield folder
    for k, v in before.items():
        hadoop.unset(k) if v is None else hadoop.set(k, v)


def equals_its_sql(spark, data, shared, name):
    query = E.queries()[name]
    r = compare(spark, duck_files(data), name, data, query, E.oracle_sql()[name])
    assert r["cols_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"] > 0, r
    left = [p for p in (shared / "lamina-warehouse").rglob("*") if p.is_file()]
    assert (shared / "lamina-warehouse").is_dir() and not left  # the tables lay there, and are dropped


def duck_files(data):
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(data):
        con.execute(f"create view {t.removesuffix('.parquet')} as select * from read_parquet('{data}/{t}/*.parquet')")
    return con


def test_csv_rejects(spark, data, shared):
    equals_its_sql(spark, data, shared, "csv_rejects")


def test_ordered_files(spark, data, shared):
    equals_its_sql(spark, data, shared, "ordered_files")


def test_publish_conflict(spark, data, shared):
    equals_its_sql(spark, data, shared, "publish_conflict")


def test_published_films(spark, data, shared):
    equals_its_sql(spark, data, shared, "published_films")


def test_published_golden(spark, data, shared):
    equals_its_sql(spark, data, shared, "published_golden")


def test_published_metrics(spark, data, shared):
    equals_its_sql(spark, data, shared, "published_metrics")


def test_sink_replace(spark, data, shared):
    equals_its_sql(spark, data, shared, "sink_replace")
