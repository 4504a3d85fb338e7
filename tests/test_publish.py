"""Publishing: concurrent writers, leases, ordered files, contracts that change, repeated steps."""

import datetime as dt
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from lamina.plans import catalogue as cat
from lamina.session import NoSharedFolder, warehouse_root
from lamina.sources.tables import (
    ContractDrift, drift, drop_layers, drop_table, ensure_tables, held_layer, holds_all, read_layer, read_ordered,
    table_log, table_version, write_layer,
)
from lamina.sources.versions import Manifest, PublishConflict, VersionLog
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.fixture()
def name():
    return f"default.p_{uuid.uuid4().hex[:10]}"


def folders(spark, name):
    return sorted(n for n in table_log(spark, name)._names("") if n.startswith("v_"))


def tagged(spark, tag, n=9):
    return spark.range(n).withColumn("tag", F.lit(tag))


def test_writers_at_once_lose_nothing(spark, name):
    write_layer(tagged(spark, -1), name)

    def work(writer):
        for turn in range(3):
            write_layer(tagged(spark, 10 * writer + turn, 20 + writer), name, keep_seconds=0.0)

    with ThreadPoolExecutor(4) as pool:
        for f in [pool.submit(work, w) for w in range(4)]:
            f.result()
    rows = read_layer(spark, name).collect()
    tags = {r["tag"] for r in rows}
    assert len(tags) == 1 and len(rows) == 20 + tags.pop() // 10
    assert table_version(spark, name) == 13
    assert sorted(spark.table(name).collect()) == sorted(rows)  # the catalog shows the newest too


def test_publishes_during_a_gate(spark, name):
    write_layer(tagged(spark, 0), name, keep_seconds=0.0)

    def gate(_):
        for tag in (1, 2):
            write_layer(tagged(spark, tag, 3), name, keep_seconds=0.0)

    write_layer(tagged(spark, 3), name, gate=gate, keep_seconds=0.0)
    assert [r["tag"] for r in read_layer(spark, name).collect()] == [3] * 9
    assert spark.table(name).count() == 9


def test_stale_base_is_refused_and_changes_nothing(spark, name):
    write_layer(tagged(spark, 0), name, base=0)
    seen = table_version(spark, name)
    write_layer(tagged(spark, 1), name, base=seen)
    with pytest.raises(PublishConflict):
        write_layer(tagged(spark, 2), name, base=seen)
    assert {r["tag"] for r in read_layer(spark, name).collect()} == {1}


def test_failed_gate_publishes_nothing(spark, name):
    write_layer(tagged(spark, 0), name)

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        write_layer(tagged(spark, 1), name, gate=refuse)
    assert table_version(spark, name) == 1 and {r["tag"] for r in read_layer(spark, name).collect()} == {0}


def test_held_versions_stay(spark, name):
    write_layer(tagged(spark, 0), name)
    with held_layer(spark, name) as rows:
        for tag in (1, 2, 3):
            write_layer(tagged(spark, tag), name, keep_seconds=0.0)
        assert {r["tag"] for r in rows.collect()} == {0}
        assert len(folders(spark, name)) == 2  # the newest and the held one
    write_layer(tagged(spark, 4), name, keep_seconds=0.0)
    assert len(folders(spark, name)) == 1


def test_unpublished_folders_of_others_stay(spark, name):
    write_layer(tagged(spark, 0), name)
    log = table_log(spark, name)
    theirs = log.new_folder()
    tagged(spark, 9).write.parquet(f"{log.root}/{theirs}")
    for tag in (1, 2):
        write_layer(tagged(spark, tag), name, keep_seconds=0.0)
    assert theirs in folders(spark, name)
    assert log.clean(abandon_seconds=0.0) == [theirs]
    assert {r["tag"] for r in read_layer(spark, name).collect()} == {2}


def test_replaced_versions_stay_for_a_while(spark, name):
    for tag in range(3):
        write_layer(tagged(spark, tag), name)
    assert len(folders(spark, name)) == 3


@pytest.mark.parametrize("scheme", ["file", "viewfs"])
def test_a_number_is_given_once(spark, tmp_path, scheme):
    root = f"file:{tmp_path}/t"
    if scheme == "viewfs":  # a store that is renamed within, not linked
        (tmp_path / "t").mkdir()
        spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.lamina.link./t", f"file://{tmp_path}/t")
        root = "viewfs://lamina/t"
    log = VersionLog(spark, root)
    draft = Manifest(0, "v_1_ab", "parquet", json.dumps(T.StructType([]).jsonValue()), 0.0)
    with ThreadPoolExecutor(4) as pool:
        done = [f.result().number for f in [pool.submit(log.commit, draft) for _ in range(8)]]
    assert sorted(done) == list(range(1, 9)) == log.numbers()
    assert log._create("_log/00000000000000000003.json", "{}") is False
    assert log.read(3).folder == "v_1_ab" and not [n for n in log._names("_log") if n.startswith("draft")]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_ordered_table_reads_back_in_order(spark, name, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(5000).select((F.hash("id") % 300).alias("k"), "id")
        write_layer(df, name, order=["k", "id"])
        rows = [tuple(r) for r in read_ordered(spark, name).collect()]
        assert rows == sorted(map(tuple, df.collect())) and "Sort" not in read_ordered(spark, name)._jdf.queryExecution().executedPlan().toString()
        with pytest.raises(ValueError):
            write_layer(df, name)
            read_ordered(spark, name)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def schema(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def test_drift_rules():
    i, b, s, d = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType()
    assert drift(schema(("a", i)), schema(("a", i))) == ([], [])
    assert drift(schema(("a", i)), schema(("a", b), ("c", s))) == (["a: int to bigint", "new column c string"], [])
    assert drift(schema(("a", b)), schema(("a", i)))[1] == ["a: bigint to int"]
    assert drift(schema(("a", i), ("z", s)), schema(("a", i)))[1] == ["column z is not in the contract"]
    assert drift(schema(("a", i), ("z", s)), schema(("z", s), ("a", i))) == (["order of columns"], [])
    assert drift(schema(("a", i)), T.StructType([*schema(("a", i)).fields, T.StructField("n", i, False)]))[1]
    assert holds_all(T.DecimalType(12, 3), T.DecimalType(10, 2)) and not holds_all(T.DecimalType(10, 3), T.DecimalType(10, 2))
    assert holds_all(d, i) and not holds_all(d, b) and not holds_all(T.FloatType(), i)


def test_migration_keeps_rows_and_refusal_writes_nothing(spark, name):
    other = f"{name}_b"
    old, new = schema(("a", T.IntegerType()), ("b", T.StringType())), schema(("b", T.StringType()), ("a", T.LongType()), ("c", T.DateType()))
    assert ensure_tables(spark, {name: old, other: old}) == {}
    write_layer(spark.createDataFrame([(1, "x"), (None, None)], old), name)
    with pytest.raises(ContractDrift, match="b: string to int"):
        ensure_tables(spark, {name: new, other: schema(("a", T.IntegerType()), ("b", T.IntegerType()))})
    assert table_version(spark, name) == 1  # nothing was written, not even the change that would have done
    assert len(ensure_tables(spark, {name: new, other: new})[name]) == 2
    assert read_layer(spark, name).schema == new and spark.table(other).schema.simpleString() == new.simpleString()
    assert sorted(map(str, read_layer(spark, name).collect())) == sorted(["Row(b='x', a=1, c=None)", "Row(b=None, a=None, c=None)"])
    assert ensure_tables(spark, {name: new}) == {name: []} and table_version(spark, name) == 2


def test_a_step_recorded_twice_leaves_one_row_per_table(spark):
    prefix = f"m{uuid.uuid4().hex[:8]}"
    first, second = dt.datetime(2024, 1, 1, 1, 2, 3, 456), dt.datetime(2024, 1, 2)
    for n, run in ((1, first), (2, first), (3, second)):
        cat.record_run_metrics(spark, prefix, "golden", {"a": {"row_count": n}, "b": {"row_count": n, "undated": 1}}, run)
    cat.record_run_metrics(spark, prefix, "silver", {"a": {"row_count": 7}}, first)
    rows = [(r["run_ts"], r["step"], r["table_name"], r["row_count"], r["undated"]) for r in spark.table(f"{prefix}_ops.run_metrics").collect()]
    assert sorted(rows, key=str) == sorted([
        (first, "golden", "a", 2, None), (first, "golden", "b", 2, 1), (first, "silver", "a", 7, None),
        (second, "golden", "a", 3, None), (second, "golden", "b", 3, 1)], key=str)
    drop_layers(spark, prefix, "ops")
    assert not spark.catalog.databaseExists(f"{prefix}_ops")


def test_dropped_tables_leave_nothing(spark, name):
    write_layer(tagged(spark, 0), name)
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name) and table_version(spark, name) == 0 and folders(spark, name) == []


def test_a_cluster_needs_a_shared_warehouse(spark, monkeypatch):
    import lamina.session as S

    monkeypatch.setattr(S, "_one_machine", lambda _: False)
    assert warehouse_root(spark)  # set by the tests' session

    class Conf:
        def get(self, *_):
            return f"file:{spark._jvm.java.lang.System.getProperty('user.dir')}/spark-warehouse"

    class Session:
        conf, _jvm, sparkContext = Conf(), spark._jvm, spark.sparkContext

    with pytest.raises(NoSharedFolder):
        warehouse_root(Session())


def test_a_cluster_without_a_warehouse_publishes_in_its_shared_folder(spark, name, monkeypatch, tmp_path):
    import lamina.session as S

    monkeypatch.setattr(S, "_one_machine", lambda _: False)
    settings = {"spark.sql.warehouse.dir": f"file:{spark._jvm.java.lang.System.getProperty('user.dir')}/spark-warehouse",
                "spark.checkpoint.dir": f"file://{tmp_path}/shared"}
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *a: settings.get(key) or get(self, key, *a))
    write_layer(tagged(spark, 0), name)
    write_layer(read_layer(spark, name), name)
    assert read_layer(spark, name).count() == spark.table(name).count() == tagged(spark, 0).count()
    assert table_log(spark, name).root.startswith(f"file://{tmp_path}/shared/")
    drop_table(spark, name)
    prefix = f"nowhere_{uuid.uuid4().hex[:8]}"
    cat.record_run_metrics(spark, prefix, "golden", {"t": {"row_count": 1}}, dt.datetime(2024, 1, 1))
    assert spark.table(f"{prefix}_ops.run_metrics").count() == 1
    assert list((tmp_path / "shared").rglob("*.parquet"))  # what the executors wrote
    drop_layers(spark, prefix, "ops")
