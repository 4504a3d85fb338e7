"""Records with newlines inside quotes, read by many tasks, against Spark's one-task reader; the reject path."""

import hashlib
import random
import uuid

import pytest
from lamina.contracts import RAW
from lamina.plans import catalogue as cat
from lamina.sources.csv import CSV_OPTIONS, RAW_RECORD, read_csv, read_placed, routed
from lamina.sources.records import FILE, PLACE, RECORD, LineStates, parse_records, read_raw_records, split_starts
from lamina.sources.tables import create_layers, read_layer, read_rejects, table_name, write_layer
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("title", T.StringType()),
                       T.StructField("score", T.DoubleType())])


@pytest.fixture()
def small_splits(spark):
    """Splits of 2,000 bytes, so that a small file is read by many tasks."""
    names = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "16"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cell(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return '5" disk'
    if kind == 1:
        return "plain"
    if kind == 2:  # at times longer than several splits
        return '"' + "line\n" * (rng.randrange(1, 1500) if rng.random() < 0.02 else rng.randrange(1, 5)) + '"'
    return '"' + "".join(rng.choice(["a", "b", " ", ",", "\n", '""', "x\ny", "é"]) for _ in range(rng.randrange(40))) + '"'


def make_files(folder, seed, rows=800):
    rng = random.Random(seed)
    for f, end in enumerate(("\n", "\r\n")):
        with open(folder / f"f{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write('id,"ti\ntle",score\n')
            for i in range(rows):
                out.write(f'{i if rng.random() > 0.02 else "x"},{cell(rng)},{i / 2}{end}')
                if rng.random() < 0.01:
                    out.write("\n")


def one_task(spark, path):
    schema = T.StructType([*SCHEMA.fields, T.StructField("bad", T.StringType())])
    return spark.read.options(**CSV_OPTIONS, multiLine="true", columnNameOfCorruptRecord="bad").schema(schema).csv(str(path))


@pytest.mark.parametrize("seed", [1, 2])
def test_many_tasks_read_what_one_task_reads(spark, small_splits, tmp_path, seed):
    make_files(tmp_path, seed)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    got = parse_records(read_raw_records(spark, str(tmp_path)), SCHEMA, CSV_OPTIONS, "bad").collect()
    want = one_task(spark, tmp_path).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == 1600


def test_places_are_bytes_of_the_file(spark, small_splits, tmp_path):
    make_files(tmp_path, 3, rows=300)
    for r in read_raw_records(spark, str(tmp_path)).collect():
        with open(r[FILE].removeprefix("file:").replace("//", "/"), "rb") as f:
            f.seek(r[PLACE])
            text = r[RECORD].encode()
            assert f.read(len(text)) == text


@pytest.mark.parametrize("content", ["", "\n\n", "id,title,score", "id,title,score\n", 'id,t,s\n1,"open\n\n2,b,3', 'id,t,s\n1,"a""\n""b",2'])
def test_odd_files(spark, small_splits, tmp_path, content):
    (tmp_path / "f.csv").write_text(content)
    got = read_csv(spark, str(tmp_path), SCHEMA, multiline=True).collect()
    want = one_task(spark, tmp_path).select(*SCHEMA.fieldNames()).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_line_states():
    s = LineStates()
    for line, inside, expected in [
        ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False), ('b"', True, False),
        ('b"",c', True, True), ('5" disk,"x', False, True), ('"a"b,c', False, False), ('""', False, False), ('"""', False, True),
        ('x",y,"z', True, True), ('"a","', False, True), ("", True, True), ('",', True, False), ('a,""', False, False),
    ]:
        assert s.ends_inside(line, inside) is expected, (line, inside)


def test_states_compose_over_splits(spark):
    rng = random.Random(4)
    effects = [(i * 10, rng.choice([(False, True), (True, False), (False, False), (True, True)])) for i in range(60)]
    df = spark.createDataFrame([("f", b, o, i, 10) for b, (o, i) in effects], "file string, block long, out boolean, into boolean, size long")
    got = {r["block"]: (r["inside"], r["start"]) for r in split_starts(df).collect()}
    state = False
    for block, effect in effects:
        assert got[block] == (state, block)
        state = effect[state]


def test_routes(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,title,score\n1,a,1\nx,b,2\n3\n")
    for malformed, accepted in (("keep", {(1, "a"), (None, "b"), (3, None)}), ("reject", {(1, "a")})):
        name = f"default.rj_{uuid.uuid4().hex[:8]}"
        for multiline in (False, True):
            rows = routed(read_placed(spark, str(tmp_path), SCHEMA, multiline), malformed)
            write_layer(rows, name, route=("route", [RAW_RECORD, FILE, PLACE]))
            assert read_layer(spark, name).columns == SCHEMA.fieldNames()
            assert {(r["id"], r["title"]) for r in read_layer(spark, name).collect()} == accepted
            assert {(r["id"], r["title"]) for r in spark.table(name).collect()} == accepted
            found = {(r[RAW_RECORD], r[PLACE]) for r in read_rejects(spark, name).collect()}
            assert found == ({("x,b,2", 21), ("3", 27)} if multiline else {("x,b,2", 0), ("3", 0)})
    with pytest.raises(ValueError):
        routed(read_placed(spark, str(tmp_path), SCHEMA), "drop")


def test_nothing_accepted_or_nothing_rejected(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,title,score\nx,b,2\n")
    name = f"default.rj_{uuid.uuid4().hex[:8]}"
    write_layer(routed(read_placed(spark, str(tmp_path), SCHEMA), "reject"), name, route=("route", [RAW_RECORD, FILE, PLACE]))
    assert read_layer(spark, name).count() == 0 and spark.table(name).count() == 0 and read_rejects(spark, name).count() == 1
    write_layer(read_layer(spark, name), name)
    with pytest.raises(ValueError):
        read_rejects(spark, name)


def test_bronze_reports_malformed_records_without_a_second_parse(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,poster_path,backdrop_path\n1,a,b\n2,"two\nlines",c\n3,short\n')
    create_layers(spark, "rej")
    row = cat.run_bronze(spark, str(tmp_path), "poster_path", "rej", multiline=True)
    assert (row["rows"], row["null_keys"], row["malformed"]) == (3, 0, 1)
    name = table_name("rej", "bronze", "poster_path")
    assert {r["poster_path"] for r in read_layer(spark, name).collect()} == {"a", "two\nlines", "short"}
    assert [(r[RAW_RECORD], r["id"]) for r in read_rejects(spark, name).collect()] == [("3,short", 3)]
    row = cat.run_bronze(spark, str(tmp_path), "poster_path", "rej", malformed="reject", multiline=True)
    assert (row["rows"], row["malformed"]) == (2, 1)
    assert len(RAW["poster_path"]) == 3


def test_documents_become_csv_by_many_tasks(spark, small_splits, tmp_path, monkeypatch):
    from lamina.plans import queries as plans

    rows = [(i, f'text {i}, with "quotes"\nand lines' * (i % 4), "s", "en", 9 * i) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    docs.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    paths, write = [], plans.write_test_csv
    monkeypatch.setattr(plans, "write_test_csv", lambda *a: paths.append(write(*a)) or paths[-1])
    got = {r["doc_id"]: tuple(r)[1:] for r in plans.csv_records(spark, str(tmp_path)).collect()}
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest() if t else None
    assert got == {i: (md5(t), s, lang, n) for i, t, s, lang, n in rows}
    assert spark.read.text(paths[0]).select("_metadata.file_path").distinct().count() > 1  # no task holds them all
