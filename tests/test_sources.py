"""CSV source edge rows and the layer sink."""

import os
import tempfile

from pyspark.sql import types as T

from lamina.contracts import RAW
from lamina.sources.csv import read_csv, with_audit
from lamina.sources.tables import ContractError, conform, create_layers, list_tables, read_layer, write_layer

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("score", T.DoubleType()),
])


def write_text(text):
    d = tempfile.mkdtemp(prefix="lamina-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_csv_edge_rows(spark):
    p = write_text(
        "wrong,header,names\n"
        '1,"He said ""hi"", ok",7.5\n'
        "xx,bad id,8\n"
        "3,short\n"
        '5,"",\n'
        "6,extra,1.0,zzz\n"
    )
    rows = [tuple(r) for r in read_csv(spark, p, SCHEMA).collect()]
    assert rows == [
        (1, 'He said "hi", ok', 7.5),
        (None, "bad id", 8.0),
        (3, "short", None),
        (5, None, None),
        (6, "extra", 1.0),
    ]


def test_csv_corrupt_column(spark):
    p = write_text("id,title,score\n1,a,1.0\nxx,b,2.0\n")
    rows = read_csv(spark, p, SCHEMA, corrupt_col="_bad").collect()
    assert rows[0]["_bad"] is None and rows[1]["_bad"] == "xx,b,2.0"


def test_csv_multiline(spark):
    p = write_text('id,title,score\n1,"two\nlines",1.0\n')
    assert read_csv(spark, p, SCHEMA).count() == 2
    rows = read_csv(spark, p, SCHEMA, multiline=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines", 1.0)]


def test_audit_columns(spark):
    p = write_text("id,title,score\n1,a,1.0\n")
    row = with_audit(read_csv(spark, p, SCHEMA)).first()
    assert row["archivo_origen"].endswith("f.csv") and row["fecha_ingesta"] is not None


def test_conform_rejects_missing(spark):
    df = spark.createDataFrame([(1, "a")], "id long, title string")
    try:
        conform(df, SCHEMA)
        raise AssertionError("expected ContractError")
    except ContractError as e:
        assert "score" in str(e)
    ok = conform(df.withColumn("score", df.id * 2), SCHEMA)
    assert ok.schema == SCHEMA


def test_create_and_write_layers(spark):
    names = create_layers(spark, "lt")
    assert "lt_bronze.movies" in names and len(names) == 10
    assert "peliculas" in list_tables(spark, "lt_silver")
    df = spark.createDataFrame([(1, "t")], "id int, title string")
    full = conform(
        df.selectExpr("id", "title", *[f"cast(null as {f.dataType.simpleString()}) as {f.name}"
                                       for f in RAW["movies"].fields[2:]]),
        RAW["movies"],
    )
    write_layer(full, "default.lt_raw_movies")
    assert read_layer(spark, "default.lt_raw_movies").collect()[0]["title"] == "t"
