"""The layered job end to end: CSV -> bronze -> silver -> golden, with gates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lamina.contracts import BRONZE, GOLDEN, SILVER
from lamina.operators.quality import DataQualityError
from lamina.plans import catalogue as cat
from lamina.plans.fixtures import raw_tables
from lamina.plans.queries import table, write_test_csv
from lamina.sources.tables import create_layers, read_layer, read_ordered, table_name, write_layer

RUN = dt.datetime(2024, 1, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def raw_paths(spark, sf_small):
    raw = raw_tables(spark, table(spark, sf_small, "part"))
    return {name: write_test_csv(df, f"test_raw_{name}") for name, df in raw.items()}, raw


def test_pipeline_end_to_end(spark, raw_paths):
    paths, raw = raw_paths
    prefix = "e2e"
    create_layers(spark, prefix)
    for name, path in paths.items():
        row = cat.run_bronze(spark, path, name, prefix, RUN)
        assert row["rows"] == 400 and row["null_keys"] == 0
        assert read_layer(spark, table_name(prefix, "bronze", name)).schema == BRONZE[name]
    report = cat.run_silver(spark, prefix, RUN)
    films = read_layer(spark, table_name(prefix, "silver", "peliculas"))
    assert films.schema == SILVER["peliculas"]
    assert report.metrics["rows"] == films.count() and report.metrics["duplicate_keys"] == 0
    assert report.duplicates_removed > 0
    expected = cat.silver_films(raw["movies"], raw["film_details"], raw["more_info"], raw["poster_path"], RUN)
    assert sorted(films.collect()) == sorted(expected.collect())

    counts = cat.run_golden(spark, prefix, RUN)
    assert all(v > 0 for v in counts.values())
    for name, schema in GOLDEN.items():
        t = read_layer(spark, table_name(prefix, "golden", name))
        assert t.schema == schema and t.count() == counts[name]
    genre = read_layer(spark, table_name(prefix, "golden", "kpi_genero"))
    assert genre.filter(F.col("ranking_ingresos") == 1).count() >= 1


def test_bronze_gate_rejects_null_ids(spark, sf_small):
    bad = table(spark, sf_small, "part").selectExpr(
        "case when p_partkey % 3 = 0 then 'x' else cast(p_partkey as string) end as id",
        "'p' as poster_path", "'b' as backdrop_path",
    )
    path = write_test_csv(bad, "bad_posters")
    create_layers(spark, "gate")
    with pytest.raises(DataQualityError, match="NULL key"):
        cat.run_bronze(spark, path, "poster_path", "gate")


def test_silver_gate_rejects_fanout(spark, raw_paths):
    paths, _ = raw_paths
    prefix = "fan"
    create_layers(spark, prefix)
    for name, path in paths.items():
        cat.run_bronze(spark, path, name, prefix)
    dup = read_layer(spark, table_name(prefix, "bronze", "poster_path"))
    write_layer(dup.unionByName(dup), table_name(prefix, "bronze", "poster_path"))
    with pytest.raises(DataQualityError, match="repeated keys"):
        cat.run_silver(spark, prefix)


def test_run_pipeline_records_metrics(spark, raw_paths):
    paths, _ = raw_paths
    out = cat.run_pipeline(spark, paths, "full", RUN)
    assert set(out) == {"bronze", "silver", "golden"}
    m = spark.table("full_ops.run_metrics")
    assert m.filter("step = 'golden'").count() == 4
    films = m.filter("table_name = 'peliculas'").first()
    assert films["row_count"] == out["silver"]["peliculas"]["row_count"] and films["duplicates_removed"] > 0
    assert sorted(r["table_name"] for r in m.filter("step = 'silver'").collect()) == ["peliculas", "peliculas_genero"]
    assert m.filter("table_name <> 'peliculas' and duplicates_removed is not null").count() == 0


def test_a_run_leaves_no_scratch_and_an_ordered_table(spark, raw_paths, tmp_path):
    from pathlib import Path

    from lamina.session import checkpoint_root

    paths, _ = raw_paths
    for _ in range(3):
        cat.run_pipeline(spark, paths, "twice", RUN)
    assert not list(Path(checkpoint_root(spark).removeprefix("file:")).glob("lamina-run-*"))
    years = [r["anio_estreno"] for r in read_ordered(spark, table_name("twice", "golden", "kpi_anual")).collect()]
    assert years == sorted(years) and len(years) > 10
    assert spark.table("twice_ops.run_metrics").count() == 10  # the same run three times over


def test_failed_gate_leaves_the_old_table(spark, raw_paths):
    paths, raw = raw_paths
    create_layers(spark, "keepold")
    cat.run_bronze(spark, paths["movies"], "movies", "keepold", RUN)
    name = table_name("keepold", "bronze", "movies")
    before = sorted(map(str, read_layer(spark, name).collect()))
    bad = write_test_csv(raw["movies"].withColumn("id", F.lit("x")), "bad_movies")
    with pytest.raises(DataQualityError):
        cat.run_bronze(spark, bad, "movies", "keepold", RUN)
    assert sorted(map(str, read_layer(spark, name).collect())) == before


def test_replacing_reads_itself_and_changes_shape(spark):
    name = "default.replaced"
    write_layer(spark.range(5), name)
    write_layer(read_layer(spark, name).selectExpr("id + 10 as id"), name)
    assert sorted(r["id"] for r in read_layer(spark, name).collect()) == [10, 11, 12, 13, 14]
    write_layer(read_layer(spark, name).selectExpr("id", "'x' as more"), name)
    assert read_layer(spark, name).columns == ["id", "more"]


def test_environment_prefix():
    assert cat.environment_prefix(" Dev ") == "peliculas_dev"
    with pytest.raises(ValueError):
        cat.environment_prefix("qa")


def test_ordered_outputs(spark, sf_small):
    from lamina.plans import queries as Qm

    years = [r["anio_estreno"] for r in Qm.film_kpi_year(spark, sf_small).collect()]
    assert years == sorted(years) and len(years) == len(set(years))
    top = Qm.ordered_limit(spark, sf_small).collect()
    prices = [r["o_totalprice"] for r in top]
    assert len(top) == 10 and prices == sorted(prices, reverse=True)
