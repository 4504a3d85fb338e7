"""Registered queries: every operator exercised on the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (or data Spark derives from them). Columns are aliased to the names
the DuckDB oracle uses. Queries that rank, publish or read CSV run jobs while
they are built: they write their input to the shared scratch folder
(``spark.checkpoint.dir``) or to tables of a fresh prefix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.contracts import BRONZE, INGEST_TS, LAYERS, RUN_TS, SOURCE_FILE, without
from lamina.functions import columns as C
from lamina.operators import quality as Q
from lamina.operators.ranking import asc, desc, global_rank
from lamina.operators.relational import dedupe_first, enrich_left, explode_list, kpi, late_lookup, top_k
from lamina.plans import catalogue as cat
from lamina.plans.fixtures import movies_with_null_ids, raw_tables
from lamina.session import scratch_path
from lamina.sources.csv import RAW_RECORD, ROUTE, read_csv, read_placed, routed, with_audit
from lamina.sources.records import FILE, PLACE
from lamina.sources.tables import (
    ContractDrift, conform, drop_layers, drop_table, ensure_tables, held_layer, list_tables, preview, read_layer,
    read_ordered, read_rejects, stage, table_name, table_version, write_layer,
)
from lamina.sources.versions import PublishConflict


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_test_csv(df: DataFrame, name: str) -> str:
    """Write ``df`` as CSV (header, no whitespace trimming) to fresh scratch space."""
    path = scratch_path(df.sparkSession, name)
    (
        df.write.option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("escape", '"')
        .csv(path)
    )
    return path


CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


def file_suffix(c: str = SOURCE_FILE):
    return F.regexp_extract(F.col(c), r"\.([A-Za-z0-9]+)$", 1)


# --- sources and sinks ----------------------------------------------------

def csv_roundtrip(spark, sf_dir):
    path = write_test_csv(table(spark, sf_dir, "customer"), "customer_csv")
    df = with_audit(read_csv(spark, path, CUSTOMER))
    return df.select(*CUSTOMER.fieldNames(), file_suffix().alias("source_ext"))


def _corrupted_csv(spark, sf_dir) -> str:
    """Customers as CSV; every tenth has no number for a key."""
    cust = table(spark, sf_dir, "customer")
    corrupted = cust.select(
        F.when(F.col("c_custkey") % 10 == 0, F.lit("xx"))
        .otherwise(F.col("c_custkey").cast("string")).alias("c_custkey"),
        "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
    )
    return write_test_csv(corrupted, "customer_bad_csv")


def csv_permissive(spark, sf_dir):
    return read_csv(spark, _corrupted_csv(spark, sf_dir), CUSTOMER)


def csv_records(spark, sf_dir):
    """Documents through CSV files: texts with newlines, quotes and delimiters, read by many tasks.

    Each task that reads the table writes a file of its own, so no file outgrows
    what one task can hold; the reader splits the files again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang", "n_chars")
    path = write_test_csv(docs, "documents_csv")
    return read_csv(spark, path, docs.schema, multiline=True).select(
        "doc_id", F.md5("text").alias("text_md5"), "source", "lang", "n_chars")


def csv_rejects(spark, sf_dir):
    """Malformed records under both policies: what the table holds and what lies beside it."""
    path = _corrupted_csv(spark, sf_dir)
    out = []
    for policy, malformed in (("kept", "keep"), ("dropped", "reject")):
        name = f"default.lamina_rejects_{uuid.uuid4().hex[:12]}"
        rows = routed(read_placed(spark, path, CUSTOMER), malformed)
        write_layer(rows, name, route=(ROUTE, [RAW_RECORD, FILE, PLACE]))
        parts = {"accepted": read_layer(spark, name).withColumn(RAW_RECORD, F.lit(None).cast("string")), "rejected": read_rejects(spark, name)}
        out += [stage(df.select(F.lit(policy).alias("policy"), F.lit(r).alias("route"), "c_custkey", "c_name", "c_acctbal", RAW_RECORD), "taken")
                for r, df in parts.items()]
        drop_table(spark, name)
    return reduce(DataFrame.unionByName, out)


def sink_roundtrip(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    schema = T.StructType([
        T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ])
    name = f"default.lamina_nation_{uuid.uuid4().hex[:12]}"
    write_layer(conform(nation, schema), name)
    return _taken(spark, name)


def _taken(spark, name: str, read=read_layer) -> DataFrame:
    """The rows of a table that only this query needs: staged, then the table is dropped."""
    rows = stage(read(spark, name), "taken")
    drop_table(spark, name)
    return rows


def sink_replace(spark, sf_dir):
    """A table is replaced twice; a refused third version leaves the second."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    name = f"default.lamina_orders_{uuid.uuid4().hex[:12]}"
    write_layer(orders.filter("o_orderkey % 2 = 0"), name)
    write_layer(read_layer(spark, name).withColumn("o_totalprice", -F.col("o_totalprice"))
                .unionByName(orders.filter("o_orderkey % 2 <> 0")), name)

    def refuse(_):
        raise Q.DataQualityError("refused")

    try:
        write_layer(orders.filter("false"), name, gate=refuse)
    except Q.DataQualityError:
        pass
    return _taken(spark, name)


def publish_conflict(spark, sf_dir):
    """Four writers replace a table at once, one more builds on a version that is gone,
    and a reader keeps the version it began with throughout."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    name = f"default.lamina_race_{uuid.uuid4().hex[:12]}"
    write_layer(orders.withColumn("writer", F.lit(0)), name)

    def publish(writer: int) -> None:
        # every second order: a mix of two versions would show in the count
        write_layer(orders.filter(F.col("o_orderkey") % 2 == writer % 2).withColumn("writer", F.lit(writer)), name, keep_seconds=0.0)

    with held_layer(spark, name) as first:
        cat.run_concurrently({str(w): (lambda w=w: publish(w)) for w in range(1, 5)}, 4)
        seen = first.agg(F.count(F.lit(1)).alias("n"), F.max("writer").alias("w")).first()
    try:
        write_layer(orders.withColumn("writer", F.lit(9)), name, base=1)
        refused = False
    except PublishConflict:
        refused = True
    now = read_layer(spark, name)
    parity = now.agg(F.count_distinct("writer").alias("writers"), F.count(F.lit(1)).alias("n"),
                     F.count_if(F.col("o_orderkey") % 2 != F.col("writer") % 2).alias("foreign"),
                     F.max("writer").alias("w")).first()
    whole = orders.filter(F.col("o_orderkey") % 2 == parity["w"] % 2).count()
    catalog = spark.table(name).agg(F.max("writer")).first()[0]
    rows = [(table_version(spark, name), int(parity["writers"]), parity["n"] == whole, int(parity["foreign"]), refused,
             int(seen["n"]), int(seen["w"]), catalog == parity["w"])]
    drop_table(spark, name)
    return spark.createDataFrame(rows, "versions int, writers int, whole boolean, foreign_rows int, stale_refused boolean, "
                                       "reader_rows bigint, reader_writer int, catalog_agrees boolean")


def contract_drift(spark, sf_dir):
    """A table of an older contract is migrated with its rows; a lossy change is refused before any write."""
    old = T.StructType([T.StructField("o_custkey", T.IntegerType()), T.StructField("o_orderkey", T.IntegerType()),
                        T.StructField("o_totalprice", T.DoubleType())])
    new = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                        T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_note", T.StringType())])
    lossy = T.StructType([T.StructField("o_orderkey", T.IntegerType()), *new.fields[1:]])
    name = f"default.lamina_drift_{uuid.uuid4().hex[:12]}"
    write_layer(conform(table(spark, sf_dir, "orders"), old), name)
    ensure_tables(spark, {name: new})
    before = table_version(spark, name)
    try:
        ensure_tables(spark, {name: lossy})
        said = None
    except ContractDrift as e:
        said = str(e).split(": ", 1)[1]
    same = table_version(spark, name) == before and spark.table(name).schema.simpleString() == new.simpleString()
    return _taken(spark, name).withColumns({"refused": F.lit(said), "unchanged": F.lit(same)})


def ordered_files(spark, sf_dir):
    """Orders published by price, read back in order without a sort: each row's place."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    name = f"default.lamina_ordered_{uuid.uuid4().hex[:12]}"
    write_layer(orders, name, order=["o_totalprice", "o_orderkey"])
    # the id of a partition and the row's place in it, in the order that the reader gives
    rows = stage(read_ordered(spark, name).withColumn("at", F.monotonically_increasing_id()), "ordered")
    drop_table(spark, name)
    return global_rank(rows, [asc("at")], "row_number", "place").drop("at")


# --- projections and scalar functions ------------------------------------

def clean_text(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        C.clean_text(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name_clean"),
        C.clean_code(F.concat(F.lit(" "), "p_brand", F.lit(" "))).alias("brand_code"),
        C.normalize_list(
            F.concat("p_type", F.lit(" ,"), F.replace("p_name", F.lit(" "), F.lit("  , ")))
        ).alias("type_list"),
    )


def parse_digits(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 5
    whole = F.floor("c_acctbal").cast("bigint").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("$"), whole, F.lit(",000")))
        .when(k == 1, F.concat(F.lit("-$"), F.col("c_custkey").cast("string"), F.lit(".50")))
        .when(k == 2, F.lit("n/a"))
        .when(k == 3, F.concat(F.lit("$"), F.repeat(F.lit("9"), 20)))
        .otherwise(F.concat(F.lit("USD "), whole))
    )
    return cust.select("c_custkey", text.alias("amount_text")).select(
        "c_custkey", "amount_text", C.parse_digits("amount_text").alias("amount")
    )


def parse_iso_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    iso = F.col("o_orderdate").cast("date").cast("string")
    k = F.col("o_orderkey") % 7
    text = (
        F.when(k == 0, F.replace(iso, F.lit("-"), F.lit("/")))
        .when(k == 1, F.concat(F.year("o_orderdate").cast("string"), F.lit("-02-30")))
        .when(k == 2, F.concat(F.year("o_orderdate").cast("string"), F.lit("-13-45")))
        .otherwise(iso)
    )
    return orders.select("o_orderkey", text.alias("date_text")).select(
        "o_orderkey", "date_text", C.parse_iso_date("date_text").alias("parsed_date")
    )


def _film_raw(spark, sf_dir):
    return raw_tables(spark, table(spark, sf_dir, "part"))


def duration_minutes(spark, sf_dir):
    raw = _film_raw(spark, sf_dir)
    movies = raw["movies"].select(
        "id", C.minutes("runtime_hour", "runtime_min").alias("duracion_min")
    )
    info = raw["more_info"].select(
        "film_id", C.parse_duration("runtime").alias("minutes_in_text")
    )
    joined = enrich_left(movies, info, on="id", dim_key="film_id")
    return joined.select(
        "id", "duracion_min", "minutes_in_text",
        C.agrees("duracion_min", "minutes_in_text").alias("duracion_consistente"),
    )


def first_item(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    listed = F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit(" , ")), F.lit(" "))
    return part.select("p_partkey", C.first_item(listed).alias("first_word"))


def buckets(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    mins = F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_size") * 4)
    score = F.when(F.col("p_partkey") % 11 == 0, F.lit(None)).otherwise(F.col("p_size") / 5.0)
    return part.select("p_partkey", mins.cast("int").alias("minutes"), score.alias("score")).select(
        "p_partkey", "minutes", "score",
        C.duration_bucket("minutes").alias("duration_bucket"),
        C.score_bucket("score").alias("score_bucket"),
    )


def calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    return orders.select("o_orderkey", year.alias("order_year"), C.decade(year).alias("order_decade"))


def prefer_positive(spark, sf_dir):
    raw = _film_raw(spark, sf_dir)
    details = raw["film_details"].select("id", "budget_usd", "revenue_usd")
    info = raw["more_info"].select(
        "film_id",
        C.parse_digits("budget").alias("budget_text"),
        C.parse_digits("revenue").alias("revenue_text"),
    )
    j = enrich_left(details, info, on="id", dim_key="film_id")
    b = C.positive_or_null(C.prefer("budget_usd", "budget_text"))
    r = C.positive_or_null(C.prefer("revenue_usd", "revenue_text"))
    out = j.select("id", b.alias("presupuesto_usd"), r.alias("ingresos_usd"))
    out = out.withColumn("ganancia_usd", F.col("ingresos_usd") - F.col("presupuesto_usd"))
    return out.withColumn("roi", C.ratio("ganancia_usd", "presupuesto_usd", 2))


def rounding(spark, sf_dir):
    """One rounding of doubles just beside and at a tie, and of ratios."""
    part = table(spark, sf_dir, "part")
    edges = F.array(*[F.lit(v) for v in ROUNDING_EDGES])
    x = part.select("p_partkey", F.explode(edges).alias("edge")).withColumn(
        "v", F.col("edge") + (F.col("p_partkey") % 100))
    return x.select(
        "p_partkey", "edge", "v", C.round_half_up("v", 2).alias("r2"), C.round_half_up(-F.col("v"), 1).alias("r1"),
        C.ratio(F.col("p_partkey") % 997, (F.col("p_partkey") % 8) * 25, 2).alias("share"),
    )


# Values whose rounding goes wrong when done twice or on the binary fraction.
ROUNDING_EDGES = (7.4949998, 2.4949996, 0.0049996, 1.005, 2.675, 0.125, 0.05, 1234567.445)


def overflow_parsing(spark, sf_dir):
    """Amounts and durations beyond their types give NULL instead of failing the job."""
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 6
    hours = F.when(k == 0, F.lit("99999999")).when(k == 1, F.lit("9" * 25)).when(k == 2, F.lit("35791394")) \
        .otherwise((F.col("c_custkey") % 5).cast("string"))
    x = cust.select(
        "c_custkey", "c_nationkey", F.concat(hours, F.lit("h "), (F.col("c_custkey") % 60).cast("string"), F.lit(" min")).alias("runtime"),
        F.concat(F.lit("$"), F.when(k == 3, F.lit("9" * 18)).otherwise(F.col("c_custkey").cast("string"))).alias("amount_text"))
    parsed = x.select("c_custkey", "c_nationkey", C.parse_duration("runtime").alias("minutes"),
                      C.parse_digits("amount_text").alias("amount"))
    per_nation = kpi(parsed, ["c_nationkey"], [C.whole_sum(F.col("amount") * 9).alias("nation_sum")])
    return enrich_left(parsed, per_nation, on="c_nationkey").withColumn(
        "total", C.minutes(F.col("c_custkey") * 1_000_000_000, F.lit(5)))


# --- filters and joins ----------------------------------------------------

def filters(spark, sf_dir):
    # some ids, languages and texts are blanked, so that every predicate removes rows
    k = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select(
        F.when(k % 7 != 3, k).alias("doc_id"), F.when(k % 5 != 2, F.col("lang")).alias("lang"), "n_chars",
        F.when(k % 4 == 1, F.lit("   ")).otherwise(F.col("text")).alias("text"))
    labels = table(spark, sf_dir, "labels")
    j = enrich_left(docs, labels, on="doc_id")
    return (
        j.filter(F.col("doc_id").isNotNull())                       # F01
        .filter(F.col("n_chars") >= 200)                           # F03
        .filter(F.trim("text") != "")                              # F04
        .filter(F.col("lang").isNotNull())                          # F05
        .filter(~(F.col("toxic") == 1))                             # F06: NULL dropped
        .filter(F.col("text").rlike("[A-Za-z]"))                    # F07
        .select("doc_id", "lang", "n_chars", "quality", "toxic",
                F.col("toxic").isNull().alias("toxic_unknown"))     # F02
    )


def enrich_left_q(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "label_doc_id")
    return enrich_left(docs, labels, on="doc_id", dim_key="label_doc_id")


def enrich_broadcast(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = enrich_left(cust, nation, on="c_nationkey", dim_key="n_nationkey", broadcast=True)
    return out.select("c_custkey", "c_name", "c_nationkey", "n_name")


def enrich_hot_key(spark, sf_dir):
    """Half of the line items name one supplier, some name none: their rows are dealt over all tasks."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 2 == 0, 7).when(F.col("l_orderkey") % 11 != 5, F.col("l_suppkey")).alias("l_suppkey"))
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return enrich_left(li, supp, on="l_suppkey", dim_key="s_suppkey", spread_hot_keys=True)


def opt_ins(spark, sf_dir):
    """Amounts with sign and decimals, a label of their own for unknown values, and a
    first source whose zero does not hide the second."""
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 6
    bal = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    text = F.when(k == 0, F.concat(F.lit("$"), bal)).when(k == 1, F.lit("n/a")).when(k == 2, F.lit("1.2.3")) \
        .when(k == 3, F.concat(F.lit("USD 1,"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit(".5"))) \
        .when(k == 4, F.lit("5-3")).otherwise(F.concat(F.lit("-$"), (F.col("c_custkey") % 100).cast("string")))
    x = cust.select("c_custkey", text.alias("said"), F.when(k != 2, F.col("c_custkey") % 200).cast("int").alias("minutes"),
                    F.when(k != 3, (F.col("c_custkey") % 100) / 10.0).alias("score"),
                    F.when(k != 4, F.col("c_custkey") % 3 - 1).alias("first"), (F.col("c_custkey") % 7).alias("second"))
    return x.select(
        "c_custkey", "said", C.parse_money("said").cast("double").alias("money"),
        C.duration_bucket("minutes", null_label="Desconocida").alias("duration_bucket"),
        C.score_bucket("score", null_label="Sin nota").alias("score_bucket"),
        C.prefer("first", "second").alias("preferred"), C.prefer("first", "second", null_if_nonpositive=True).alias("preferred_positive"))


# --- aggregation ----------------------------------------------------------

def kpi_one_key(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return kpi(li, ["l_returnflag"], [
        C.row_count().alias("total_rows"),
        C.exact_avg("l_quantity").rounded(2).alias("avg_qty"),
        C.exact_sum("l_quantity").rounded(2).alias("sum_qty"),
        C.exact_avg("l_extendedprice").rounded(0).alias("avg_price"),
        C.exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).rounded(2).alias("sum_disc_price"),
    ])


def kpi_two_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    o = orders.select(year.alias("order_year"), C.decade(year).alias("order_decade"), "o_totalprice")
    return kpi(o, ["order_year", "order_decade"], [
        C.row_count().alias("total_orders"),
        C.exact_avg("o_totalprice").rounded(2).alias("avg_price"),
        C.exact_sum("o_totalprice").rounded(2).alias("sum_price"),
    ])


def kpi_min_rows(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return kpi(ev, ["user_id"], [
        C.row_count().alias("total_events"),
        C.exact_avg("value").rounded(2).alias("avg_value"),
        F.count_distinct("event_type").alias("event_types"),
    ], min_rows=60, count_col="total_events")


def kpi_mixed(spark, sf_dir):
    """Sums and averages over magnitudes that lose digits when added as doubles, and over NaN."""
    k = (F.col("l_orderkey") % 8).cast("int")
    edges = F.array(*[F.lit(v) for v in ROUNDING_EDGES])
    li = table(spark, sf_dir, "lineitem").select(
        k.alias("k"), F.get(edges, k).alias("edge"), (F.col("l_discount") * 4.9e-7).alias("tiny"),
        F.when(F.col("l_linenumber") == 1, 1e23).otherwise(F.col("l_quantity")).alias("mixed"),
        F.when((k == 3) & (F.col("l_linenumber") == 2), float("nan")).otherwise(F.col("l_tax")).alias("tax"))
    out = kpi(li, ["k"], [
        C.row_count().alias("total_rows"), C.exact_avg("edge").rounded(2).alias("edge_avg"),
        C.exact_sum("mixed").alias("mixed_sum"), C.exact_avg("mixed").alias("mixed_avg"),
        C.exact_sum("tiny").alias("tiny_sum"), C.exact_avg("tiny").alias("tiny_avg"), C.exact_sum("tax").alias("tax"),
    ])
    return out.withColumn("tax_is_nan", F.isnan("tax")).drop("tax")


# --- windows --------------------------------------------------------------

LINEITEM_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def dedupe_first_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return dedupe_first(li, ["l_orderkey", "l_linenumber"], LINEITEM_REST)


def global_dense_rank(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    per_supp = kpi(li, ["l_suppkey"], [C.exact_avg("l_discount").rounded(4).alias("avg_disc")])
    return global_rank(per_supp, [desc("avg_disc")], "dense_rank", "disc_rank")


def global_row_number(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    per_part = kpi(li, ["l_partkey"], [
        C.exact_avg("l_discount").rounded(4).alias("avg_disc"),
        C.exact_sum("l_quantity").rounded(2).alias("total_qty"),
    ])
    order = [desc("avg_disc"), desc("total_qty"), asc("l_partkey")]
    return global_rank(per_part, order, "row_number", "part_rank")


LINEITEM_ORDER = [desc("l_extendedprice"), asc("l_orderkey"), asc("l_linenumber")] + [
    asc(c) for c in LINEITEM_REST if c != "l_extendedprice"
]


def global_row_number_rows(spark, sf_dir):
    """Row number of every line item by price (desc), then all other columns."""
    li = table(spark, sf_dir, "lineitem")
    ranked = global_rank(li, LINEITEM_ORDER, "row_number", "price_rank")
    return ranked.select("l_orderkey", "l_linenumber", "l_extendedprice", "price_rank")


def global_dense_rank_rows(spark, sf_dir):
    """Dense rank of every line item by quantity (few values, each a hot key)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return global_rank(li, [desc("l_quantity")], "dense_rank", "qty_rank")


def top_k_per_group(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    top = stage(top_k(
        ev.filter(F.col("value") >= 100).select("event_id", "event_type", "user_id", "value"),
        ["event_type"], [F.col("value").desc(), F.col("event_id").asc()], 10, "ranking",
    ), "top_events")
    return late_lookup(top, ev, "event_id", ["props"])


def explode_list_q(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return explode_list(part.select("p_partkey", "p_name"), "p_name", "word", sep=" ").select(
        "p_partkey", "word"
    )


def ordered_limit(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(orders, 10, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])


def quality_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return Q.metrics(
        li,
        key="l_orderkey",
        conditions={
            "discounted": F.col("l_discount") > 0.05,
            "returned": F.col("l_returnflag") == "R",
        },
        distinct={"distinct_parts": "l_partkey", "distinct_suppliers": "l_suppkey", "distinct_prices": "l_extendedprice"},
    )


GATES = {"not_empty": Q.not_empty, "no_null_keys": Q.no_null_keys, "unique_keys": Q.unique_keys}


def quality_gates(spark, sf_dir):
    """What each gate says of tables that break it in one way, as rows."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    some = F.col("id") % 10 == 3
    tables = {
        "good": orders, "empty": orders.filter("id < 0"),
        "null_ids": orders.withColumn("id", F.when(~some, F.col("id"))), "repeated": orders.unionByName(orders.filter(some)),
    }
    rows = []
    for name, df in tables.items():
        for gate, rule in GATES.items():
            try:
                Q.check(Q.metrics(df, key="id"), {gate: rule}, name)
                rows.append((name, gate, None))
            except Q.DataQualityError as e:
                rows.append((name, gate, str(e)))
    try:
        Q.check_unique_keys({r["source"]: r for r in Q.key_report(tables).collect()})
    except Q.DataQualityError as e:
        rows.append(("all", "key_report", str(e)))
    return spark.createDataFrame(rows, "source string, gate string, failure string")


# --- catalogue jobs -------------------------------------------------------

def _bronze_query(source: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        raw = _film_raw(spark, sf_dir)[source]
        path = write_test_csv(raw, f"raw_{source}_csv")
        out = cat.bronze(spark, path, source)
        cols = without(BRONZE[source], INGEST_TS, SOURCE_FILE).fieldNames()
        return out.select(*cols, file_suffix().alias("source_ext"))

    q.__name__ = f"film_bronze_{source}"
    return q


def _silver(spark, sf_dir):
    raw = _film_raw(spark, sf_dir)
    movies = movies_with_null_ids(spark, table(spark, sf_dir, "part"))
    return cat.silver_films(movies, raw["film_details"], raw["more_info"], raw["poster_path"])


def _silver_staged(spark, sf_dir):
    """Silver written once to the shared scratch folder, as the pipeline reads it."""
    return stage(_silver(spark, sf_dir), "silver_for_golden")


def _compared(df: DataFrame) -> DataFrame:
    return df.drop(RUN_TS)


def film_silver(spark, sf_dir):
    return _compared(_silver(spark, sf_dir))


def film_genre_rows(spark, sf_dir):
    return _compared(cat.genre_rows(_silver(spark, sf_dir)))


def film_kpi_genre(spark, sf_dir):
    return _compared(cat.kpi_by_genre(cat.genre_rows(_silver_staged(spark, sf_dir))))


def film_kpi_year(spark, sf_dir):
    return _compared(cat.kpi_by_year(_silver_staged(spark, sf_dir), ordered=True))


def film_top_directors(spark, sf_dir):
    return _compared(cat.top_directors(_silver_staged(spark, sf_dir)))


def film_top_films(spark, sf_dir):
    films = _silver_staged(spark, sf_dir)
    return _compared(cat.top_films_by_genre(cat.genre_rows(films), films))


PUBLISH_TS = datetime(2024, 5, 6, 7, 8, 9)


def _published(spark, sf_dir) -> str:
    """The whole layered job from CSV files into databases of a fresh prefix."""
    paths = {name: write_test_csv(df, f"raw_{name}") for name, df in _film_raw(spark, sf_dir).items()}
    prefix = f"lamina_{uuid.uuid4().hex[:12]}"
    cat.run_pipeline(spark, paths, prefix, PUBLISH_TS)
    return prefix


def published_metrics(spark, sf_dir):
    """The run-metrics table: one row per published table."""
    prefix = _published(spark, sf_dir)
    # a step that is recorded again replaces what it recorded before
    golden = spark.table(f"{prefix}_ops.{cat.RUN_METRICS_TABLE}").filter("step = 'golden'").collect()
    cat.record_run_metrics(spark, prefix, "golden", {r["table_name"]: {"row_count": r["row_count"]} for r in golden}, PUBLISH_TS)
    rows = stage(spark.table(f"{prefix}_ops.{cat.RUN_METRICS_TABLE}"), "taken")
    drop_layers(spark, prefix, "ops")
    return rows


def published_golden(spark, sf_dir):
    """The published genre KPIs and their run timestamp, read back from the catalog."""
    prefix = _published(spark, sf_dir)
    rows = stage(read_layer(spark, table_name(prefix, "golden", "kpi_genero")), "taken")
    drop_layers(spark, prefix, "ops")
    return rows


def published_films(spark, sf_dir):
    """Published top films with the layers that exist, read back from the catalog."""
    prefix = _published(spark, sf_dir)
    layers = len([d for d in spark.catalog.listDatabases(f"{prefix}_*") if not d.name.endswith("_ops")])
    n = sum(len(list_tables(spark, f"{prefix}_{layer}")) for layer in LAYERS)
    top = stage(read_layer(spark, table_name(prefix, "golden", "top_peliculas_genero")), "taken")
    drop_layers(spark, prefix, "ops")
    return top.withColumns({"layers": F.lit(layers).cast("bigint"), "tables": F.lit(n).cast("bigint")})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_roundtrip": csv_roundtrip,
    "csv_permissive": csv_permissive,
    "csv_records": csv_records,
    "csv_rejects": csv_rejects,
    "sink_roundtrip": sink_roundtrip,
    "clean_text": clean_text,
    "parse_digits": parse_digits,
    "parse_iso_date": parse_iso_date,
    "duration_minutes": duration_minutes,
    "first_item": first_item,
    "buckets": buckets,
    "calendar": calendar,
    "prefer_positive": prefer_positive,
    "filters": filters,
    "enrich_left": enrich_left_q,
    "enrich_broadcast": enrich_broadcast,
    "enrich_hot_key": enrich_hot_key,
    "opt_ins": opt_ins,
    "kpi_one_key": kpi_one_key,
    "kpi_two_keys": kpi_two_keys,
    "kpi_min_rows": kpi_min_rows,
    "kpi_mixed": kpi_mixed,
    "dedupe_first": dedupe_first_q,
    "global_dense_rank": global_dense_rank,
    "global_row_number": global_row_number,
    "global_row_number_rows": global_row_number_rows,
    "global_dense_rank_rows": global_dense_rank_rows,
    "top_k_per_group": top_k_per_group,
    "explode_list": explode_list_q,
    "ordered_limit": ordered_limit,
    "quality_metrics": quality_metrics,
    "film_bronze_movies": _bronze_query("movies"),
    "film_bronze_details": _bronze_query("film_details"),
    "film_bronze_info": _bronze_query("more_info"),
    "film_bronze_posters": _bronze_query("poster_path"),
    "film_silver": film_silver,
    "film_genre_rows": film_genre_rows,
    "film_kpi_genre": film_kpi_genre,
    "film_kpi_year": film_kpi_year,
    "film_top_directors": film_top_directors,
    "film_top_films": film_top_films,
    "sink_replace": sink_replace,
    "publish_conflict": publish_conflict,
    "contract_drift": contract_drift,
    "ordered_files": ordered_files,
    "rounding": rounding,
    "overflow_parsing": overflow_parsing,
    "quality_gates": quality_gates,
    "published_metrics": published_metrics,
    "published_golden": published_golden,
    "published_films": published_films,
}

