"""Contract-checked CSV source with audit columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.contracts import INGEST_TS, SOURCE_FILE
from lamina.sources.records import FILE, PLACE, parse_records, read_raw_records
from lamina.sources.tables import ACCEPTED, REJECTED

# Reader options of the raw catalogue files (header row, '"'
# quoting, a doubled quote inside quotes is a literal quote, malformed fields
# become NULL instead of failing the read).
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multiline: bool = False,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Read delimited files with an explicit schema (never inferred).

    Mapping is by position: header names are skipped, not matched. A field
    that does not parse as its declared type is NULL; a missing trailing field
    is NULL; extra fields are ignored; a quoted empty field is NULL.
    ``corrupt_col`` adds a STRING column holding the raw text of malformed
    records, so they can be routed to a reject table instead of hidden.
    Files are split across tasks, so one large file is read in parallel. With
    ``multiline=True``, newlines inside quotes belong to the value; files are
    split all the same (see ``records``), at the price of two scans and a staged
    copy, made when this is called.
    """
    if multiline:
        return parse_records(read_raw_records(spark, path), schema, CSV_OPTIONS, corrupt_col)
    reader = spark.read.format("csv").options(**CSV_OPTIONS)
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).load(path)


# Columns of a row that say where its record came from.
RAW_RECORD, ROUTE = "raw_record", "route"


def read_placed(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = False) -> DataFrame:
    """``read_csv`` rows with ``raw_record`` (the text of a malformed record, else NULL),
    ``file`` and ``place``: the record's first byte with ``multiline``, else the
    first byte of the split that holds it."""
    if multiline:
        return parse_records(read_raw_records(spark, path), schema, CSV_OPTIONS, RAW_RECORD, [F.col(FILE), F.col(PLACE)])
    return read_csv(spark, path, schema, corrupt_col=RAW_RECORD).withColumns(
        {FILE: F.col("_metadata.file_path"), PLACE: F.col("_metadata.file_block_start")})


# What to do with a malformed record: keep its row (fields that do not parse are
# NULL) and store its text beside the table, or only store its text.
MALFORMED = ("keep", "reject")


def routed(rows: DataFrame, malformed: str = "keep") -> DataFrame:
    """``read_placed`` rows with ``route``: accepted, rejected, or (kept) one row for each.

    No row is parsed twice, and ``raw_record`` stays with rejected rows only.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}")
    bad = F.array(F.lit(REJECTED)) if malformed == "reject" else F.array(F.lit(ACCEPTED), F.lit(REJECTED))
    routes = F.when(F.col(RAW_RECORD).isNotNull(), bad).otherwise(F.array(F.lit(ACCEPTED)))
    return rows.withColumn(ROUTE, F.explode(routes)).withColumn(RAW_RECORD, F.when(F.col(ROUTE) == REJECTED, F.col(RAW_RECORD)))


def with_audit(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Add the load time and the source file path of every row.

    ``df`` must come straight from a file scan (``_metadata`` is a property
    of file sources). ``run_ts`` pins one timestamp for the whole run;
    without it the query's ``current_timestamp()`` is used. Rows that bring
    their ``file`` along (``read_placed``) need not be a scan.
    """
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    file = F.col(FILE) if FILE in df.columns else F.col("_metadata.file_path")
    return df.withColumn(INGEST_TS, ts).withColumn(SOURCE_FILE, file)
