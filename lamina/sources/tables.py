"""Layer tables: conform to a contract, stage, publish, read, create, migrate, preview."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.contracts import LAYERS
from lamina.session import scratch_path, tables_root
from lamina.sources.versions import KEEP_SECONDS, Manifest, VersionLog


class ContractError(ValueError):
    """A DataFrame lacks columns its contract requires."""


class ContractDrift(ContractError):
    """A table's columns cannot become its contract's without losing values."""


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns in order, each cast to its declared type.

    Unlike ``DataFrame.to`` a missing column is an error, not a NULL column.
    """
    have = set(df.columns)
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ContractError(f"missing columns {missing}; have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def table_name(prefix: str, layer: str, table: str) -> str:
    """``<prefix>_<layer>.<table>``: one database per layer in the session catalog."""
    return f"{prefix}_{layer}.{table}"


# What a route column says.
ACCEPTED, REJECTED = "accepted", "rejected"


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- publishing -----------------------------------------------------------

def table_log(spark: SparkSession, name: str) -> VersionLog:
    """The version log of table ``name``, in a folder that driver and executors share."""
    database, table = name.split(".", 1)
    return VersionLog(spark, f"{tables_root(spark)}/versions/{database}/{table}")


def create_database(spark: SparkSession, database: str) -> None:
    """Create a database, unless it exists, whose tables lie in a shared folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{tables_root(spark)}/{database}.db'")


def write_layer(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    gate: Callable[[DataFrame], None] | None = None,
    base: int | None = None,
    order: Sequence[str] = (),
    keep_seconds: float = KEEP_SECONDS,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    route: tuple[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Full refresh: replace the rows of table ``name``, written once. Returns the new rows.

    ``df`` is written to a version folder of its own. ``gate`` then sees the
    written rows and may raise. Only after that is the folder's manifest added to
    the table's log (see ``versions``), in one step: readers see all of the old
    rows or all of the new, a failed write or gate leaves the old, and of several
    writers at once the last to publish stays, whole. ``df`` may therefore read
    ``name`` itself; pass ``base`` (``table_version``) to be refused when
    somebody else has published since. With ``order`` the rows are written in
    files that follow one another in that order (``read_ordered``). ``watch``
    adds what the write is to observe, after the sort: a sort reads its input
    twice, so counts below it would double.

    ``route`` names a column that says ``accepted`` or ``rejected``, and the
    columns that only rejected rows need. One write puts both kinds into folders
    of their own; the table is the accepted rows, ``read_rejects`` gives the others.

    The catalog's table is pointed at the newest version afterwards. Replaced
    versions stay ``keep_seconds``, and as long as a reader holds them.
    """
    spark = df.sparkSession
    log = table_log(spark, name)
    folder = log.new_folder()
    path = f"{log.root}/{folder}"
    rows = df.orderBy(*order) if order else df
    rows = watch(rows) if watch else rows
    writer = rows.write.mode("errorifexists").format(fmt)
    shown, schema, aside = folder, df.schema, {}
    if route:
        column, extra = route
        writer = writer.partitionBy(column)
        shown, rejected = f"{folder}/{column}={ACCEPTED}", f"{folder}/{column}={REJECTED}"
        schema = T.StructType([f for f in df.schema.fields if f.name not in (column, *extra)])
        every = T.StructType([f for f in df.schema.fields if f.name != column])
        aside = {"rejects": rejected, "rejects_schema": json.dumps(every.jsonValue())}
    writer.save(path)
    for part in {shown, *([aside["rejects"]] if aside else [])}:
        log.ensure_folder(part)  # also where no row went there
    written = spark.read.format(fmt).schema(schema).load(f"{log.root}/{shown}")
    if gate is not None:
        gate(written)
    files = sorted(n for n in log._names(shown) if n.startswith("part-")) if order else ()
    log.commit(Manifest(0, shown, fmt, json.dumps(written.schema.jsonValue()), 0.0, tuple(order), tuple(files), **aside), base)
    _point_catalog(spark, name, log)
    log.clean(keep_seconds)
    return written


def _point_catalog(spark: SparkSession, name: str, log: VersionLog) -> None:
    """Make the catalog's table show the newest version, whoever published it."""
    tries = 0
    while True:
        m = log.newest()
        where, ddl = f"{log.root}/{m.folder}", _ddl(m.struct)
        try:
            if spark.catalog.tableExists(name) and _ddl(spark.table(name).schema) == ddl:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{where}'")
                spark.catalog.refreshTable(name)
            else:  # new, or of another shape: the catalog has no replace for that, the log has
                spark.sql(f"DROP TABLE IF EXISTS {name}")
                spark.sql(f"CREATE TABLE {name} ({ddl}) USING {m.fmt} LOCATION '{where}'")
        except AnalysisException:  # another writer changed the table in between
            tries += 1
            if tries > 20:
                raise
            continue
        if log.newest().number == m.number:
            return


def table_version(spark: SparkSession, name: str) -> int:
    """Number of the newest published version; 0 for a table that was never written."""
    numbers = table_log(spark, name).numbers()
    return numbers[-1] if numbers else 0


def read_layer(spark: SparkSession, name: str) -> DataFrame:
    """The newest published rows of a table (an empty one where nothing is published)."""
    log = table_log(spark, name)
    m = log.newest()
    return log.scan(m) if m else spark.table(name)


def read_rejects(spark: SparkSession, name: str) -> DataFrame:
    """The rows that the newest version of a table did not accept (see ``write_layer``)."""
    log = table_log(spark, name)
    m = log.newest()
    if m is None or not m.rejects:
        raise ValueError(f"{name} was written without a reject path")
    return spark.read.format(m.fmt).schema(T.StructType.fromJson(json.loads(m.rejects_schema))).load(f"{log.root}/{m.rejects}")


@contextmanager
def held_layer(spark: SparkSession, name: str, seconds: float = 6 * 3600.0) -> Iterator[DataFrame]:
    """The newest rows, kept from removal until the block ends, however often the table is replaced."""
    log = table_log(spark, name)
    with log.lease(seconds) as m:
        yield log.scan(m)


def read_ordered(spark: SparkSession, name: str) -> DataFrame:
    """Rows of a table published with ``order``, in that order, without a sort.

    One scan per file, in the manifest's order: partitions of a union stay in
    place, and a file's rows stay in place within it. Meant for tables whose
    files number in the hundreds at most, such as results.
    """
    log = table_log(spark, name)
    m = log.newest()
    if m is None or not m.order:
        raise ValueError(f"{name} was not published in an order")
    scans = [spark.read.format(m.fmt).schema(m.struct).load(f"{log.root}/{m.folder}/{f}") for f in m.files]
    return reduce(DataFrame.union, scans) if scans else log.scan(m)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove a table: its catalog entry, versions and log."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(table_log(spark, name).root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_layers(spark: SparkSession, prefix: str, *more: str) -> None:
    """Remove the layer databases of ``prefix`` (and of the ``more`` suffixes) with all their tables."""
    for layer in (*LAYERS, *more):
        database = f"{prefix}_{layer}"
        if spark.catalog.databaseExists(database):
            for table in list_tables(spark, database):
                drop_table(spark, f"{database}.{table}")
            spark.sql(f"DROP DATABASE {database} CASCADE")


# --- contracts of existing tables -----------------------------------------

# Types that hold every value of an earlier one, from narrow to wide.
WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("tinyint", "smallint", "int", "double"))


def holds_all(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` is a value of ``wide``."""
    if wide == narrow:
        return True
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    a, b = narrow.simpleString(), wide.simpleString()
    return any(a in line and b in line and line.index(a) < line.index(b) for line in WIDER)


def drift(have: T.StructType, want: T.StructType) -> tuple[list[str], list[str]]:
    """What changes from ``have`` to ``want`` without loss, and what cannot."""
    old = {f.name: f for f in have.fields}
    new = {f.name: f for f in want.fields}
    fine, broken = [], [f"column {n} is not in the contract" for n in old if n not in new]
    for name, f in new.items():
        if name not in old:
            (fine if f.nullable else broken).append(f"new column {name} {f.dataType.simpleString()}")
        elif f.dataType != old[name].dataType:
            change = f"{name}: {old[name].dataType.simpleString()} to {f.dataType.simpleString()}"
            (fine if holds_all(f.dataType, old[name].dataType) else broken).append(change)
    if not fine and not broken and [*old] != [*new]:
        fine.append("order of columns")
    return fine, broken


def ensure_tables(spark: SparkSession, contracts: Mapping[str, T.StructType], fmt: str = "parquet") -> dict[str, list[str]]:
    """Create the tables that are missing and migrate those of an older contract.

    All tables are compared first: a change that could lose values (a narrower
    type, a column that goes, a new one that may not be NULL) raises
    ``ContractDrift`` before anything is written. Lossless changes (wider types,
    new nullable columns, another order) rewrite the table's rows as its next
    version. Returns the changes made, per table.
    """
    changes, broken = {}, []
    for name, want in contracts.items():
        if table_version(spark, name) or spark.catalog.tableExists(name):
            fine, bad = drift(read_layer(spark, name).schema, want)
            changes[name] = fine
            broken += [f"{name}: {b}" for b in bad]
    if broken:
        raise ContractDrift("; ".join(broken))
    for name, want in contracts.items():
        if name not in changes:
            create_database(spark, name.split(".", 1)[0])
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(want)}) USING {fmt}")
        elif changes[name]:
            base = table_version(spark, name)
            rows = read_layer(spark, name)
            added = {f.name: F.lit(None).cast(f.dataType) for f in want.fields if f.name not in rows.columns}
            write_layer(conform(rows.withColumns(added) if added else rows, want), name, fmt, base=base)
    return changes


def create_layers(spark: SparkSession, prefix: str, fmt: str = "parquet") -> list[str]:
    """Every layer table of ``prefix``, created or migrated to its contract. Returns their names."""
    for layer in LAYERS:
        create_database(spark, f"{prefix}_{layer}")
    contracts = {table_name(prefix, layer, table): schema for layer, tables in LAYERS.items() for table, schema in tables.items()}
    ensure_tables(spark, contracts, fmt)
    return list(contracts)


# --- staging and looking --------------------------------------------------

def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and return a scan of it.

    Cuts the lineage: later actions (metrics, several writes) read the staged
    files instead of recomputing ``df``, and a lost executor re-reads files
    instead of replaying the whole plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_counted(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """``stage`` that also returns the row count, observed during the write
    (no second job)."""
    obs = Observation(f"stage_{uuid.uuid4().hex[:8]}")
    staged = stage(df.observe(obs, F.count(F.lit(1)).alias("rows")), name)
    return staged, int(obs.get["rows"])


def preview(df: DataFrame, n: int = 10, order: Sequence[Column | str] | None = None) -> DataFrame:
    """First ``n`` rows, optionally in ``order`` (a top-n, not a full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))
