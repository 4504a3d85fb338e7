"""Operator 10 -- sharding along a Hilbert curve.

Several metadata dimensions (size, language, source, length by default) are
quantised to ``bits`` bits each, and every row gets the index of its cell on
the Hilbert curve through that grid. Rows sorted by curve index are cut into
runs whose row counts differ by at most one (the ``rows`` law), so every shard
covers a compact region of all dimensions and a filter on any of them can skip
most files by their min/max statistics.

Quantising: every dimension is cut at the exact quantiles of all its values (see
``ranking.quantiles``), so that cells hold alike many rows however skewed
the values are, and one extreme value moves no other. Numbers, dates, times and
booleans are ordered as such, everything else as text by its bytes; nulls take
cell 0. Ties on the
curve are ordered by text checksum (equal texts of a cell sit together), then
id, then input row. Null texts have no bytes. Repeated rows are placed one by
one. Columns of the input that are called ``hilbert``, ``shard`` or ``slot`` are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.llm.common import stage, table
from lamina.operators.ranking import asc, global_rank, quantiles

SHARDS = 24
BITS = 6


def hilbert_index(coords: Sequence[Column], bits: int) -> Column:
    """Curve index of the grid cell ``coords`` (``bits`` bits each), by bit transposition.

    Works from the high bit down: where a coordinate's bit is set the lower
    bits of the first coordinate are inverted, else they are exchanged with
    that coordinate's; a Gray-code step and interleaving of the bits follow.
    Held as one array column, so the plan stays small.
    """
    n = len(coords)
    x = F.array(*[c.cast("long") for c in coords])

    def bit(v: Column, q: int) -> Column:
        return v.bitwiseAND(F.lit(q)) != 0

    def put(a: Column, changes: dict[int, Column]) -> Column:
        return F.array(*[changes.get(i, a[i]) for i in range(n)])

    def let(a: Column, body) -> Column:  # evaluate ``a`` once
        return F.transform(F.array(a), lambda v: body(v))[0]

    def turn(i: int, q: int, a: Column) -> Column:
        low = F.lit(q - 1)
        swap = a[0].bitwiseXOR(a[i]).bitwiseAND(low)
        first = F.when(bit(a[i], q), a[0].bitwiseXOR(low)).otherwise(a[0].bitwiseXOR(swap))
        if i == 0:
            return put(a, {0: F.when(bit(a[0], q), a[0].bitwiseXOR(low)).otherwise(a[0])})
        return put(a, {0: first, i: F.when(bit(a[i], q), a[i]).otherwise(a[i].bitwiseXOR(swap))})

    for level in range(bits - 1, 0, -1):
        for i in range(n):
            x = let(x, partial(turn, i, 1 << level))

    def gray(a: Column) -> Column:
        out = [a[0]]
        for i in range(1, n):
            out.append(a[i].bitwiseXOR(out[-1]))
        flip = F.lit(0).cast("long")
        for level in range(bits - 1, 0, -1):
            q = 1 << level
            flip = F.when(bit(out[-1], q), flip.bitwiseXOR(F.lit(q - 1))).otherwise(flip)
        return F.array(*[c.bitwiseXOR(flip) for c in out])

    x = let(x, gray)

    def weave(a: Column) -> Column:
        index = F.lit(0).cast("long")
        for level in range(bits - 1, -1, -1):
            for i in range(n):
                index = F.shiftleft(index, 1).bitwiseOR(F.shiftright(a[i], level).bitwiseAND(F.lit(1)))
        return index

    return let(x, weave)


def _ordered(df: DataFrame, name: str) -> Column:
    """The dimension as a number or as text, in its own order."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    return c.cast("double") if isinstance(kind, T.NumericType) else c.cast("string")


def quantised(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> list[Column]:
    """One cell coordinate per dimension, by its quantiles (at most 2^bits - 1 values each, which
    reach the driver)."""
    out = []
    for d in dims:
        v = _ordered(df, d)
        bounds = quantiles(df, v, 1 << bits)
        cell = reduce(lambda a, b: a + b, [(v > F.lit(b)).cast("int") for b in bounds], F.lit(0))
        out.append(F.coalesce(cell.cast("long"), F.lit(0).cast("long")))
    return out


def hilbert_shards(df: DataFrame, dims: Sequence[str], shards: int = SHARDS, ties: Sequence[str] = (),
                   bits: int = BITS) -> DataFrame:
    """Add ``hilbert long, shard int, slot long`` to ``df``: runs of the curve order.

    Shard s holds the rows ranked from ceil(s * n / shards) on, so counts
    differ by at most one; ``slot`` is the place in the run, gapless from 0.
    """
    df = df.drop("hilbert", "shard", "slot")
    placed = df.withColumn("hilbert", hilbert_index(quantised(df, dims, bits), bits))
    ranked = global_rank(placed, [asc("hilbert"), *map(asc, ties)], "row_number", "__rank")
    rows = ranked.count()
    at = F.col("__rank") - 1
    shard = F.floor(at.cast("decimal(20,0)") * shards / F.lit(max(rows, 1)).cast("decimal(20,0)"))
    first = F.ceil(shard.cast("decimal(20,0)") * F.lit(rows).cast("decimal(20,0)") / shards)
    return (
        ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (at - first).cast("long")).drop("__rank")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in curve order (tight min/max per row group)."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    meta = docs.select(
        "doc_id", "lang", "source", F.col("n_chars").alias("chars"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
    )
    meta = stage(meta, "shard_meta")  # the texts are read once
    sharded = hilbert_shards(meta, ["size", "lang", "source", "chars"], ties=["text_crc32", "doc_id"])
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )
