"""Data-quality metrics, and gates over them.

``metrics`` returns one row of counts (partial aggregation on every task);
``check`` collects that one row and raises if a rule fails. Nothing but the
metrics row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataQualityError(ValueError):
    """Raised by ``check`` with every failed rule listed."""


# A distinct count uses bitmaps when they take no more than eight bytes a row.
BITMAP_BITS, MOST_BITS_PER_ROW = 15, 64


def _dense_lows(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    """Smallest value of each whole-number column whose values lie close together."""
    whole = [c for c in columns if isinstance(df.schema[c].dataType, T.IntegralType)]
    if not whole:
        return {}
    seen = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(whole) for n, f in
                    (("low", F.min), ("high", F.max), ("rows", F.count))]).first()
    return {c: seen[f"low_{i}"] for i, c in enumerate(whole)
            if seen[f"rows_{i}"] and seen[f"high_{i}"] - seen[f"low_{i}"] <= MOST_BITS_PER_ROW * seen[f"rows_{i}"]}


def metrics(
    df: DataFrame,
    key: str | None = None,
    conditions: Mapping[str, Column] | None = None,
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """One-row metrics DataFrame.

    * ``rows``: count(*).
    * with ``key``: ``null_keys`` (count of NULL keys), ``distinct_keys`` and
      ``duplicate_keys`` = non-NULL keys minus distinct keys.
    * ``conditions``: ``name -> predicate``; each becomes ``count_if(predicate)``
      (a NULL predicate is not counted).
    * ``distinct``: ``name -> column``; each becomes its number of non-NULL values.

    Distinct counts of whole numbers that lie close together (looked up first, in
    one pass over these columns) are exact bitmaps of 32,768 bits, combined
    map-side: all of them and all other metrics come from one scan, and only
    bitmaps are shuffled. Any other distinct count is a two-phase distinct of
    its own, joined on one row: several in one aggregate would multiply the
    rows before the shuffle.
    """
    distinct = dict(distinct or {})
    aggs = [F.count(F.lit(1)).alias("rows")]
    if key is not None:
        aggs += [F.count_if(F.col(key).isNull()).alias("null_keys"), F.count(key).alias("__keys")]
        distinct = {"distinct_keys": key, **distinct}
    aggs += [F.count_if(pred).alias(name) for name, pred in (conditions or {}).items()]
    lows = _dense_lows(df, list(dict.fromkeys(distinct.values())))
    dense = {name: c for name, c in distinct.items() if c in lows}
    out = _with_bitmaps(df, key, dict(conditions or {}), dense, lows) if dense else df.agg(*aggs)
    for name, column in distinct.items():
        if name not in dense:
            values = df.filter(F.col(column).isNotNull()).select(column).distinct()
            out = out.crossJoin(values.agg(F.count(F.lit(1)).alias(name)))  # one row each
    if key is None:
        return out.select("rows", *(conditions or {}), *distinct)
    order = ["rows", "null_keys", "distinct_keys", "duplicate_keys", *(conditions or {}), *list(distinct)[1:]]
    return out.withColumn("duplicate_keys", F.col("__keys") - F.col("distinct_keys")).select(*order)


def _with_bitmaps(df: DataFrame, key: str | None, conditions: dict[str, Column], dense: dict[str, str],
                  lows: dict[str, int]) -> DataFrame:
    """Rows, null keys, conditions and distinct counts of ``dense`` columns, in one pass.

    A row counts once for itself and once per column, as (bitmap, bit).
    """
    columns = list(dict.fromkeys(dense.values()))
    counted = {"rows": F.lit(True)} | ({"null_keys": F.col(key).isNull(), "__keys": F.col(key).isNotNull()} if key else {}) | conditions
    bits = []
    for i, c in enumerate(columns):
        place = F.col(c).cast("bigint") - F.lit(lows[c]).cast("bigint")
        bits.append(F.struct(F.lit(i).alias("of"), F.shiftright(place, BITMAP_BITS).alias("map"),
                             place.bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("bit")))
    own = F.struct(F.lit(-1).alias("of"), F.lit(0).cast("bigint").alias("map"), F.lit(None).cast("bigint").alias("bit"))
    flags = [F.coalesce(p, F.lit(False)).alias(f"__c{j}") for j, p in enumerate(counted.values())]
    one = df.select(*flags, F.explode(F.array(own, *bits)).alias("b")).filter("b.of < 0 or b.bit is not null")
    maps = one.groupBy("b.of", "b.map").agg(
        *[F.count_if((F.col("b.of") < 0) & F.col(f"__c{j}")).alias(f"__c{j}") for j in range(len(counted))],
        F.bitmap_construct_agg("b.bit").alias("bits"))
    totals = maps.agg(
        *[F.coalesce(F.sum(f"__c{j}"), F.lit(0)).alias(name) for j, name in enumerate(counted)],
        *[F.coalesce(F.sum(F.when(F.col("of") == i, F.bitmap_count("bits"))), F.lit(0)).alias(f"__d{i}") for i in range(len(columns))])
    return totals.select(*counted, *[F.col(f"__d{columns.index(c)}").alias(name) for name, c in dense.items()])


Rule = Callable[[Row], str | None]


def not_empty(r: Row) -> str | None:
    return "no rows" if r["rows"] == 0 else None


def no_null_keys(r: Row) -> str | None:
    return f"{r['null_keys']} rows with a NULL key" if r["null_keys"] else None


def unique_keys(r: Row) -> str | None:
    return f"{r['duplicate_keys']} repeated keys" if r["duplicate_keys"] else None


def check(
    metrics_df: DataFrame | Row | Mapping, rules: Mapping[str, Rule], what: str = "table"
) -> Row:
    """Evaluate ``rules`` on the metrics row; raise ``DataQualityError`` on failure.

    Accepts the metrics DataFrame, a collected Row, or the dict of an
    ``Observation``. Returns the metrics row so callers can publish the counts.
    """
    if isinstance(metrics_df, DataFrame):
        row = metrics_df.first()
    elif isinstance(metrics_df, Mapping):
        row = Row(**metrics_df)
    else:
        row = metrics_df
    failures = [f"{name}: {msg}" for name, rule in rules.items() if (msg := rule(row))]
    if failures:
        raise DataQualityError(f"{what}: " + "; ".join(failures))
    return row


def key_report(tables: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """Per table: rows, NULL keys and repeated (non-NULL) keys -- one job for all.

    Only the key column of each table is read; the result has one row per
    table, so collecting it is bounded.
    """
    parts = [df.select(F.lit(name).alias("source"), F.col(key).alias("k")) for name, df in tables.items()]
    keys = reduce(DataFrame.unionByName, parts)
    return keys.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("k").isNull()).alias("null_keys"),
        (F.count("k") - F.count_distinct("k")).alias("duplicate_keys"),
    )


def check_unique_keys(report: Mapping[str, Row], what: str = "tables") -> None:
    """Raise ``DataQualityError`` if any row of a ``key_report`` repeats keys."""
    bad = [f"{src}: {r['duplicate_keys']} repeated keys" for src, r in report.items() if r["duplicate_keys"]]
    if bad:
        raise DataQualityError(f"{what}: " + "; ".join(sorted(bad)))
