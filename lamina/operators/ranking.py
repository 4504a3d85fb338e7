"""Global ranking without funnelling all rows through one partition.

``Window.orderBy(...)`` with no ``partitionBy`` makes Spark move every row to
a single task. ``global_rank`` computes the same numbers in parallel, by one
path at every size:

1. A hidden tiebreak ends the order, so no two rows are equal and a value held
   by most rows still splits across ranges.
2. The bounds of the ranges are quantiles of a uniform sample of the order keys
   (``SAMPLE`` rows per range, picked by a hash, so any task may sample its part);
   only the key columns are read for it. A binary search over the bounds, one
   row that is broadcast, gives each row its range.
3. Rows are sent to their range and sorted there. In the same stage each gets its
   place and, for tied ranks, the key changes so far; then it is written, once.
4. One summary row per range (rows, distinct keys, its first and last key).
   A running sum over these rows gives each range's offset, broadcast back.

``row_number`` is offset + place. ``rank`` and ``dense_rank`` also look at the
neighbouring summaries for a key that runs on from the range before; nothing is
joined on the sort key itself. An input that a shuffle makes is staged first,
since making it twice would cost more than writing it; other inputs are scanned
twice. The sample decides the balance of the ranges only, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.sources.tables import stage, stage_counted


@dataclass(frozen=True)
class SortKey:
    """One sort key. ``nulls_last`` defaults to Spark's rule (asc: first, desc: last)."""

    name: str
    descending: bool = False
    nulls_last: bool | None = None

    @property
    def nulls_go_last(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last

    def column(self) -> Column:
        c = F.col(self.name)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_go_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_go_last else c.asc_nulls_first()


def asc(name: str, nulls_last: bool | None = None) -> SortKey:
    return SortKey(name, False, nulls_last)


def desc(name: str, nulls_last: bool | None = None) -> SortKey:
    return SortKey(name, True, nulls_last)


METHODS = ("row_number", "rank", "dense_rank")
# Rows a range holds at most on average; more rows make more ranges, up to a bound on their number.
RANGE_ROWS = 2_000_000
MAX_RANGES = 20_000
SAMPLE = 100

_TIE, _BOUNDS, _BOUND = "__lamina_tie", "__lamina_bounds", "__lamina_bound"
_RANGE, _PLACE = "__lamina_range", "__lamina_place"
_NEW, _DENSE, _START = "__lamina_new", "__lamina_dense", "__lamina_start"


def _bounds(x: DataFrame, by: Sequence[SortKey], n: int, rows: int) -> DataFrame:
    """One row whose array holds the first key of every range but the first."""
    share = min(1.0, SAMPLE * n / max(rows, 1))
    spread = 1 << 30
    names = list(dict.fromkeys(k.name for k in by))
    picked = x.select(*names).filter(F.pmod(F.xxhash64(_TIE), F.lit(spread)) < int(share * spread))
    # SAMPLE * n rows, so one task is right
    order = Window.orderBy(*(k.column() for k in by))
    at, size = F.row_number().over(order), F.count(F.lit(1)).over(Window.partitionBy())
    cut = picked.select(F.struct(*names).alias("key"), at.alias("at"), size.alias("size")).filter(
        F.floor(F.col("at") * n / F.col("size")) > F.floor((F.col("at") - 1) * n / F.col("size"))).filter("at < size")
    return cut.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "key"))), lambda b: b["key"]).alias(_BOUNDS))


def _precedes(bound: str, by: Sequence[SortKey]) -> str:
    """SQL: whether the struct ``bound`` comes before the row in the order ``by``."""
    out = "false"
    for k in reversed(by):
        a, b = f"{bound}.`{k.name}`", f"`{k.name}`"
        null = f"{a} is not null and {b} is null" if k.nulls_go_last else f"{a} is null and {b} is not null"
        known = f"{a} {'>' if k.descending else '<'} {b}"
        out = f"(case when {a} is null or {b} is null then {null} else {known} end or ({a} <=> {b} and {out}))"
    return out


def _with_range(x: DataFrame, by: Sequence[SortKey], n: int) -> DataFrame:
    """``x`` with ``_RANGE``, the number of ``_BOUNDS`` before the row: a binary search whose
    steps are plain projections, so that it is compiled like any other."""
    x = x.withColumn(_RANGE, F.lit(0))
    step = 1 << max(n - 1, 1).bit_length() - 1
    while step:
        last = f"{_RANGE} + {step} <= size({_BOUNDS})"
        x = x.withColumn(_BOUND, F.expr(f"get({_BOUNDS}, {_RANGE} + {step - 1})")).withColumn(
            _RANGE, F.expr(f"{_RANGE} + case when {last} and {_precedes(_BOUND, by)} then {step} else 0 end"))
        step //= 2
    return x.drop(_BOUND, _BOUNDS)


def ranged(
    df: DataFrame, order: Sequence[SortKey], ranges: int | None = None, staged_rows: int | None = None, ties: bool = False
) -> tuple[DataFrame, int]:
    """``df`` written once in ``order`` with ``_RANGE`` and ``_PLACE`` (from 0), and the
    number of ranges; with ``ties`` also the key changes so far and where the last was.

    ``staged_rows`` (the row count) saves the count of an input that is a plain scan.
    """
    if staged_rows is None:
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            df, staged_rows = stage_counted(df, "rank_input")
        else:
            staged_rows = df.count()
    x = df.withColumn(_TIE, F.monotonically_increasing_id())
    n = ranges or min(MAX_RANGES, max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-staged_rows // RANGE_ROWS)))
    by = [*order, asc(_TIE)]
    found = x.crossJoin(F.broadcast(_bounds(x, by, n, staged_rows)))  # one row
    sent = _with_range(found, by, n).repartitionById(n, _RANGE)
    row = Window.partitionBy(_RANGE).orderBy(*(k.column() for k in by))
    placed = sent.withColumn(_PLACE, F.row_number().over(row).cast("long") - 1)
    if ties:
        key = F.struct(*dict.fromkeys(k.name for k in order))
        so_far = row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        new = F.when(F.col(_PLACE) == 0, F.lit(True)).otherwise(~F.lag(key).over(row).eqNullSafe(key))
        placed = (
            placed.withColumn(_NEW, new).withColumn(_DENSE, F.sum(F.col(_NEW).cast("long")).over(so_far))
            .withColumn(_START, F.max(F.when(F.col(_NEW), F.col(_PLACE))).over(so_far)).drop(_NEW)
        )
    return stage(placed.drop(_TIE), "rank_ranges"), n


def _earlier():
    """All earlier rows of the range summary (one row per range, so one task is right)."""
    return Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)


def _row_number(x: DataFrame, out: str) -> DataFrame:
    per_range = x.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    offsets = per_range.select(_RANGE, F.coalesce(F.sum("n").over(_earlier()), F.lit(0)).alias("before"))
    return x.join(F.broadcast(offsets), _RANGE).withColumn(out, F.col("before") + F.col(_PLACE) + 1).drop("before")


def _range_summary(x: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per range: rows and distinct keys before it, whether its first key runs on
    from the range before, and where that run began."""
    key = F.struct(*names)
    ends = x.groupBy(_RANGE).agg(
        F.count(F.lit(1)).alias("n"), F.max(_DENSE).alias("keys"), F.max(_START).alias("last_start"),
        F.min_by(key, _PLACE).alias("first_key"), F.max_by(key, _PLACE).alias("last_key"),
    )
    by_range = Window.orderBy(_RANGE)
    s = ends.select(
        _RANGE, "keys", "last_start",
        F.coalesce(F.sum("n").over(_earlier()), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("keys").over(_earlier()), F.lit(0)).alias("keys_before"),
        ((F.lag(F.lit(1)).over(by_range) == 1) & F.lag("last_key").over(by_range).eqNullSafe(F.col("first_key")))
        .alias("runs_on"),
    ).withColumn("runs_on", F.coalesce("runs_on", F.lit(False)))
    own_start = F.when(
        ~(F.col("runs_on") & (F.col("keys") == 1)), F.col("rows_before") + F.col("last_start")
    )
    return s.select(
        _RANGE, "rows_before", "runs_on",
        (F.col("keys_before") - F.sum(F.col("runs_on").cast("long")).over(by_range)).alias("dense_before"),
        F.last(own_start, ignorenulls=True).over(_earlier()).alias("run_start"),
    )


def _tied_rank(x: DataFrame, names: list[str], method: str, out: str) -> DataFrame:
    joined = x.join(F.broadcast(_range_summary(x, names)), _RANGE)
    if method == "dense_rank":
        rank = F.col("dense_before") + F.col(_DENSE)
    else:
        rank = 1 + F.when(
            F.col("runs_on") & (F.col(_DENSE) == 1), F.col("run_start")
        ).otherwise(F.col("rows_before") + F.col(_START))
    return joined.withColumn(out, rank).drop(_DENSE, _START, "rows_before", "runs_on", "dense_before", "run_start")


# Distinct values that one task puts in order, on average.
QUANTILE_VALUES = 200_000


def quantiles(df: DataFrame, value: Column, parts: int) -> list:
    """The distinct values at places ``n * k // parts`` (k from 1 to parts - 1, places from 0) of
    the ``n`` non-null values in order, exactly: at most ``parts - 1``, ascending.

    Every value is counted (map-side first); distinct values are dealt to ranges,
    and running counts within and over the ranges tell which of them hold a place.
    """
    counted, distinct = stage_counted(
        df.select(value.alias("value")).filter("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n")), "quantile_values")
    x, _ = ranged(counted, [asc("value")], max(1, -(-distinct // QUANTILE_VALUES)), distinct)
    per_range = x.groupBy(_RANGE).agg(F.sum("n").alias("of_range"))
    totals = per_range.select(
        _RANGE, F.coalesce(F.sum("of_range").over(_earlier()), F.lit(0)).alias("before"),
        F.sum("of_range").over(Window.partitionBy()).alias("total"))
    so_far = Window.partitionBy(_RANGE).orderBy(_PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = x.withColumn("so_far", F.sum("n").over(so_far)).join(F.broadcast(totals), _RANGE).withColumn(
        "end", F.col("before") + F.col("so_far"))
    places_before = lambda at: f"least({parts - 1}, greatest(0, ({at} * {parts} + total - 1) div total - 1))"
    held = ends.filter(F.expr(f"{places_before('end')} > {places_before('(end - n)')}"))
    return [r["value"] for r in held.orderBy("end").select("value").collect()]


def global_rank(
    df: DataFrame,
    order: Sequence[SortKey],
    method: str = "row_number",
    out: str = "rank",
    ranges: int | None = None,
    staged_rows: int | None = None,
) -> DataFrame:
    """Add ``out`` (BIGINT) = the global ``method`` rank of each row under ``order``.

    Same numbers as ``method().over(Window.orderBy(order))`` without sending
    every row to one task; see the module text. End ``order`` in a unique
    column for row numbers that are stable across runs. ``ranges`` defaults to
    the session's shuffle partitions, more when a range would hold over
    ``RANGE_ROWS`` rows; it decides the balance, never the result.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {sorted(METHODS)}")
    if not order:
        raise ValueError("order needs at least one SortKey")
    x, _ = ranged(df, order, ranges, staged_rows, ties=method != "row_number")
    if method == "row_number":
        ranked = _row_number(x, out)
    else:
        ranked = _tied_rank(x, list(dict.fromkeys(k.name for k in order)), method, out)
    return ranked.select(*[c for c in df.columns if c != _TIE], out)
