"""Relational operators: enrichment joins, grouped KPIs, dedupe, top-k, list explode.

All are lazy DataFrame compositions; Catalyst chooses the physical plan.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions.exact import Measure, exact_measures

log = logging.getLogger(__name__)

ColumnOrName = Column | str

# Default upper bound for an explicitly requested broadcast (bytes, estimated).
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``. For file scans it follows the compressed
    file size, so the rows in memory may be several times larger."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only when the estimated size is <= ``limit``.

    Otherwise the plain DataFrame is returned and the join falls back to a
    shuffle join (AQE may still broadcast it once the real size is seen).
    """
    size = estimated_bytes(df)
    if size <= limit:
        return F.broadcast(df)
    log.info("broadcast skipped: estimated %s bytes > limit %s", size, limit)
    return df


def enrich_left(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    dim_key: str | None = None,
    broadcast: bool = False,
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
    spread_hot_keys: bool = False,
) -> DataFrame:
    """Left equi-join ``df`` <- ``dim`` on ``on``.

    ``dim_key`` names the dimension's key column when it differs from ``on``
    (it is renamed; a column of ``dim`` already called ``on`` is dropped).
    ``broadcast=True`` asks for a broadcast hash join, which is granted only
    when the dimension's estimated size is within ``broadcast_limit``.
    ``spread_hot_keys`` first looks for keys that many left rows share (see
    ``hot_keys``) and deals their rows to as many tasks as there are shuffle
    partitions, so that no task gets a whole hot key, without adaptive execution too.
    Every left row is kept; a repeated right key fans the left row out.
    """
    if dim_key and dim_key != on:
        dim = dim.drop(on).withColumnRenamed(dim_key, on)
    if broadcast:
        dim = broadcast_if_small(dim, broadcast_limit)
    if spread_hot_keys:
        return _spread_join(df, dim, on)
    return df.join(dim, on=on, how="left")


def hot_keys(df: DataFrame, key: str, parts: int | None = None) -> list:
    """Keys that hold more than an eighth of a shuffle partition's share of the rows.

    A frequent-items sketch (one pass over the key column, merged from all tasks)
    names every such key and no more than eight per partition; some of them may
    be less frequent, which costs a little and changes nothing.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1 / (8 * parts), 1e-4)
    known = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("k"))
    return [k for k in known.stat.freqItems(["k"], share).first()[0] if k is not None]


def _spread_join(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left join on (key, salt): rows of a hot key, or of none, bear a salt each, and the
    hot keys' dimension rows are there once per salt. All other rows bear salt 0."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, on, parts)
    is_hot = F.col(on).isin(hot) if hot else F.lit(False)
    salt, names = "__lamina_salt", [on, *[c for c in df.columns if c != on], *[c for c in dim.columns if c != on]]
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")
    left = df.withColumn(salt, F.when(F.col(on).isNull() | is_hot, dealt).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.filter(F.col(on).isNotNull()).withColumn(salt, F.explode(salts))
    return left.join(right, [on, salt], "left").select(*names)


# Ranges that a lookup's keys are described by, at most, and cells to find them in.
LOOKUP_RANGES, LOOKUP_CELLS = 64, 4096


def wanted_ranges(rows: DataFrame, key: str, most: int = LOOKUP_RANGES) -> list[tuple]:
    """Up to ``most`` ranges that hold every ``key`` of ``rows``, apart from one another.

    For whole-number keys the widest gaps between them are left out (seen on a
    grid of ``LOOKUP_CELLS`` cells, whose rows are all the driver gets); other
    keys give one range. No key, no range.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None:
        return []
    if not isinstance(rows.schema[key].dataType, T.IntegralType) or high == low:
        return [(low, high)]
    width = (high - low) // LOOKUP_CELLS + 1
    cell = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit(width))
    cells = sorted((r["a"], r["b"]) for r in rows.filter(F.col(key).isNotNull()).groupBy(cell.alias("c")).agg(
        F.min(key).alias("a"), F.max(key).alias("b")).collect())
    gaps = sorted(range(1, len(cells)), key=lambda i: cells[i - 1][1] - cells[i][0])[: most - 1]
    cuts = [0, *sorted(gaps), len(cells)]
    return [(cells[a][0], cells[b - 1][1]) for a, b in zip(cuts, cuts[1:])]


def late_lookup(top: DataFrame, big: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """``top`` (few rows, staged) left-joined with ``columns`` of ``big`` on ``on``.

    The wanted keys' ranges are pushed into the scan of ``big``, so that files and
    row groups whose statistics lie outside of them are not read; then ``big``
    shrinks to the wanted keys before it is joined.
    """
    ranges = wanted_ranges(top, on)
    near = reduce(Column.__or__, [F.col(on).between(a, b) for a, b in ranges], F.lit(False)) if ranges else F.lit(False)
    found = big.filter(near).select(on, *columns).join(top.select(on), on=on, how="left_semi")
    return enrich_left(top, found, on=on)


def kpi(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Column | Measure],
    min_rows: int | None = None,
    count_col: str | None = None,
) -> DataFrame:
    """Group by ``keys`` and compute ``measures``, all aggregated map-side.

    A ``Measure`` (``columns.exact_sum`` and its like) is exact and computed with
    the others of its kind in one pass. A plain aggregate ``Column`` is computed
    by a group-by of its own, joined on the keys where there are both.
    ``min_rows`` keeps only groups with at least that many rows (HAVING); it
    needs ``count_col``, the alias of a row count among ``measures``.
    """
    exact = [m for m in measures if isinstance(m, Measure)]
    plain = [m for m in measures if not isinstance(m, Measure)]
    if not exact:
        out = df.groupBy(*keys).agg(*plain)
    else:
        out = exact_measures(df, list(keys), exact)
    if exact and plain:
        others = df.groupBy(*keys).agg(*plain)
        names = [c for c in others.columns if c not in keys]
        others = others.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *names)
        same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
        out = out.join(others, same).select(*keys, *[m.name for m in exact], *names)
    if min_rows is not None:
        if not count_col:
            raise ValueError("min_rows needs count_col, the alias of a row count among the measures")
        out = out.filter(F.col(count_col) >= min_rows)
    return out


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]) -> DataFrame:
    """Keep the first row of each ``keys`` group by ``order``.

    NULL key parts compare equal (they share a group). The filter on
    ``row_number() == 1`` lets Spark insert a group limit before the shuffle,
    so a hot key sends at most one row per map task.
    """
    helper = "__lamina_rn"
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(helper, F.row_number().over(w)).filter(F.col(helper) == 1).drop(helper)


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    k: int,
    rank_col: str = "ranking",
) -> DataFrame:
    """Rows ranked 1..k within each ``keys`` group (``row_number``, so exactly <= k).

    ``order`` should end in a unique column so ties resolve the same way on
    every run. Spark applies a per-map-task group limit before the shuffle,
    so a hot group ships at most k rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def explode_list(df: DataFrame, col: str, out: str, sep: str = ",") -> DataFrame:
    """One row per element of a delimited text list, trimmed, empties dropped.

    A NULL or empty list yields no row; a repeated element yields two rows.
    """
    item = F.explode(F.split(F.col(col), re.escape(sep)))
    return df.withColumn(out, item).withColumn(out, F.trim(F.col(out))).filter(F.col(out) != "")
