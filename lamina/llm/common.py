"""What several operators share: table access, staging, word hashes, shingles,
exact Jaccard of hashed sets, and connected components as Spark jobs."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.sources.tables import stage, stage_counted


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- words and shingles (helpers that run inside tasks) -------------------

class WordHashes(dict):
    """64-bit hash of each word, remembered up to ``limit`` distinct words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit of the input reaches every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of one text.

    Fewer than ``k`` words: the whole sequence is the one shingle. No words: empty.
    """
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    width = min(k, n)
    acc = np.full(n - width + 1, np.uint64(width), dtype=np.uint64)
    for j in range(width):
        acc = mix64(acc * _STEP + word_hashes[j : n - width + 1 + j])
    return np.unique(acc)


def jaccard_counts(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == 0:
        return 0, len(b)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int(np.count_nonzero(b[at] == a))
    return both, len(a) + len(b) - both


ASCII_SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def text_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` splits on just these."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


# --- joins with hot keys --------------------------------------------------

def join_on_hot_key(rows: DataFrame, totals: DataFrame, keys: list[str], weight: str, null_safe: bool = False) -> DataFrame:
    """``rows`` joined with one row per key of ``totals``, whose ``weight`` is (at least) its number of rows.

    Keys of more than an eighth of a shuffle partition's share of the rows are
    broadcast: with weights that add up to the rows there are no more than eight
    per partition. What is left has no hot key and is joined by a plain shuffle.
    """
    spark = rows.sparkSession
    total = totals.agg(F.sum(weight)).first()[0] or 0
    heavy = F.col(weight) > F.lit(total / (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    at = totals.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in totals.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) if null_safe else F.col(k) == F.col(f"__{k}") for k in keys]
    hot = F.broadcast(at.filter(heavy))
    names = [f"__{k}" for k in keys]
    rest = rows.join(F.broadcast(at.filter(heavy).select(*names)), same, "left_anti")
    return rows.join(hot, same).drop(*names).unionByName(rest.join(at.filter(~heavy), same).drop(*names))


# --- connected components -------------------------------------------------

# Links that one task contracts at a time.
LOCAL_LINKS = 200_000


def _contracted(edges: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """Star forests ``(u, v)``, v the smaller, of the links that each of ``parts`` tasks holds."""
    kind = edges.schema["u"].dataType.simpleString()

    def forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict = {}

        def root(x):
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = p = parent[p]
                x = p
            return x

        for pdf in frames:
            for a, b in zip(pdf["u"], pdf["v"]):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        stars = [(x, root(x)) for x in parent if root(x) != x]
        if stars:
            yield pd.DataFrame(stars, columns=["u", "v"])

    return stage_counted(edges.repartition(parts).mapInPandas(forest, f"u {kind}, v {kind}"), "cc_edges")


def _star_round(e: DataFrame) -> DataFrame:
    """A large-star and a small-star step: every node is hung below its smallest
    neighbour. Aggregations combine map-side; AQE may split the joins on a hot node."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    large = stage(
        both.join(low, both["u"] == low["k"]).filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "cc_large")
    low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    return (
        large.join(low, large["u"] == low["k"]).filter(F.col("v") > F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
    )


def connected_components(edges: DataFrame, max_rounds: int = 60, local_links: int = LOCAL_LINKS) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component = smallest node.

    Each task contracts the links it holds (``local_links`` on average) to stars;
    alternating large-star and small-star steps then join the stars of all tasks,
    until nothing changes. One task's stars need no such step. Every step is
    written to the shared folder; no link or label reaches the driver.
    """
    links, n = stage_counted(edges.select("u", "v").filter("u <> v"), "cc_edges")  # the stars hold no link twice
    parts = max(1, -(-n // local_links))
    e, _ = _contracted(links, parts)
    for _ in range(max_rounds if parts > 1 else 0):
        new = stage(_star_round(e), "cc_edges")
        if _same_edges(e, new):
            break
        e = new
    else:
        if parts > 1:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _same_edges(a: DataFrame, b: DataFrame) -> bool:
    def sums(df):
        h = F.xxhash64("u", "v")
        return df.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(h, 16)).alias("s"), F.bit_xor(h).alias("x")
        ).first()

    return tuple(sums(a)) == tuple(sums(b))


# Rows of an Arrow batch where rows are whole texts or sets of them.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Python tasks of this session get at most ``BATCH_ROWS`` rows at a time from now on.

    Spark's default of 10,000 texts, or pairs of sets, is held by the executor's
    JVM and its Python worker at once, and neither gives that memory back. A
    smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(key))
    if rows <= 0 or rows > BATCH_ROWS:  # 0 or less: no limit
        spark.conf.set(key, str(BATCH_ROWS))


def worker_state(key: tuple, make: Callable):
    """What ``make()`` gave in this Python worker for ``key``, kept between its tasks.

    For caches of bounded size; a new worker simply starts its own. The newest
    key replaces all others, so that one state is held at a time.
    """
    held = sys.__dict__.setdefault("_lamina_worker_state", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def batches(rows: Iterator) -> Iterator:
    """Arrow record batches as pandas frames, skipping empty ones."""
    for pdf in rows:
        if len(pdf):
            yield pdf
