"""Operator 7 -- exact top-k inner products by columnar branch and bound.

Vectors are quantised to integers and dealt, by a hash of their row, into
candidate blocks and query blocks of bounded size. A block is stored vertically:
one array per dimension. Every (query block, candidate block) pair is one
bounded piece of work:

1. Products are accumulated dimension block by dimension block, the dimensions
   of most mass first, over all candidates of the block at once.
2. The k best so far are completed, which gives a threshold that k candidates
   are known to reach.
3. A candidate's score can still grow by at most |rest of q| * |rest of x|
   (Cauchy-Schwarz). Candidates that stay below the threshold are dropped and
   the survivors compacted before the next dimension block.

The k best of each pair meet in a top-k per query. All arithmetic is on whole
numbers; bounds are widened by more than their rounding error.

Vectors that are null or hold null or non-finite components take no part. A
query meets every other row of equal dimension, also rows of the same id and rows
without one (which are no queries); scores beyond a long are held to its range,
ties go to the smaller id, then to the earlier row, and last to rows without id.
Other input columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import stage, table

SCALE = 64
TOP = 20
QUERY_EVERY = 20
CANDIDATES = 8_192  # rows of a candidate block, on average
QUERIES = 1_024  # rows of a query block, on average
LIMIT = 2**63 - 1
TOGETHER = 64  # queries searched at a time
DIMS = 16  # dimensions accumulated at a time


def quantise(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null when a component is null or not finite."""
    fine = vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _blocks(rows: DataFrame, per_block: int) -> DataFrame:
    """``(dims, block, blocks, ids, uids, cells)``: vertical blocks of ``rows(uid, id, v)``."""
    sizes = rows.groupBy(F.size("v").alias("dims")).agg(
        F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        cells = np.asarray([np.asarray(v, dtype=np.int64) for v in pdf["v"]], dtype=np.int64).reshape(len(pdf), -1)
        return pd.DataFrame({
            "dims": [int(pdf["dims"].iloc[0])], "block": [int(pdf["block"].iloc[0])], "blocks": [int(pdf["blocks"].iloc[0])],
            "ids": [pdf["id"].to_numpy(dtype="<i8").tobytes()], "uids": [pdf["uid"].to_numpy(dtype="<i8").tobytes()],
            "cells": [zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(cells.T).astype("<i8").tobytes())],
        })

    keyed = rows.withColumn("dims", F.size("v")).join(F.broadcast(sizes), "dims").withColumn(
        "block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    return keyed.groupBy("dims", "block").applyInPandas(
        pack, "dims int, block int, blocks int, ids binary, uids binary, cells binary")


def _cells(packed: bytes, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype="<i8").reshape(dims, n)


class PairSearch:
    """The k best of one candidate block for queries of one query block."""

    def __init__(self, cells: np.ndarray, k: int, dims: int = DIMS):
        mass = (cells.astype(np.float64) ** 2).sum(axis=1)
        self.order = np.argsort(-mass, kind="stable")
        self.k, self.dims = k, dims
        self.largest = float(np.abs(cells).max(initial=0))
        self.whole = cells[self.order]
        self.x = self.whole.astype(np.float64)
        self.rest = self._rest(self.x)

    def _rest(self, x: np.ndarray) -> list[np.ndarray]:
        """Length of what is left after each dimension block."""
        return [np.sqrt((x[at:] ** 2).sum(axis=0)) for at in range(self.dims, x.shape[0], self.dims)]

    def best(self, queries: np.ndarray, own: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (a column of ``queries``): columns that may be among its k best, and
        their exact scores. ``own`` is the column to leave out (-1: none)."""
        whole = queries[self.order]
        if float(np.abs(whole).max(initial=0)) * self.largest * max(1, len(whole)) >= 2.0**53:
            return [self._exact(whole[:, i], o) for i, o in enumerate(own)]
        q = whole.T.astype(np.float64)
        left = self._rest(whole.astype(np.float64))
        columns = np.arange(self.x.shape[1])
        part = np.zeros((len(q), len(columns)))  # minus infinity: dropped
        for i, o in enumerate(own):
            if o >= 0:
                part[i, o] = -np.inf
        floor = np.full(len(q), -np.inf)
        for step, at in enumerate(range(0, q.shape[1], self.dims)):
            end = min(at + self.dims, q.shape[1])
            part += q[:, at:end] @ (self.x[at:end] if len(columns) == self.x.shape[1] else self.x[at:end, columns])
            if end == q.shape[1] or len(columns) <= self.k:
                continue
            # the k leaders are completed: k candidates are known to reach the floor
            lead = np.argpartition(-part, self.k - 1, axis=1)[:, : self.k]
            more = np.einsum("md,dmk->mk", q[:, end:], self.x[end:][:, columns[lead]])
            floor = np.maximum(floor, (np.take_along_axis(part, lead, axis=1) + more).min(axis=1))
            reach = part + np.outer(left[step], self.rest[step][columns]) * (1 + 1e-9) + 1e-3
            part[reach < floor[:, None]] = -np.inf
            alive = (part > -np.inf).any(axis=0)
            if alive.mean() < 0.8:  # compact
                columns, part = columns[alive], part[:, alive]
        out = []
        for row in part:
            at = np.flatnonzero(row > -np.inf)
            out.append((columns[at], row[at].astype(np.int64)))
        return out

    def _exact(self, query: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Beyond exact doubles: Python's whole numbers, held to the range of a long."""
        q = [int(v) for v in query]
        columns = np.asarray([c for c in range(self.whole.shape[1]) if c != own], dtype=np.int64)
        scores = [sum(a * int(b) for a, b in zip(q, self.whole[:, c])) for c in columns]
        return columns, np.asarray([max(-LIMIT - 1, min(LIMIT, v)) for v in scores], dtype=np.int64)


def top_products(vectors: DataFrame, is_query: Column, k: int = TOP, id_col: str = "vec_id",
                 vector_col: str = "embedding", scale: int = SCALE, per_block: int = CANDIDATES,
                 per_query_block: int = QUERIES) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` largest integer inner products of each query row."""
    rows = stage(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantise(F.col(vector_col), scale).alias("v"),
                       is_query.alias("is_query"))
        .withColumn("uid", F.monotonically_increasing_id()).filter("v is not null")
        # a negative number marks a row without id, which sorts as the largest
        .withColumn("uid", F.when(F.col("id").isNull(), -1 - F.col("uid")).otherwise(F.col("uid")))
        .withColumn("id", F.coalesce("id", F.lit(LIMIT))), "topk_rows")
    candidates = stage(_blocks(rows.select("uid", "id", "v"), per_block), "topk_candidates")
    queries = stage(_blocks(rows.filter("is_query and uid >= 0").select("uid", "id", "v"), per_query_block), "topk_queries")
    # one row per pair of blocks on either side; equal keys meet in one task
    turns = lambda t: t.groupBy("dims").agg(F.max("blocks").alias("others"))  # noqa: E731  one row per dimension
    each = lambda t, other, mine, theirs: t.join(F.broadcast(turns(other)), "dims").select(
        "dims", F.col("block").alias(mine), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias(theirs),
        "ids", "uids", "cells")
    left = each(queries, candidates, "qb", "cb").groupBy("dims", "qb", "cb")
    right = each(candidates, queries, "cb", "qb").groupBy("dims", "qb", "cb")

    def search(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(q) and len(c):
            dims = int(q["dims"].iloc[0])
            q_ids, q_uids, c_ids, c_uids = (
                np.frombuffer(f[col].iloc[0], dtype="<i8") for f in (q, c) for col in ("ids", "uids"))
            block = PairSearch(_cells(c["cells"].iloc[0], dims, len(c_ids)), k)
            cells = _cells(q["cells"].iloc[0], dims, len(q_ids))
            at = {u: i for i, u in enumerate(c_uids.tolist())}
            own = [at.get(u, -1) for u in q_uids.tolist()]
            for first in range(0, len(own), TOGETHER):
                some = slice(first, first + TOGETHER)
                for uid, qid, (alive, scores) in zip(q_uids[some], q_ids[some], block.best(cells[:, some], own[some])):
                    if len(scores) > k:
                        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                        alive, scores = alive[keep], scores[keep]
                    # most first; ~ turns the order of whole numbers without overflow
                    for j in np.lexsort((c_uids[alive], c_ids[alive], c_uids[alive] < 0, ~scores))[:k].tolist():
                        out.append((int(uid), int(qid), int(c_ids[alive[j]]), int(c_uids[alive[j]]), int(scores[j])))
        return pd.DataFrame(out, columns=["query_uid", "query_id", "id", "uid", "score"])

    found = left.cogroup(right).applyInPandas(
        search, "query_uid long, query_id long, id long, uid long, score long")
    best = Window.partitionBy("query_uid").orderBy(F.col("score").desc(), F.col("uid") < 0, "id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("uid") >= 0, F.col("id")).alias(id_col), "score")


def op7_branch_and_bound(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_products(vectors, F.col("vec_id") % QUERY_EVERY == 0)


OP7_SQL = f"""
with v as (select row_number() over () as r, vec_id,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as q
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
dims as (select r, vec_id, unnest(q) as x, generate_subscripts(q, 1) as d, len(q) as n from v),
s as (select a.r as qr, a.vec_id as query_id, b.r as r, b.vec_id as vec_id, sum(a.x * b.x)::bigint as score
  from dims a join dims b on a.d = b.d and a.n = b.n and a.r <> b.r
  where a.vec_id % {QUERY_EVERY} = 0 group by all)
select query_id, (row_number() over (partition by qr order by score desc, vec_id nulls last, r))::int as rank, vec_id, score
from s qualify rank <= {TOP}
"""
