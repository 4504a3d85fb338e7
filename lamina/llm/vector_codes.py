"""Operator 11 -- vector code compression with a trie over distinct parts.

Vectors become whole numbers, are cut into equal consecutive parts, and every
part is replaced by the number of the nearest entry of its position's codebook
(product codes, learnt in rounds of assigning and averaging).

1. Equal parts of a position are one row with a weight (combined map-side), so a
   vector that a third of all rows share is one row per position. These rows are
   ordered by range, so that each task holds a run of the lexicographic order.
2. The run is a trie: parts with equal first components share a path. It is gone
   through depth first with the distances to all entries accumulated so far, one
   vector per node; only components after the common prefix are added anew. A
   small subtree is taken level by level, one row of distances per node.
3. A leaf takes the smallest distance (ties: the lower entry) and adds its
   components, times its weight, to the entry's sums. A task gives one sum per
   entry and component; these are added up in Spark, and the next codebook, of
   ``entries`` x dimensions numbers, is all that the driver sees.
4. Rows are encoded where they stand: the distinct parts of an Arrow batch form a
   trie of their own, and no row is joined back.

Arithmetic is on whole numbers throughout, on Python's own where 64 bits could
overflow; errors beyond a long are held to its range.

Vectors that are null or hold null or non-finite components are dropped, and
so are those of other than the commonest length (ties: the longest) or of a
length that ``parts`` does not divide. Rows without id take part but come last in
the order of ids; rows of equal id are ordered by their vector. With fewer than
``entries`` vectors the codebooks are that much smaller. An empty table gives an
empty result. Of other columns only those asked for are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, join_on_hot_key, stage, table
from lamina.llm.topk import quantise

LONG_MAX = 2**63 - 1


@dataclass(frozen=True)
class CodeRules:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024


# --- the trie (inside tasks) ----------------------------------------------

LEAVES = 512  # leaves of a subtree that is taken level by level


def _exact(a: np.ndarray, entries: np.ndarray, times: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Both as 64-bit numbers where squared distances and sums fit, else as Python's."""
    if a.dtype != object and entries.dtype != object:
        most = max(int(np.abs(a.astype(np.float64)).max(initial=0)), int(np.abs(entries.astype(np.float64)).max(initial=0))) + 1
        if a.shape[1] * (2 * most) ** 2 < 2**62 and times * most < 2**62:
            return a, entries
    return a.astype(object), entries.astype(object)


class PartTrie:
    """The trie of distinct parts in lexicographic order, searched against one codebook."""

    def __init__(self, parts: np.ndarray, entries: np.ndarray):
        self.parts, self.entries = _exact(parts, entries)
        n, self.width = parts.shape
        # first component in which a part differs from the one before it
        differs = self.parts[1:] != self.parts[:-1]
        self.branch = np.concatenate([[0], differs.argmax(axis=1)]).astype(np.int64) if n else np.empty(0, dtype=np.int64)
        self.code = np.zeros(n, dtype=np.int64)
        self.distance = np.zeros(n, dtype=self.parts.dtype)

    def search(self) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part."""
        stack = [(0, len(self.parts), 0, np.zeros(len(self.entries), dtype=self.parts.dtype))] if len(self.parts) else []
        while stack:
            low, high, depth, so_far = stack.pop()
            if high - low <= LEAVES:
                self._subtree(low, high, depth, so_far)
                continue
            starts = low + 1 + np.flatnonzero(self.branch[low + 1 : high] <= depth)
            children = list(zip([low, *starts], [*starts, high]))
            stack.extend((a, b, depth + 1, so_far + (self.parts[a, depth] - self.entries[:, depth]) ** 2)
                         for a, b in reversed(children))
        return self.code, self.distance

    def _subtree(self, low: int, high: int, depth: int, so_far: np.ndarray) -> None:
        branch = self.branch[low:high].copy()
        branch[0] = 0
        node = np.zeros(high - low, dtype=np.int64)  # node of each leaf on the level above
        acc = so_far[None, :]
        for level in range(depth, self.width):
            new = branch <= level
            new[0] = True
            at = np.flatnonzero(new)
            acc = acc[node[at]] + (self.parts[low + at, level][:, None] - self.entries[:, level][None, :]) ** 2
            node = np.cumsum(new) - 1
        best = acc.argmin(axis=1)
        self.code[low:high] = best[node]
        self.distance[low:high] = acc[np.arange(len(acc)), best][node]


def _matrix(values) -> np.ndarray:
    return np.asarray([np.asarray(v, dtype=np.int64) for v in values], dtype=np.int64).reshape(len(values), -1)


class _Sums:
    """Weighted sums of the parts of each entry, of one task."""

    def __init__(self):
        self.sums: dict[tuple[int, int], np.ndarray] = {}
        self.weights: dict[tuple[int, int], int] = {}

    def add(self, position: int, parts: np.ndarray, codes: np.ndarray, weights: np.ndarray) -> None:
        parts, _ = _exact(parts, parts[:1], int(weights.sum()))
        order = np.argsort(codes, kind="stable")
        used, starts = np.unique(codes[order], return_index=True)
        sums = np.add.reduceat(parts[order] * weights[order][:, None], starts, axis=0)
        totals = np.add.reduceat(weights[order], starts)
        for entry, total, weight in zip(used.tolist(), sums, totals.tolist()):
            key = (position, entry)
            self.sums[key] = self.sums.get(key, 0) + total.astype(object)
            self.weights[key] = self.weights.get(key, 0) + weight

    def frame(self) -> pd.DataFrame:
        rows = [(p, e, i, Decimal(int(x)), self.weights[p, e]) for (p, e), s in self.sums.items() for i, x in enumerate(s)]
        return pd.DataFrame(rows, columns=["position", "entry", "component", "total", "weight"])


# --- Spark ----------------------------------------------------------------

def whole_vectors(rows: DataFrame, rules: CodeRules, id_col: str, vector_col: str, keep: list[str]) -> tuple[DataFrame, int]:
    """``(id, v, *keep)`` of the vectors that take part, staged, and their length (0: none)."""
    v = stage(rows.select(F.col(id_col).alias("id"), quantise(F.col(vector_col), rules.scale).alias("v"), *keep)
              .filter("v is not null"), "codes_vectors")
    lengths = v.groupBy(F.size("v").alias("dims")).count().filter(F.col("dims") > 0).orderBy(F.desc("count"), F.desc("dims"))
    commonest = lengths.first()
    dims = commonest["dims"] if commonest else 0
    if dims % rules.parts:
        dims = 0
    return v.filter(F.size("v") == F.lit(dims)).filter(F.lit(dims > 0)), dims


def distinct_parts(vectors: DataFrame, rules: CodeRules, dims: int) -> DataFrame:
    """``(position, part, weight)`` staged in lexicographic runs."""
    width = dims // rules.parts
    cut = F.array(*[F.struct(F.lit(i).alias("position"), F.slice("v", i * width + 1, width).alias("part"))
                    for i in range(rules.parts)])
    counted = stage(vectors.select(F.explode(cut).alias("c")).groupBy("c.position", "c.part").agg(
        F.count(F.lit(1)).alias("weight")), "codes_counted")
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stage(counted.repartitionByRange(n, "position", "part").sortWithinPartitions("position", "part"), "codes_parts")


def first_codebooks(vectors: DataFrame, rules: CodeRules, dims: int) -> list[np.ndarray]:
    """Per position the parts of the vectors of smallest id (``entries`` rows on the driver)."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(rules.entries).select("v").collect()
    width = dims // rules.parts
    whole = _matrix([r["v"] for r in rows])
    return [whole[:, i * width : (i + 1) * width] for i in range(rules.parts)]


def _round(parts: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: every entry becomes the floored mean of its parts."""

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = _Sums()
        for pdf in batches(frames):
            for position, run in pdf.groupby("position", sort=False):
                cells = _matrix(run["part"].tolist())
                codes, _ = PartTrie(cells, books[position]).search()
                sums.add(int(position), cells, codes, run["weight"].to_numpy(dtype=np.int64))
        if sums.sums:
            yield sums.frame()

    totals = parts.mapInPandas(assign, "position int, entry int, component int, total decimal(38,0), weight long").groupBy(
        "position", "entry", "component").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    out = [b.astype(object) for b in books]
    for r in totals.collect():  # entries x dimensions rows at most
        out[r["position"]][r["entry"], r["component"]] = int(r["total"]) // int(r["weight"])
    return [b.astype(np.int64) for b in out]  # a mean of longs is a long


def learn_codebooks(vectors: DataFrame, rules: CodeRules, dims: int) -> list[np.ndarray]:
    """The codebooks of all positions after ``rounds`` rounds."""
    books = first_codebooks(vectors, rules, dims)
    parts = distinct_parts(vectors, rules, dims)
    for _ in range(rules.rounds):
        books = _round(parts, books)
    return books


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``vectors`` with ``codes`` (entry numbers, by position) and ``error`` instead of ``v``."""
    own = [c for c in vectors.columns if c != "v"]

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            cells = _matrix(pdf["v"].tolist())
            width = cells.shape[1] // len(books)
            codes, error = [], np.zeros(len(cells), dtype=object)
            for i, entries in enumerate(books):
                distinct, back = np.unique(cells[:, i * width : (i + 1) * width], axis=0, return_inverse=True)
                found, distance = PartTrie(distinct, entries).search()
                back = back.reshape(-1)
                codes.append(found[back])
                error = error + distance[back].astype(object)
            yield pdf[own].assign(codes=list(np.column_stack(codes).astype(np.int32)),
                                  error=[min(int(e), LONG_MAX) for e in error])

    fields = ", ".join(f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in own)
    return vectors.mapInPandas(code, f"{fields}, codes array<int>, error long")


def decode(coded: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """``coded`` with the vector ``approx`` that the ``codes`` stand for."""
    shelf = [F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book]) for book in books]
    return coded.withColumn("approx", F.concat(*[F.get(shelf[i], F.get("codes", F.lit(i))) for i in range(len(books))]))


def codebook_digest(books: list[np.ndarray]) -> str:
    """Hex SHA-256 of all components as decimals: by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def group_errors(coded: DataFrame, by: str) -> DataFrame:
    """``coded`` with ``<by>_error``: the errors of equal ``by`` added up, nulls together."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = coded.groupBy(by).agg(F.count(F.lit(1)).alias("__n"), F.least(total, F.lit(LONG_MAX)).cast("long").alias(f"{by}_error"))
    return join_on_hot_key(coded, stage(totals, "codes_errors"), [by], "__n", null_safe=True).drop("__n")


def op11_trie_codes(spark, sf_dir: str) -> DataFrame:
    rules = CodeRules()
    vectors, dims = whole_vectors(table(spark, sf_dir, "embeddings"), rules, "vec_id", "embedding", ["label"])
    books = learn_codebooks(vectors, rules, dims) if dims else [np.zeros((0, 0), dtype=np.int64)] * rules.parts
    coded = group_errors(stage(encode(vectors, books), "codes_coded"), "label")
    return coded.select(
        F.col("id").alias("vec_id"),
        F.concat(*[F.lpad(F.lower(F.hex(F.get("codes", F.lit(i)).cast("long"))), 2, "0") for i in range(rules.parts)]).alias("code"),
        "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def _sql(rules: CodeRules = CodeRules()) -> str:
    ip = "list_inner_product"
    near = f"{ip}(q.part, q.part) - 2 * {ip}(q.part, c.part) + {ip}(c.part, c.part)"
    out = f"""
with v as materialized (select row_number() over () as r, vec_id, label,
    list_transform(embedding, lambda x: floor(x::double * {rules.scale})) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
q as materialized (select r, vec_id, p, v[p * (len(v) // {rules.parts}) + 1 : (p + 1) * (len(v) // {rules.parts})]::double[] as part, v
  from v, (select unnest(generate_series(0, {rules.parts - 1})) as p) ps),
i as (select unnest(generate_series(1, (select max(len(part)) from q))) as i),
c0 as materialized (select p, row_number() over (partition by p order by vec_id nulls last, v) - 1 as e, part from q
  qualify e < {rules.entries})"""
    for k in range(rules.rounds + 1):
        out += f""",
a{k} as materialized (select q.p, q.r, arg_min(c.e, ({near}) * {rules.entries} + c.e) as e, min({near}) as d
  from q join c{k} c on c.p = q.p group by q.p, q.r)"""
        if k < rules.rounds:
            out += f""",
m{k} as (select p, e, list(x order by i) as part from (
    select a.p, a.e, i, floor(sum(q.part[i]) / count(*)) as x from a{k} a join q on q.p = a.p and q.r = a.r, i
    group by a.p, a.e, i) g group by p, e),
c{k + 1} as materialized (select c.p, c.e, coalesce(m.part, c.part) as part from c{k} c left join m{k} m on m.p = c.p and m.e = c.e)"""
    last = rules.rounds
    return out + f""",
h as (select sha256(string_agg(s, ',' order by p, e)) as codebooks_sha256
      from (select p, e, array_to_string(list_transform(part, lambda x: x::bigint), ',') as s from c{last}) b),
z as (select v.vec_id, v.label, string_agg(lpad(lower(hex(a.e)), 2, '0'), '' order by a.p) as code, sum(a.d)::bigint as error
      from v join a{last} a on a.r = v.r group by v.r, v.vec_id, v.label)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from z, h
"""


OP11_SQL = _sql()
