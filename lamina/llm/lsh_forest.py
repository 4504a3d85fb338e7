"""Operator 3 -- near-duplicate documents by an LSH forest.

1. Signatures: every text becomes its set of hashed word shingles; rows with
   equal sets are one node (combined map-side). A node has ``trees`` signature
   orders of ``depth`` MinHash bytes each.
2. Forest: per tree, nodes are sorted by their signature. Nodes that agree on
   the first ``min_depth`` values form a region. Up to ``small`` nodes: all
   pairs are candidates. In denser regions a node's candidates are its nearest
   neighbours in the order, those with the longest common prefix -- so the
   depth follows the density -- and the region is noted.
3. Candidates whose signatures agree far less than a link requires are dropped
   (five standard deviations), the rest are confirmed on full sets, and links
   are joined to components. Noted regions that still span several components
   are compared across these, all of them, on full sets (see ``links``). So
   every pair that shares a region is compared.

At similarity s a pair meets in a tree with probability s ** min_depth, so with
the defaults and s = 0.85 it meets nowhere once in 5e7 pairs.

Texts without words, and null texts, have an empty set and link with nothing.
Rows with null ids take part; a component's id is the smallest non-null one.
Repeated rows and ids are separate rows of the result. Other input columns are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import WordHashes, batches, mix64, shingle_hashes, stage, table, text_words
from lamina.llm.links import linked_components


@dataclass(frozen=True)
class Forest:
    shingle: int = 5
    num: int = 80  # a link: den * intersection >= num * union
    den: int = 100
    trees: int = 24
    depth: int = 8
    min_depth: int = 4
    small: int = 8  # regions up to this size give all their pairs
    near: int = 2  # neighbours on either side in denser ones
    seed: int = 5


def text_set(text: str | None, hashes: WordHashes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased (A-Z) text's word shingles."""
    return shingle_hashes(hashes.of([w.lower() for w in text_words(text)]), k)


def set_node(items: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(items.tobytes())


def minhash_bytes(items: np.ndarray, mult: np.ndarray, add: np.ndarray, step: int = 4096) -> bytes:
    """One byte of each MinHash value; long sets are folded in steps of bounded memory."""
    low = np.full(len(mult), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), step):
        low = np.minimum(low, (items[at : at + step][None, :] * mult[:, None] + add[:, None]).min(axis=1))
    return mix64(low).astype(np.uint8).tobytes()


def signatures(docs: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, n_shingles, node, sig)`` per row; node and sig are null for an empty set."""
    rng = np.random.default_rng(forest.seed)
    mult = rng.integers(0, 1 << 63, forest.trees * forest.depth, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, forest.trees * forest.depth, dtype=np.uint64)

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches(frames):
            sets = [text_set(t, hashes, forest.shingle) for t in pdf["text"]]
            yield pd.DataFrame({
                "id": pdf["id"], "text_hash": pdf["text_hash"], "n_shingles": [len(s) for s in sets],
                "node": [set_node(s) if len(s) else None for s in sets],
                "sig": [minhash_bytes(s, mult, add) if len(s) else None for s in sets],
            })

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    ).mapInPandas(sign, f"id {id_type}, text_hash long, n_shingles long, node binary, sig binary")


class _Tree:
    """Candidates of rows that arrive sorted by (tree, key, node), in bounded memory."""

    def __init__(self, forest: Forest):
        self.f = forest
        self.held: list[tuple] = []  # rows of the region that the last batch broke off in
        self.dense = False  # that region already gave pairs
        self.key, self.run, self.first = None, 0, []

    def _note(self, region: tuple, node: bytes, out: list[tuple]) -> None:
        """Members of regions that give some of their pairs only."""
        if region != self.key:
            self.key, self.run, self.first = region, 0, []
        self.run += 1
        if self.run <= self.f.small:
            self.first.append(node)
        else:
            name = region[0].to_bytes(2, "big") + region[1]
            out += [(n, None, name) for n in [*self.first, node]]
            self.first = []

    def _pairs(self, rows: list[tuple], fresh: int, out: list[tuple]) -> None:
        whole = len(rows) <= self.f.small and not self.dense
        for i in range(fresh, len(rows)):
            for j in range(0 if whole else max(0, i - self.f.near), i):
                x, y = rows[j][2], rows[i][2]
                out.append((min(x, y), max(x, y), None))

    def add(self, tree: list[int], key: list[bytes], node: list[bytes]) -> list[tuple]:
        d, out = self.f.min_depth, []
        rows = [*self.held, *zip(tree, key, node)]
        old, at = len(self.held), 0
        for t, k, n in rows[old:]:
            self._note((t, k[:d]), n, out)
        while at < len(rows):
            end = at + 1
            while end < len(rows) and rows[end][0] == rows[at][0] and rows[end][1][:d] == rows[at][1][:d]:
                end += 1
            region, fresh = rows[at:end], old if at == 0 and self.dense else 0
            if end == len(rows):  # may go on in the next batch
                if self.dense and at == 0 or len(region) > self.f.small:
                    self.dense = self.dense and at == 0
                    self._pairs(region, fresh, out)
                    self.held, self.dense = region[-self.f.near:], True
                else:
                    self.held, self.dense = region, False
                return out
            if end - at > 1:
                if at:
                    self.dense = False
                self._pairs(region, fresh, out)
            if at == 0:
                self.dense = False
            at = end
        return out

    def close(self) -> list[tuple]:
        out: list[tuple] = []
        if not self.dense:
            self._pairs(self.held, 0, out)
        return out


def _candidate_frame(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=["a", "b", "region"], dtype=object)


def forest_candidates(nodes: DataFrame, forest: Forest) -> DataFrame:
    """``(a, b, region)``: candidate pairs, and the members (a) of dense regions."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = _Tree(forest)
        for pdf in batches(frames):
            yield from _candidate_frame(tree.add(list(pdf["tree"]), list(pdf["key"]), list(pdf["node"])))
        yield from _candidate_frame(tree.close())

    rows = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))).alias("tree")).select(
        "node", "tree", F.expr(f"substring(sig, tree * {forest.depth} + 1, {forest.depth})").alias("key"))
    return (
        rows.repartition("tree", F.expr(f"substring(key, 1, {forest.min_depth})"))
        .sortWithinPartitions("tree", "key", "node").mapInPandas(walk, "a binary, b binary, region binary")
    )


def _likely(pairs: DataFrame, nodes: DataFrame, forest: Forest) -> DataFrame:
    """Pairs with ``score`` = agreeing signature bytes, without those far below a link."""
    n, s = forest.trees * forest.depth, forest.num / forest.den
    least = math.floor(n * (s - 5 * math.sqrt(s * (1 - s) / n)))
    x = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    y = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))

    def agree(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            u = np.frombuffer(b"".join(pdf["sig_a"]), dtype=np.uint8).reshape(len(pdf), n)
            v = np.frombuffer(b"".join(pdf["sig_b"]), dtype=np.uint8).reshape(len(pdf), n)
            score = (u == v).sum(axis=1)
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "score": score})[score >= least]

    return pairs.join(x, "a").join(y, "b").mapInPandas(agree, "a binary, b binary, score int")


def node_sets(docs: DataFrame, wanted: DataFrame, forest: Forest, id_col: str, text_col: str) -> DataFrame:
    """``(node, items)`` of the ``wanted(node, id)`` nodes, from their documents' whole texts."""
    texts = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text")).join(
        wanted, F.col("own").eqNullSafe(F.col("id"))).select("text", "node")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches(frames):
            sets = [text_set(t, hashes, forest.shingle).tobytes() for t in pdf["text"]]
            same = [xxhash.xxh3_128_digest(s) == n for s, n in zip(sets, pdf["node"])]  # an id may repeat
            yield pd.DataFrame({"node": pdf["node"], "items": sets})[same]

    return texts.mapInPandas(build, "node binary, items binary").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id_col, text_hash, n_shingles, component_id, kept)`` for every row of ``docs``."""
    signed = stage(signatures(docs, forest, id_col, text_col), "forest_signatures")
    nodes = stage(
        signed.filter("node is not null").groupBy("node")
        .agg(F.min("id").alias("id"), F.first("sig").alias("sig")), "forest_nodes")
    found = stage(forest_candidates(nodes, forest).distinct(), "forest_candidates")
    pairs = stage(_likely(found.filter("b is not null").select("a", "b"), nodes, forest), "forest_pairs")
    regions = found.filter("b is null").select("region", F.col("a").alias("node"))
    involved = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    involved = involved.unionByName(regions.select("node")).distinct()
    sets = stage(node_sets(docs, nodes.select("node", "id").join(involved, "node"), forest, id_col, text_col),
                 "forest_sets")
    labels = linked_components(pairs, sets, forest.num, forest.den, regions)
    named = labels.join(nodes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("component_id"))
    of_node = nodes.select("node", F.col("id").alias("own")).join(labels, "node", "left").join(named, "component", "left")
    # staged, so that a plan over the result need not hold these joins too
    of_node = stage(of_node.select("node", F.coalesce("component_id", "own").alias("component_id")), "forest_components")
    out = signed.drop("sig").join(of_node, "node", "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_col), "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def keep_one(docs: DataFrame, forest: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of every group of near-duplicates; rows that are
    equal in id and text count as one document."""
    kept = near_duplicates(docs, forest, id_col, text_col).filter("kept").select(
        F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    names = docs.columns
    own = docs.withColumn("__own", F.xxhash64(text_col))
    one = own.dropDuplicates([id_col, "__own"])
    return one.join(kept, one[id_col].eqNullSafe(kept["__id"]) & (one["__own"] == kept["__hash"]), "left_semi").select(*names)


def op3_lsh_forest(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs, Forest(shingle=3, num=85)).drop("text_hash")


OP3_SQL = r"""
with recursive d as (select row_number() over () as r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') as w from documents),
s as (select r, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
      else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end
      as items from d),
classes as (select list_sort(items) as items, min(doc_id) as c, len(any_value(items)) as n from s where len(items) > 0
            group by 1),
inv as (select c, n, unnest(items) as item from classes),
pairs as (select a.c as a, b.c as b from inv a join inv b on a.item = b.item and a.c < b.c
          group by a.c, b.c, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges as (select a, b from pairs union select b, a from pairs),
reach(c, to_c) as (select c, c from classes union select reach.c, edges.b from reach join edges on edges.a = reach.to_c),
comp as (select c, min(to_c) as component_id from reach group by c)
select s.doc_id, len(s.items)::bigint as n_shingles, coalesce(comp.component_id, s.doc_id) as component_id,
       s.doc_id = coalesce(comp.component_id, s.doc_id) as kept
from s left join classes on list_sort(s.items) = classes.items left join comp on comp.c = classes.c
"""
