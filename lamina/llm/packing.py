"""Operator 5 -- best-fit packing with certified bin counts.

Documents become token sequences (their ids, then one separator id), cut into
pieces of at most ``capacity`` tokens only when longer. Packing works on the
pieces' lengths alone:

1. Full pieces are sequences of their own. The rest are dealt by a hash into
   groups of about ``group_pieces`` pieces, and each group is packed by
   best-fit decreasing in one task.
2. A dual-feasible-function lower bound certifies each group: when it equals
   the number of bins, no packing of that group alone can be better. Such a
   group, if its free space is under one sequence, is settled.
3. The other groups exchange their pieces: these are dealt anew, by another hash
   and into fewer, larger groups, and packed again; a round that would need more
   bins than before is dropped. The exchange ends
   when the bound of all lengths together (from their histogram) is reached, or
   after ``rounds`` rounds. Rounds are written to the shared folder.

Null and empty texts are one piece holding just the separator. Repeated rows
are packed as separate documents. Other input columns are not read. An empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.bpe import Splitter, WordEncoder, default_tokenizer, read_tokenizer
from lamina.llm.common import batches, stage, table, worker_state

CAPACITY = 4096
SEPARATOR = 1
GROUP_PIECES = 20_000
ROUNDS = 4
GROWTH = 4  # by which a group may be larger in each further round; the last bounds what a task holds
# Distinct words whose ids a task remembers.
WORD_MEMORY = 150_000
# Documents that are split at a time.
DOCS = 256


# --- tokens and pieces ----------------------------------------------------

class _WordIds(dict):
    """ids of a word as bytes, remembered up to a number of distinct words."""

    def __init__(self, tokenizer_json: str, limit: int):
        super().__init__()
        self.encoder, self.limit = WordEncoder(tokenizer_json), limit

    def learn(self, words: set[str]) -> None:
        new = words.difference(self)
        if len(self) + len(new) > self.limit:
            self.clear()
            new = words
        known = list(new)
        self.update(zip(known, self.encoder(known)))


def token_pieces(docs: DataFrame, tokenizer_json: str, capacity: int = CAPACITY, separator: int | None = SEPARATOR,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, piece int, start long, length long, ids_crc32 long)`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    id_type = docs.schema[id_col].dataType.simpleString()
    tail = b"" if separator is None else np.asarray([separator], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, ids_of = worker_state(
            ("packing", zlib.crc32(shared.value.encode())),
            lambda: (Splitter(shared.value), _WordIds(shared.value, WORD_MEMORY)))
        step = 4 * capacity
        for pdf in batches(frames):
            for at_row in range(0, len(pdf), DOCS):
                part = pdf.iloc[at_row : at_row + DOCS]
                texts = [split(t) for t in part["text"]]
                ids_of.learn(set().union(*texts))
                rows = []
                for doc, words in zip(part["id"], texts):
                    ids = b"".join([*map(ids_of.__getitem__, words), tail])
                    for n, at in enumerate(range(0, len(ids), step)):
                        piece = ids[at : at + step]
                        rows.append((doc, n, at // 4, len(piece) // 4, zlib.crc32(piece)))
                if rows:
                    yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInPandas(cut, f"id {id_type}, piece int, start long, length long, ids_crc32 long")
        .withColumnRenamed("id", id_col)
    )


# --- bounds and best-fit decreasing (helpers inside a task) ---------------

def dual_feasible_bound(lengths: np.ndarray, capacity: int, counts: np.ndarray | None = None) -> int:
    """A proven lower bound on the bins: the best of two families of dual feasible functions.

    ``counts`` says how often each length occurs (once if not given).

    The threshold family treats items over ``capacity - a`` as whole bins and
    drops items under ``a``; the rounding family scales to k + 1 parts. The
    identity is a member, so the bound is never below the plain volume bound.
    """
    if len(lengths) == 0:
        return 0
    n = np.ones(len(lengths), dtype=np.int64) if counts is None else counts.astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    x, n = lengths[order].astype(np.int64), n[order]
    items = np.concatenate([[0], np.cumsum(n)])
    sums = np.concatenate([[0], np.cumsum(x * n)])
    best = -(-int(sums[-1]) // capacity)
    for a in np.unique(x[x <= capacity // 2]):
        low, high = np.searchsorted(x, a), np.searchsorted(x, capacity - a, side="right")
        best = max(best, int(items[-1] - items[high]) + -(-int(sums[high] - sums[low]) // capacity))
    for k in range(1, 101):
        scaled, exact = np.divmod(x * (k + 1), capacity)
        u = np.where(exact == 0, x * k, scaled * capacity)  # in units of capacity * k
        best = max(best, -(-int((u * n).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item: longest first, each into the fullest bin that it fits."""
    bins_with: list[list[int]] = [[] for _ in range(capacity + 1)]  # by free space
    free = 0  # bit s is set when some bin has s tokens free
    out, made = np.empty(len(lengths), dtype=np.int64), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = free >> size
        if fits:
            space = size + ((fits & -fits).bit_length() - 1)
            b = bins_with[space].pop()
            if not bins_with[space]:
                free &= ~(1 << space)
        else:
            space, b = capacity, made
            made += 1
        out[i] = b
        left = space - size
        if left:
            bins_with[left].append(b)
            free |= 1 << left
    return out


# --- the packing jobs -----------------------------------------------------

def _pack_groups(pieces: DataFrame, groups: int, seed: int, capacity: int) -> DataFrame:
    """``uid, length, bin, open``: best fit within hash groups; ``open`` marks the
    pieces of groups that are not settled."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        lengths = pdf["length"].to_numpy()
        local = best_fit_decreasing(lengths, capacity)
        used = np.bincount(local, weights=lengths)
        gap = len(used) * capacity - lengths.sum() >= capacity or len(used) > dual_feasible_bound(lengths, capacity)
        lead = pd.Series(pdf["uid"].to_numpy()).groupby(local).min().to_numpy()  # a bin is named by a piece
        return pd.DataFrame({"uid": pdf["uid"].to_numpy(), "length": lengths, "bin": lead[local],
                             "open": gap})

    group = F.pmod(F.xxhash64("uid", F.lit(seed)), F.lit(groups))
    return pieces.withColumn("group", group).groupBy("group").applyInPandas(
        pack, "uid long, length long, bin long, open boolean")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES,
         rounds: int = ROUNDS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (which has ``length``, at most ``capacity``)."""
    names = pieces.columns
    held = stage(pieces.select(F.struct(*names).alias("row"), F.col("length").cast("long").alias("length"))
                 .withColumn("uid", F.monotonically_increasing_id()), "pack_pieces")
    sizes = held.select("uid", "length")
    # at most one row per length up to the capacity
    lengths = held.filter(F.col("length") < capacity).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    left = np.asarray([r["n"] for r in lengths], dtype=np.int64)
    bound = dual_feasible_bound(np.asarray([r["length"] for r in lengths], dtype=np.int64), capacity, left)
    bins = sizes.filter(F.col("length") >= capacity).select("uid", "length", F.col("uid").alias("bin"))
    todo, n, best = sizes.filter(F.col("length") < capacity), int(left.sum()), None
    settled = 0
    for turn in range(rounds):
        if n == 0:
            break
        groups = max(1, -(-n // (group_pieces * GROWTH**turn)))
        packed = stage(_pack_groups(todo, groups, turn, capacity), "pack_round")
        made = {r["open"]: r for r in packed.groupBy("open").agg(
            F.count_distinct("bin").alias("bins"), F.count(F.lit(1)).alias("pieces")).collect()}
        total = sum(r["bins"] for r in made.values())
        if best is not None and total > best[1]:
            break  # the bins of the round before stay
        shut = packed.filter(~F.col("open")).drop("open")
        bins, best = bins.unionByName(shut), None
        if True not in made:
            break
        opened = packed.filter("open").drop("open")
        settled += made[False]["bins"] if False in made else 0
        best, n, todo = (opened, made[True]["bins"]), made[True]["pieces"], opened.select("uid", "length")
        if groups == 1 or settled + best[1] <= bound:
            break
    if best is not None:
        bins = bins.unionByName(best[0])
    place = Window.partitionBy("bin").orderBy(F.col("length").desc(), "uid")
    placed = bins.select(
        "uid", F.col("bin").alias("sequence_id"),
        (F.sum("length").over(place.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length"))
        .alias("offset"),
    )
    return held.join(placed, "uid").select("row.*", "sequence_id", "offset")


def op5_best_fit_packing(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    spec = read_tokenizer(tokenizer_path or default_tokenizer())
    return pack(token_pieces(table(spark, sf_dir, "documents"), spec))
