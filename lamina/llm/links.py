"""Confirming candidate pairs on full sets, and joining what is linked.

Shared by the near-duplicate operators. A link between two sets that already
hang together changes no component, so candidates are confirmed in rounds: the
best candidate of every node first, then, round by round, only pairs whose two
sides are still apart. The components equal those of confirming every pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, connected_components, jaccard_counts, stage, stage_counted

BEST_FIRST_ROUNDS = 2


def confirm(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The ``pairs(a, b)`` whose ``sets(node, items)`` have den * intersection >= num * union."""
    a = sets.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    b = sets.select(F.col("node").alias("b"), F.col("items").alias("items_b"))

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            keep = []
            for x, y in zip(pdf["items_a"], pdf["items_b"]):
                both, either = jaccard_counts(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64))
                keep.append(either > 0 and den * both >= num * either)
            yield pdf.loc[keep, ["a", "b"]]

    node = sets.schema["node"].dataType.simpleString()
    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInPandas(check, f"a {node}, b {node}")


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` with both components (a node without links is its own)."""
    x = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    y = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return (
        pairs.join(x, "a", "left").join(y, "b", "left")
        .withColumn("ca", F.coalesce("ca", "a")).withColumn("cb", F.coalesce("cb", "b"))
    )


def linked_components(pairs: DataFrame, sets: DataFrame, num: int, den: int,
                      regions: DataFrame | None = None) -> DataFrame:
    """``(node, component)`` over the links that ``pairs(a, b, score)`` and full sets confirm.

    ``regions(region, node)`` names dense buckets of which ``pairs`` holds only
    some pairs. Where such a bucket still spans several components afterwards,
    these are compared too, so no link is lost there.
    """
    spark = pairs.sparkSession
    node = sets.schema["node"].dataType.simpleString()
    left, n = stage_counted(pairs, "link_pairs")
    edges = spark.createDataFrame([], f"a {node}, b {node}")
    labels = spark.createDataFrame([], f"node {node}, component {node}")
    for turn in range(BEST_FIRST_ROUNDS + 1):
        if n == 0:
            break
        if turn < BEST_FIRST_ROUNDS:
            best = F.max(F.struct("score", "a", "b")).alias("best")
            chosen = (
                left.groupBy(F.col("a").alias("n")).agg(best)
                .unionByName(left.groupBy(F.col("b").alias("n")).agg(best))
                .select("best.a", "best.b").distinct()
            )
            chosen = stage(chosen, "link_chosen")
        else:
            chosen = left.select("a", "b")
        found = stage(edges.unionByName(confirm(chosen, sets, num, den)), "link_edges")
        edges = found
        labels = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        if turn < BEST_FIRST_ROUNDS:  # the last round leaves none
            left, n = stage_counted(
                _labelled(left.join(chosen, ["a", "b"], "left_anti"), labels).filter("ca <> cb").select(*pairs.columns),
                "link_pairs")
    if regions is None:
        return labels
    across = _links_across(regions, labels, sets, num, den)
    more = None if across is None else stage(across, "link_region_edges")
    if more is not None and not more.isEmpty():
        edges = edges.unionByName(more)
        labels = connected_components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return labels


# Nodes, and bytes of their sets, of a block of a dense region, on average.
BLOCK_NODES = 2048
BLOCK_BYTES = 4_000_000


def _sizes(member: DataFrame, key: str) -> DataFrame:
    """Per ``key``: its largest component and how many comparisons its other nodes take."""
    per = member.groupBy(key, "component").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    total = per.groupBy(key).agg(
        F.max(F.struct("n", "component", "bytes")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_NODES, size / BLOCK_BYTES)).cast("int")
    others = F.col("n") - F.col("most.n")
    return total.select(
        key, F.col("most.component").alias("main"), (F.col("n") * others).alias("cost"),
        blocks(F.col("n"), F.col("bytes")).alias("blocks"),
        blocks(others, F.col("bytes") - F.col("most.bytes")).alias("others")).filter("others > 0")


def _block_links(x: list[tuple], y: list[tuple], num: int, den: int) -> list[tuple]:
    """Links that join the components of ``x`` and ``y`` (node, component, set), by exact similarity."""
    size = np.asarray([len(s) for _, _, s in y])
    items, owner = np.concatenate([s for _, _, s in y]), np.repeat(np.arange(len(y)), size)
    order = np.argsort(items, kind="stable")
    items, owner = items[order], owner[order]
    parent: dict = {}

    def root(c):
        while (p := parent.setdefault(c, c)) != c:
            parent[c] = c = parent[p]
        return c

    out = []
    for node, component, mine in x:
        low, high = np.searchsorted(items, mine, "left"), np.searchsorted(items, mine, "right")
        n = high - low
        places = np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)
        both = np.bincount(owner[places], minlength=len(y))
        for j in np.flatnonzero((both > 0) & (den * both >= num * (len(mine) + size - both))):
            other, its, _ = y[j]
            a, b = root(component), root(its)
            if a != b:
                parent[a] = b
                out.append((min(node, other), max(node, other)))
    return out


def _links_across(regions: DataFrame, labels: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """Links ``(a, b)`` between components within dense regions, one at least for every
    two components that any link joins; None where no region holds two components.

    The nodes of a region outside its largest component are compared with all of
    it, block by block; pairs are not written out, only links are. Regions that
    share nodes are taken as one where that is less work. What several steps read
    is staged: one plan over all of them is planned again, whole, at each of its
    exchanges, and that takes the driver's memory.
    """
    weight = sets.select("node", F.length("items").alias("bytes"))
    member = stage(regions.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node")).distinct(),
                   "link_regions")
    mixed = member.groupBy("region").agg(F.count_distinct("component").alias("n")).filter("n > 1").select("region")
    if mixed.isEmpty():
        return None
    member = stage(
        member.join(mixed, "region").join(weight, "node").select(
            "node", "component", "bytes", F.concat(F.lit("n"), F.hex("node")).alias("name"),
            F.concat(F.lit("r"), F.hex("region")).alias("region")), "link_members")
    groups = connected_components(member.select(F.col("name").alias("u"), F.col("region").alias("v")))
    grouped = stage(member.join(groups.select(F.col("node").alias("name"), F.col("component").alias("group")), "name")
                    .drop("name"), "link_groups")
    whole = grouped.select("group", "node", "component", "bytes").distinct()
    apart = stage(_sizes(grouped, "region").join(grouped.select("region", "group").distinct(), "region"), "link_sizes")
    merged = stage(_sizes(whole, "group").join(
        apart.groupBy("group").agg(F.sum("cost").alias("apart")), "group").filter("cost <= apart").drop("apart"), "link_sizes")
    sizes = merged.withColumnRenamed("group", "unit").unionByName(
        apart.join(merged.select("group"), "group", "left_anti").drop("group").withColumnRenamed("region", "unit"))
    nodes = whole.withColumnRenamed("group", "unit").unionByName(
        grouped.select(F.col("region").alias("unit"), "node", "component", "bytes"))
    nodes = stage(nodes.join(sizes, "unit").select(
        "unit", "node", "component", "blocks", "others", (F.col("component") != F.col("main")).alias("outside")), "link_nodes")
    own = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), F.col(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = nodes.filter("outside").select(
        "unit", own("others", 1).alias("lb"), spread("blocks").alias("rb"), F.lit(True).alias("left"), "node", "component")
    right = nodes.select(
        "unit", spread("others").alias("lb"), own("blocks", 2).alias("rb"), F.lit(False).alias("left"), "node", "component")
    kind = sets.schema["node"].dataType.simpleString()

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, sides = None, ([], [])

        def links() -> Iterator[pd.DataFrame]:
            found = _block_links(sides[1], sides[0], num, den) if sides[0] and sides[1] else []
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

        for pdf in batches(frames):
            for u, lb, rb, side, node, component, items in zip(
                    *(pdf[c] for c in ("unit", "lb", "rb", "left", "node", "component", "items"))):
                if (u, lb, rb) != block:
                    yield from links()
                    block, sides = (u, lb, rb), ([], [])
                sides[side].append((node, component, np.frombuffer(items, dtype=np.uint64)))
        yield from links()

    rows = left.unionByName(right).join(sets, "node").repartition("unit", "lb", "rb")
    return rows.sortWithinPartitions("unit", "lb", "rb").mapInPandas(compare, f"a {kind}, b {kind}").distinct()
