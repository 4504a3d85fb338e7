"""Operator 12 -- filter interaction audit by decision diagrams.

How do filters that are applied one after another interact? For every part of a
corpus and every order of the filters: what does each step remove, what would it
have removed had an earlier step not done so, and what does that cost.

1. Every document gets a mask of the filters that it fails. Equal texts meet by
   their 128-bit digest: the smallest id of a digest is found with map-side
   combining and joined back on (digest, id), so no group of copies meets in one
   task. Documents are then counted by part and mask, at most 2^k rows a part.
2. Per part, an ordered decision diagram is built over the failure bits. Its
   leaves are the counts of a mask, every node carries the sum of its leaves,
   equal sub-diagrams are one node, and what holds no document is the zero node.
3. All orders of the filters follow from one another by swapping two neighbouring
   levels; a swap rebuilds the nodes of these two levels only. For each order the
   all-pass path is walked from the root: at every level the failing branch holds
   what the step removes, the passing branch what it keeps.

What a filter fails on its own account is its removal where it comes first, and
what it alone fails is its removal where it comes last.

Null texts count as empty, null parts as the empty string. Rows without id are
never copies of another row and are not labelled; rows that share the smallest
id of a text are all first. A document counts as labelled when any label row of
its id says so. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, stage, table

# The characters of two of the filters.
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
FILTERS = "ABCDE"


@dataclass(frozen=True)
class Rules:
    """A: too few words. B: too few distinct words. C: too many capitals. D: a symbol. E: a copy."""

    min_words: int = 200
    min_distinct_pct: int = 50
    max_upper_pct: int = 2


def text_failures(text: str, raw: bytes, rules: Rules) -> int:
    """Bits of A to D that a text fails."""
    words = raw.split()
    n = len(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    return ((n < rules.min_words) + 2 * (100 * len(set(words)) < rules.min_distinct_pct * n)
            + 4 * (100 * upper > rules.max_upper_pct * len(text)) + 8 * (len(raw.translate(None, SYMBOLS)) < len(raw)))


COPY_BIT = 16


def document_failures(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "source") -> DataFrame:
    """``(id, part, mask)``: one row per document with the bits of the filters it fails."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            out = []
            for text in pdf["text"]:
                raw = text.encode("utf-8", "surrogatepass")
                out.append((text_failures(text, raw, rules), hashlib.blake2b(raw, digest_size=16).digest()))
            yield pdf[["id", "part"]].assign(mask=[m for m, _ in out], digest=[d for _, d in out])

    rows = stage(
        docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .mapInPandas(judge, f"id {id_type}, part string, mask int, digest binary"), "audit_flags")
    known = rows.filter("id is not null")
    first = known.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    copy = F.when(F.col("first"), 0).otherwise(COPY_BIT)
    return known.join(first, ["digest", "id"], "left").select("id", "part", (F.col("mask") + copy).alias("mask")).unionByName(
        rows.filter("id is null").select("id", "part", "mask"))


def count_masks(failures: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by part and mask, and those labelled so."""
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = failures.filter("id is not null").join(marks, "id", "left")
    nobody = failures.filter("id is null").select(
        "id", "part", "mask", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)).cast("long")).alias(c)
    return known.select(*nobody.columns).unionByName(nobody).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), total("good"), total("toxic"))


class Diagram:
    """A reduced, ordered diagram over ``k`` failure bits with counts at its leaves.

    ``order[level]`` is the bit tested at that level. A node is ``(pass, fail)``
    and keeps the sum of its leaves in ``weight``; node 0 holds nothing.
    """

    def __init__(self, k: int, counts: dict[int, tuple[int, ...]]):
        self.order = list(range(k))
        self.width = len(next(iter(counts.values()))) if counts else 3
        self.nodes: list[tuple[int, int] | None] = [None]
        self.weight: list[tuple[int, ...]] = [(0,) * self.width]
        self.unique: list[dict] = [{} for _ in range(k + 1)]  # the last: leaves by their counts
        self.root = self._build(0, counts)

    def _build(self, level: int, counts: dict[int, tuple[int, ...]]) -> int:
        counts = {m: w for m, w in counts.items() if any(w)}
        if not counts:
            return 0
        if level == len(self.order):
            (weight,) = counts.values()
            return self._intern(level, weight, None, weight)
        bit = 1 << self.order[level]
        return self._node(level, self._build(level + 1, {m: w for m, w in counts.items() if not m & bit}),
                          self._build(level + 1, {m: w for m, w in counts.items() if m & bit}))

    def _intern(self, level: int, key, node, weight: tuple[int, ...]) -> int:
        found = self.unique[level].get(key)
        if found is None:
            found = self.unique[level][key] = len(self.nodes)
            self.nodes.append(node)
            self.weight.append(weight)
        return found

    def _node(self, level: int, low: int, high: int) -> int:
        if low == high == 0:
            return 0
        weight = tuple(a + b for a, b in zip(self.weight[low], self.weight[high]))
        return self._intern(level, (low, high), (low, high), weight)

    def swap(self, level: int) -> None:
        """Exchange the bits of ``level`` and ``level + 1``; nodes of other levels stay as they are."""
        upper, self.unique[level], self.unique[level + 1] = self.unique[level], {}, {}
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        for (low, high), node in upper.items():
            (pp, pf), (fp, ff) = self.nodes[low] or (0, 0), self.nodes[high] or (0, 0)
            children = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            self.nodes[node] = children
            self.unique[level][children] = node

    def passing_path(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """``(bit, kept, removed)`` of each step of the current order."""
        node = self.root
        for bit in self.order:
            low, high = self.nodes[node] or (0, 0)
            yield bit, self.weight[low], self.weight[high]
            node = low


def neighbour_swaps(k: int) -> Iterator[int]:
    """Levels whose successive swaps run through all orders of ``k`` items (each order once)."""
    items, heading = list(range(k)), [-1] * k
    while True:
        place = {x: i for i, x in enumerate(items)}
        free = [x for x in items if 0 <= place[x] + heading[x] < k and items[place[x] + heading[x]] < x]
        if not free:
            return
        x = max(free)
        i, j = sorted((place[x], place[x] + heading[x]))
        items[i], items[j] = items[j], items[i]
        for y in range(x + 1, k):
            heading[y] = -heading[y]
        yield i


def all_steps(names: str, counts: dict[int, tuple[int, int, int]]) -> list[tuple]:
    """``(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``
    for every order of the filters ``names`` and each of its steps."""
    diagram = Diagram(len(names), counts)
    paths = {tuple(diagram.order): list(diagram.passing_path())}
    for level in neighbour_swaps(len(names)):
        diagram.swap(level)
        paths[tuple(diagram.order)] = list(diagram.passing_path())
    fails, alone, total = ([0] * len(names) for _ in range(3))
    for path in paths.values():
        fails[path[0][0]], alone[path[-1][0]] = path[0][2][0], path[-1][2][0]
        for bit, _, removed in path:
            total[bit] += removed[0]
    return [
        ("".join(names[b] for b in order), step, kept[0], removed[0], fails[bit] - removed[0], alone[bit],
         removed[1], removed[2], total[bit])
        for order, path in paths.items() for step, (bit, kept, removed) in enumerate(path, 1)
    ]


STEP_COLUMNS = ("filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
                "good_lost long, toxic_lost long, shapley long")


def audit(masks: DataFrame, names: str = FILTERS) -> DataFrame:
    """All orders and steps per part, from ``masks(part, mask, n, good, toxic)``, one row per part and mask."""
    columns = ["part", *(c.split()[0] for c in STEP_COLUMNS.split(", "))]

    def per_part(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = {int(m): (int(n), int(g), int(t)) for m, n, g, t in zip(pdf["mask"], pdf["n"], pdf["good"], pdf["toxic"])}
        return pd.DataFrame([(pdf["part"].iloc[0], *row) for row in all_steps(names, counts)], columns=columns)

    return masks.groupBy("part").applyInPandas(per_part, f"part string, {STEP_COLUMNS}")


def op12_filter_diagrams(spark, sf_dir: str) -> DataFrame:
    failures = document_failures(table(spark, sf_dir, "documents"))
    return audit(count_masks(failures, table(spark, sf_dir, "labels")))


OP12_SQL = r"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
f as (select doc_id, part,
    (len(ws) < 200)::int + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::int
    + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t))::int
    + 8 * regexp_matches(t, '[#$%&*|]')::int
    + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask from w),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
m as (select part, mask, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x
      from f left join l using (doc_id) group by 1, 2),
b as (select unnest([0, 1, 2, 3, 4]) as i),
orders as (select [b1.i, b2.i, b3.i, b4.i, b5.i] as o from b b1, b b2, b b3, b b4, b b5
           where len(list_distinct([b1.i, b2.i, b3.i, b4.i, b5.i])) = 5),
steps as (select o, step, o[step] as bit, list_sum(list_transform(o[1:step - 1], lambda y: (2 ** y)::int)) as before
          from orders, (select unnest([1, 2, 3, 4, 5]) as step) s),
r as (select part, o, step, bit,
    coalesce(sum(n) filter (mask & coalesce(before, 0)::int = 0 and (mask >> bit) & 1 = 0), 0) as kept,
    coalesce(sum(n) filter (mask & coalesce(before, 0)::int = 0 and (mask >> bit) & 1 = 1), 0) as removed,
    coalesce(sum(n) filter (mask & coalesce(before, 0)::int <> 0 and (mask >> bit) & 1 = 1), 0) as redundant,
    coalesce(sum(n) filter (mask = (1 << bit)), 0) as unique_fails,
    coalesce(sum(g) filter (mask & coalesce(before, 0)::int = 0 and (mask >> bit) & 1 = 1), 0) as good_lost,
    coalesce(sum(x) filter (mask & coalesce(before, 0)::int = 0 and (mask >> bit) & 1 = 1), 0) as toxic_lost
    from m, steps group by 1, 2, 3, 4)
select part, list_aggregate(list_transform(o, lambda y: substr('ABCDE', y + 1, 1)), 'string_agg', '') as filter_order,
  step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
  (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""
