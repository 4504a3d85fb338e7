import itertools
import random

import numpy as np
import pytest
from lamina.llm.common import connected_components, jaccard_counts, shingle_hashes
from lamina.llm.links import linked_components


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "loops"])
@pytest.mark.parametrize("local", [30, 10**6])
def test_components_equal_union_find(spark, shape, local):
    rng = random.Random(shape)
    edges = {
        "chain": [(i, i + 1) for i in range(150)] + [(1000 + i, 999 + i) for i in range(3)],
        "star": [(7, i) for i in range(8, 300)] + [(3, 7)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[shape]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "u long, v long"), local_links=local).collect()}
    want = {n: c for n, c in union_find(edges).items() if any(n in e and e[0] != e[1] for e in edges)}
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shingles_and_jaccard():
    h = np.arange(6, dtype=np.uint64)
    assert len(shingle_hashes(h[:0], 3)) == 0 and len(shingle_hashes(h[:2], 3)) == 1
    assert len(shingle_hashes(h, 3)) == 4 and len(shingle_hashes(np.zeros(9, dtype=np.uint64), 3)) == 1
    a, b = np.array([1, 2, 5], dtype=np.uint64), np.array([2, 5, 9, 11], dtype=np.uint64)
    assert jaccard_counts(a, b) == (2, 5) and jaccard_counts(b, a[:0]) == (0, 4)


def test_linked_components_lose_no_link(spark):
    """Pairs that the first rounds skip, and pairs only a region names, still join components."""
    rng = random.Random(3)
    base = [rng.randrange(1 << 40) for _ in range(100)]
    sets = {}
    for n in range(40):  # two families, members differ in a few items
        family = base if n < 20 else [x + 1 for x in base]
        sets[n] = np.unique(np.asarray(family[: 100 - n % 7] + [n] * (n % 3), dtype=np.uint64))
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if
              100 * jaccard_counts(sets[a], sets[b])[0] >= 85 * jaccard_counts(sets[a], sets[b])[1]]
    frame = spark.createDataFrame([(n, s.tobytes()) for n, s in sets.items()], "node long, items binary")
    some = [(a, b, 1) for a, b in itertools.combinations(sets, 2) if (a + b) % 5 == 0]
    regions = spark.createDataFrame([(b"r", n) for n in sets], "region binary, node long")
    got = linked_components(spark.createDataFrame(some, "a long, b long, score int"), frame, 85, 100, regions)
    assert {r["node"]: r["component"] for r in got.collect()} == union_find(linked)


def test_regions_of_one_component_each_are_not_compared(spark):
    import numpy as np
    from lamina.llm import links

    sets = spark.createDataFrame([(i, bytearray(np.asarray([i], dtype=np.uint64).tobytes())) for i in range(4)], "node long, items binary")
    regions = spark.createDataFrame([(bytearray(b"r"), 0), (bytearray(b"r"), 1), (bytearray(b"s"), 2)], "region binary, node long")
    labels = spark.createDataFrame([(0, 0), (1, 0)], "node long, component long")
    assert links._links_across(regions, labels, sets, 80, 100) is None
    apart = spark.createDataFrame([(0, 0)], "node long, component long")
    assert links._links_across(regions, apart, sets, 80, 100).count() == 0


def test_regions_are_compared_by_small_plans(spark, monkeypatch):
    """The driver plans all of a plan again at each of its exchanges: no step may hold very many."""
    from lamina.llm import links

    exchanges = []

    def staged(df, name="stage", stage=links.stage):
        exchanges.append((df._jdf.queryExecution().executedPlan().toString().count("Exchange "), name))
        return stage(df, name)

    monkeypatch.setattr(links, "stage", staged)
    held = {n: np.arange(n % 2 * 1000, n % 2 * 1000 + 50 + n % 3, dtype=np.uint64) for n in range(20)}
    sets = spark.createDataFrame([(n, bytearray(s.tobytes())) for n, s in held.items()], "node long, items binary")
    regions = spark.createDataFrame([(bytearray(r), n) for r in (b"r", b"s") for n in held], "region binary, node long")
    got = linked_components(spark.createDataFrame([(0, 2, 1)], "a long, b long, score int"), sets, 80, 100, regions)
    assert {r["node"]: r["component"] for r in got.collect()} == {n: n % 2 for n in held}
    assert "link_region_edges" in [name for _, name in exchanges] and max(exchanges)[0] <= 14, sorted(exchanges)
