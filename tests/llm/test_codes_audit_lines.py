"""Vector codes, the filter audit and the line index: brute force, edges, changes undone."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from lamina.llm import interactions, line_index, vector_codes as vc
from lamina.llm.line_index import CuckooFilter, FilterFull
from lamina.session import scratch_path
from pyspark.sql import functions as F

# --- vector codes ---------------------------------------------------------


def brute_codes(vectors, rules):
    """Codebooks, codes and errors by plain Python, from rows in the order of ids."""
    width = len(vectors[0]) // rules.parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for v in vectors] for p in range(rules.parts)]
    books = [list(c[: rules.entries]) for c in cut]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda part, book: min((dist(part, e), i) for i, e in enumerate(book))
    for _ in range(rules.rounds):
        for p, book in enumerate(books):
            got = [near(x, book)[1] for x in cut[p]]
            for e in range(len(book)):
                mine = [x for x, g in zip(cut[p], got) if g == e]
                if mine:
                    book[e] = tuple(sum(c) // len(mine) for c in zip(*mine))
    found = [[near(x, books[p]) for x in cut[p]] for p in range(rules.parts)]
    return books, [[f[n][1] for f in found] for n in range(len(vectors))], [sum(f[n][0] for f in found) for n in range(len(vectors))]


@pytest.mark.parametrize("scale", [1, 2 ** 30])
def test_codes_equal_brute_force(spark, scale):
    rng = random.Random(scale)
    rules = vc.CodeRules(parts=2, entries=7, rounds=3, scale=8)
    rows = [(i, [rng.choice([-3, -1, 0, 0, 2, 5]) * scale / 8 for _ in range(6)]) for i in range(120)]
    rows += [(500 + i, rows[i % 3][1]) for i in range(40)]  # many copies
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    vectors, dims = vc.whole_vectors(df, rules, "vec_id", "embedding", [])
    books = vc.learn_codebooks(vectors, rules, dims)
    want_books, want_codes, want_errors = brute_codes([[int(np.floor(8 * x)) for x in v] for _, v in sorted(rows)], rules)
    assert dims == 6 and [[tuple(int(x) for x in e) for e in b] for b in books] == want_books
    coded = vc.encode(vectors, books)
    got = {r["id"]: (list(r["codes"]), r["error"]) for r in coded.collect()}
    assert [got[i] for i, _ in sorted(rows)] == [(c, min(e, 2 ** 63 - 1)) for c, e in zip(want_codes, want_errors)]
    one = vc.decode(coded.filter("id = 7"), books).first()
    assert list(one["approx"]) == [x for p, c in enumerate(one["codes"]) for x in want_books[p][c]]
    digest = hashlib.sha256(",".join(str(x) for b in want_books for e in b for x in e).encode()).hexdigest()
    assert vc.codebook_digest(books) == digest


def test_trie_search_equals_all_distances():
    rng = np.random.default_rng(4)
    for n, width, high in ((3000, 4, 3), (1500, 5, 40), (1, 3, 2)):
        parts = np.unique(rng.integers(-high, high, (n, width)), axis=0)
        entries = rng.integers(-high, high, (9, width))
        code, distance = vc.PartTrie(parts, entries).search()
        every = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        assert (code == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    big = np.asarray([[2 ** 62, -(2 ** 62)], [2 ** 62, 5]])
    code, distance = vc.PartTrie(big, np.asarray([[0, 0], [2 ** 62, 4]])).search()
    assert code.tolist() == [1, 1] and [int(d) for d in distance] == [(2 ** 62 + 4) ** 2, 1]


def test_code_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0] * 8, "a"), (1, [0.0] * 8, "a"), (None, [1.0] * 8, None), (2, None, "b"), (3, [nan] + [0.0] * 7, "b"),
            (4, [inf] * 8, "b"), (5, [None] + [0.0] * 7, "b"), (6, [], "c"), (7, [1.0, 2.0], "c"), (8, [-0.5] * 8, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    for name in ("v", "codes", "error", "position", "weight", "dims", "__n"):
        df = df.withColumn(name, F.lit("x"))
    rules = vc.CodeRules(parts=4, entries=2, rounds=1)
    vectors, dims = vc.whole_vectors(df.drop("v"), rules, "vec_id", "embedding", ["label"])
    books = vc.learn_codebooks(vectors, rules, dims)
    out = vc.group_errors(vc.encode(vectors, books), "label").collect()
    assert dims == 8 and len(out) == 4 and {r["id"] for r in out} == {1, None, 8}
    nulls = [r["error"] for r in out if r["label"] is None]
    assert all(r["label_error"] == sum(nulls) for r in out if r["label"] is None)
    empty, dims = vc.whole_vectors(df.filter("false"), rules, "vec_id", "embedding", ["label"])
    assert dims == 0 and empty.count() == 0


# --- filter audit ---------------------------------------------------------

def brute_steps(names, counts):
    out = {}
    for order in itertools.permutations(range(len(names))):
        left = dict(counts)
        for step, bit in enumerate(order, 1):
            gone = {m: c for m, c in left.items() if m >> bit & 1}
            left = {m: c for m, c in left.items() if not m >> bit & 1}
            total = lambda ms, j: sum(c[j] for c in ms.values())
            fails = sum(c[0] for m, c in counts.items() if m >> bit & 1)
            out["".join(names[b] for b in order), step] = (
                total(left, 0), total(gone, 0), fails - total(gone, 0), counts.get(1 << bit, (0,))[0], total(gone, 1), total(gone, 2))
    return out


@pytest.mark.parametrize("k", [1, 3, 5])
def test_steps_equal_brute_force(k):
    rng = random.Random(k)
    names = "ABCDE"[:k]
    for share in (0.0, 0.3, 1.0):
        counts = {m: tuple(rng.randrange(6) for _ in range(3)) for m in range(1 << k) if rng.random() < share}
        rows = interactions.all_steps(names, counts)
        want = brute_steps(names, counts)
        assert {(r[0], r[1]): r[2:8] for r in rows} == want and len(rows) == len(want)
        for r in rows:
            assert r[8] == sum(w[1] for (o, s), w in want.items() if o[s - 1] == r[0][r[1] - 1])


def test_swaps_run_through_all_orders_and_keep_the_counts():
    rng = random.Random(2)
    counts = {m: (rng.randrange(4), 1, 0) for m in range(32)}
    diagram = interactions.Diagram(5, counts)
    seen = {tuple(diagram.order)}
    for level in interactions.neighbour_swaps(5):
        diagram.swap(level)
        seen.add(tuple(diagram.order))
        fresh = interactions.Diagram(5, {sum(1 << i for i, b in enumerate(diagram.order) if m >> b & 1): c for m, c in counts.items()})
        assert [p[1:] for p in diagram.passing_path()] == [p[1:] for p in fresh.passing_path()]
        assert diagram.weight[diagram.root] == tuple(map(sum, zip(*counts.values())))
    assert len(seen) == 120
    shared = interactions.Diagram(4, {m: (1,) for m in range(16)})
    assert len(shared.nodes) == 6  # one node a level, one leaf, and the zero node


def test_masks_of_documents(spark):
    words = " ".join(f"w{i}" for i in range(200))
    rows = [(5, words, "s"), (3, words, None), (None, words, "s"), (3, words, "t"), (4, "a a a", ""), (6, None, "s"), (7, "", "s"),
            (8, "AB c", "s"), (9, "x # y", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("id", "part", "mask", "digest", "first"):
        df = df.withColumn(name, F.lit("z"))
    got = sorted(((r["id"], r["part"], r["mask"]) for r in interactions.document_failures(df).collect()), key=str)
    assert got == sorted([(5, "s", 16), (3, "", 0), (None, "s", 0), (3, "t", 0), (4, "", 3), (6, "s", 1), (7, "s", 17), (8, "s", 5),
                          (9, "s", 9)], key=str)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    masks = {(r["part"], r["mask"]): (r["n"], r["good"], r["toxic"]) for r in interactions.count_masks(
        interactions.document_failures(df), labels).collect()}
    assert masks["s", 16] == (1, 1, 1) and masks["s", 0] == (1, 0, 0) and masks["", 0] == (1, 0, 0)
    audit = interactions.audit(interactions.count_masks(interactions.document_failures(df), labels))
    assert audit.count() == 3 * 600 and audit.select("part", "filter_order", "step").distinct().count() == 1800
    none = interactions.document_failures(df.filter("false"))
    assert interactions.audit(interactions.count_masks(none, labels)).count() == 0


# --- cuckoo filters and the line index ------------------------------------

def test_cuckoo_filter_keeps_every_key_and_forgets_deleted_ones():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(-(2 ** 63), 2 ** 63 - 1, 6000))
    f = CuckooFilter(2048)  # 8192 slots
    f.insert(keys[:3000])
    f.insert(keys[3000:])
    assert f.contains(keys).all()
    others = rng.integers(-(2 ** 63), 2 ** 63 - 1, 20_000)
    assert f.contains(others).mean() < 0.002
    f.delete(keys[::2])
    assert f.contains(keys[1::2]).all() and f.contains(keys[::2]).mean() < 0.01
    again = CuckooFilter(2048, f.to_bytes())
    assert (again.contains(keys) == f.contains(keys)).all()
    f.delete(keys[1::2])
    assert not f.table.any()
    with pytest.raises(KeyError):
        f.delete(keys[:1])
    with pytest.raises(FilterFull):
        CuckooFilter(16).insert(keys[:100])


def brute_lines(rows):
    """Kept text per row, lines and dropped lines, by plain Python."""
    keys = lambda t: [k if len(k) >= 10 else None for k in (
        "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n"))]
    first = {}
    for i, t in rows:
        for k in keys(t):
            if k is not None:
                held = first.get(k, "none")
                first[k] = i if held == "none" or held is None or (i is not None and i < held) else held
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x, k in zip(lines, keys(t)) if k is None or first[k] == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=str)


def random_docs(rng, ids):
    pool = [f"Common line number {i} of all" for i in range(15)] + ["short", "", "  \t", "ÄÖÜ äöü ẞß ßß", "x" * 10, "X" * 10, " " * 12]
    return [(i, None if rng.random() < 0.05 else "\n".join(
        rng.choice(pool) + rng.choice(["", " ", "\r"]) if rng.random() < 0.7 else f"own line {rng.random()}" for _ in range(rng.randrange(8))))
        for i in ids]


def cleaned(index, docs):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in index.clean(docs).collect()), key=str)


def state(index):
    return sorted((r["hi"], r["lo"], r["refs"], r["keeper"] is None, r["keeper"] or 0) for r in index.counts().collect())


def test_inserts_and_deletes_equal_brute_force_and_undo_one_another(spark):
    rng = random.Random(8)
    schema = "doc_id long, text string"
    a, b = random_docs(rng, range(10, 60)), random_docs(rng, [*range(0, 10), *range(60, 80), None, None])
    new = lambda: line_index.new_index(spark, scratch_path(spark, "lines"), shards=2, shard_keys=32)
    docs = lambda rows: spark.createDataFrame(rows, schema)
    one = new().insert(docs(a))
    assert cleaned(one, docs(a)) == brute_lines(a)
    two = one.insert(docs(b))
    assert cleaned(two, docs(a + b)) == brute_lines(a + b)
    assert state(two) == state(new().insert(docs(a + b))) and two.shards > 2  # split when full
    three = two.delete(docs([(i, None) for i in {i for i, _ in b}] + [(12345, None)]))
    assert state(three) == state(one) and cleaned(three, docs(a)) == brute_lines(a)
    some = [r for r in a if r[0] % 3 == 0]
    four = three.delete(docs(some))
    rest = [r for r in a if r[0] % 3]
    assert cleaned(four, docs(rest)) == brute_lines(rest)
    five = four.insert(docs(some))  # back again
    assert state(five) == state(one) and cleaned(five, docs(a)) == brute_lines(a)
    assert cleaned(one, docs(a)) == brute_lines(a)  # earlier versions stay usable
    for index in (one, three, five):
        keys = {(r["hi"], r["lo"]) for r in index.counts().collect()}
        shard = {r["shard"]: CuckooFilter(index.buckets, r["slots"]) for r in index.filters().collect()}
        assert all(shard[hi % index.shards].contains(np.asarray([lo]))[0] for hi, lo in keys)
        assert sum(r["keys"] for r in index.filters().collect()) == len(keys)
    with pytest.raises(ValueError, match="held already"):
        five.insert(docs(a[:1] if "\n" in (a[0][1] or "") else a))


def test_line_index_edges(edge_docs, no_docs, spark):
    index = line_index.new_index(spark, scratch_path(spark, "lines"), shards=2).insert(edge_docs)
    out = index.clean(edge_docs)
    assert out.count() == edge_docs.count() and set(edge_docs.columns) <= set(out.columns)
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.select("doc_id", "text").collect()]
    assert cleaned(index, edge_docs) == brute_lines(rows)
    nothing = line_index.new_index(spark, scratch_path(spark, "lines")).insert(no_docs)
    assert nothing.clean(no_docs).count() == 0 and nothing.counts().count() == 0


def test_a_line_of_every_document(spark):
    """One key that all documents hold, in equal and different texts."""
    rows = [(i, f"the one line that all share\nown line of number {i % 700}") for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    index = line_index.new_index(spark, scratch_path(spark, "lines")).insert(docs)
    out = {r["doc_id"]: r["n_dropped"] for r in index.clean(docs).collect()}
    assert out == {i: (i > 0) + (i >= 700) for i in range(1400)}
