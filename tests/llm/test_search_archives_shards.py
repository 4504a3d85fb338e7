import datetime as dt
import gzip
import hashlib
import random

import numpy as np
import pytest
from lamina.llm import sharding, topk, warc
from pyspark.sql import functions as F


# --- exact top-k ----------------------------------------------------------

def brute_top(rows, k, scale=64):
    ok = [(n, i, [int(np.floor(scale * float(x))) for x in v]) for n, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i is not None and i % 20 == 0:
            hits = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, x)))), j is None, j or 0, m)
                          for m, j, x in ok if m != n and len(x) == len(q))[:k]
            out += [(i, r, None if none else j, -s) for r, (s, none, j, _) in enumerate(hits, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("blocks", [(7, 3), (1000, 1000)])
def test_top_products_equal_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # ties
    rows += [(40, rows[5][1]), (40, rows[40][1])]  # an id that repeats
    rows += [(None, rows[1][1]), (300, None), (301, [1.0, None] + [0.0] * 38), (302, [float("nan")] * 40),
             (303, [float("inf")] + [0.0] * 39), (320, [1.0, 2.0]), (340, [3.0, -1.0]), (360, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    got = topk.top_products(df, F.col("vec_id") % 20 == 0, k=20, per_block=blocks[0], per_query_block=blocks[1])
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got.collect()), key=str) == brute_top(rows, 20)


def test_top_products_large_numbers_and_empty(spark):
    rows = [(0, [3e8, 1e8]), (1, [2e8, 7e8]), (2, [2e8, 7e8 + 1 / 64]), (3, [-1e8, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_products(df, F.col("vec_id") % 20 == 0, k=2).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=str) == brute_top(rows, 2)
    assert topk.top_products(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_drop_candidates():
    rng = np.random.default_rng(4)
    cells = rng.integers(-9, 10, (64, 3000))
    cells[:8] *= 20
    search = topk.PairSearch(cells, 5)
    for i, (alive, scores) in zip((7, 8), search.best(cells[:, 7:9], [7, -1])):
        exact = cells[:, i] @ cells
        assert len(alive) < 1500 and all(exact[a] == s for a, s in zip(alive, scores))
        if i == 7:
            assert 7 not in alive
            exact[7] = -10**9
        assert set(np.argsort(-exact, kind="stable")[:5]) <= set(alive.tolist())


# --- WARC -----------------------------------------------------------------

def pages_of(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "1 as uid", "'x' as id", "'y' as digest", "2 as bytes", "'z' as owner") if extra else df


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abc é\r\n😀<") for _ in range(n)) for n in (0, 10, 999, 1000, 5000, 70_000)]
    shared = "copy of a page " * 100
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(texts)]
    rows += [(100 + i, "http://c", shared) for i in range(40)] + [(50, "u", "small"), (51, "u", "small")]
    rows += [(7, None, None), (None, "a b\r\nc", "no id " * 300), (60, "r", "same row " * 200), (60, "r", "same row " * 200),
             (61, "s", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 50)]
    pages = pages_of(spark, rows, extra=True)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, segment_bytes=700, chunk_bytes=300, file_records=25)
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    html = {i: (t or "").encode() for i, _, t in rows}
    for r in got:
        want = html[r["page_id"]]
        assert r["payload_bytes"] == len(want) and r["payload_digest"] == hashlib.sha1(want).hexdigest()
        assert (r["payload"] is None) if r["record_type"] == "revisit" else bytes(r["payload"]) == want
    visits = sorted((r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit")
    assert visits == sorted([(60, 60)] + [(100 + i, 139) for i in range(39)])
    kinds = {r["type"] for r in warc.read_records(spark, path).select("type").distinct().collect()}
    assert kinds == {"response", "continuation", "revisit"}


def test_damaged_archives_are_refused(spark, tmp_path):
    assert warc.unchunked(warc.chunked(b"abc" * 1000, 7)) == b"abc" * 1000
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    for bad in (b"zz\r\nabc\r\n", b"3\r\nab", b"3", b"5\r\nabcdefgh\r\n0\r\n\r\n"):
        with pytest.raises(warc.ArchiveError):
            warc.unchunked(bad)
    assert warc.reassemble([(2, 5, b"de"), (1, None, b"abc")]) == b"abcde"
    for bad in ([(1, None, b"a"), (3, 2, b"b")], [(1, None, b"a"), (2, 9, b"b")], [(1, None, b"a"), (1, None, b"a")]):
        with pytest.raises(warc.ArchiveError):
            warc.reassemble(bad)
    data = warc.record([("WARC-Type", "response")], b"abc") + b"\r\n\r\n"
    assert list(warc.parse_archive(data * 2))[1][1] == b"abc"
    for bad in (data[:-3], data[5:], data + b"x"):
        with pytest.raises(warc.ArchiveError):
            list(warc.parse_archive(bad))
    # a lost continuation makes the read fail rather than give a shorter page
    path = tmp_path / "warc"
    warc.write_archives(pages_of(spark, [(1, "u", "x" * 5000)]).coalesce(1), str(path), segment_bytes=1000)
    name = next(p for p in path.iterdir() if p.name.endswith(".gz"))
    records = gzip.decompress(name.read_bytes()).split(b"\r\n\r\nWARC/1.1")
    name.write_bytes(gzip.compress(b"\r\n\r\nWARC/1.1".join(records[:2] + records[3:])))
    for crc in path.glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="missing or repeated"):
        warc.read_archives(spark, str(path)).collect()


def test_empty_archives(spark, tmp_path):
    warc.write_archives(pages_of(spark, []), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


# --- Hilbert sharding -----------------------------------------------------

@pytest.mark.parametrize("n,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_visits_neighbours(spark, n, bits):
    cells = spark.range((1 << bits) ** n).select(
        *[F.floor(F.col("id") / (1 << bits) ** i).cast("long").bitwiseAND((1 << bits) - 1).alias(f"c{i}") for i in range(n)])
    rows = cells.select("*", sharding.hilbert_index([F.col(f"c{i}") for i in range(n)], bits).alias("h")).collect()
    path = [tuple(r)[:n] for r in sorted(rows, key=lambda r: r["h"])]
    assert sorted(r["h"] for r in rows) == list(range((1 << bits) ** n))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


def test_shards_are_even_gapless_runs(edge_docs, no_docs, make_docs, rng):
    for docs in (edge_docs, make_docs([("t" * rng.randrange(400)) for _ in range(301)]), make_docs(["same"] * 50)):
        out = sharding.hilbert_shards(docs, ["n_chars", "lang", "source"], shards=7, ties=["text", "doc_id"]).collect()
        n = docs.count()
        by = {}
        for r in out:
            by.setdefault(r["shard"], []).append(r)
        sizes = [len(by.get(s, [])) for s in range(7)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
        assert all(sorted(r["slot"] for r in rows) == list(range(len(rows))) for rows in by.values())
        order = [r["hilbert"] for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
        assert order == sorted(order)
    assert sharding.hilbert_shards(no_docs, ["n_chars", "lang"]).count() == 0


def test_written_shards_prune(make_docs, rng, tmp_path, spark):
    docs = make_docs(["t" * (2 ** (i % 14)) for i in range(700)])
    sharding.write_shards(sharding.hilbert_shards(docs, ["n_chars", "source"], shards=14), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    spans = back.groupBy("shard").agg(F.min("n_chars").alias("a"), F.max("n_chars").alias("b")).collect()
    assert back.count() == 700 and sum(r["a"] <= 9000 <= r["b"] for r in spans) <= 4  # a filter on size skips most


def test_cells_follow_quantiles_and_take_any_column(spark):
    rows = [(i, float(i % 100), "t%03d" % (i % 90), dt.date(2020, 1, 1) + dt.timedelta(days=i % 200), i % 2 == 0) for i in range(3000)]
    rows += [(9000, 1e300, None, None, None), (9001, -1e300, "zzz", dt.date(1, 1, 1), True), (9002, float("nan"), "", None, None)]
    df = spark.createDataFrame(rows, "id long, x double, s string, d date, b boolean").withColumn("slot", F.lit("mine"))
    cells = df.select(*[c.alias(f"c{i}") for i, c in enumerate(sharding.quantised(df, ["x", "s", "d"], 4))], "x", "s")
    for name in ("c0", "c1", "c2"):  # outliers leave the grid in use
        sizes = [r["count"] for r in cells.groupBy(name).count().collect()]
        assert len(sizes) >= 14 and max(sizes) < 3 * 3000 / 16
    for cell, value in (("c0", "x"), ("c1", "s")):  # cells are ordered as the values are
        spans = sorted(tuple(r) for r in cells.filter(f"{value} is not null").groupBy(cell).agg(F.min(value), F.max(value)).collect())
        assert all(a[2] < b[1] or b[1] != b[1] for a, b in zip(spans, spans[1:]))
    out = sharding.hilbert_shards(df, ["x", "s", "d", "b"], shards=5)
    assert out.columns.count("slot") == 1 and out.schema["slot"].dataType.typeName() == "long" and out.count() == 3003


def test_cells_are_cut_at_exact_quantiles(spark, rng):
    values = [rng.gauss(0, 1) for _ in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    sizes = df.select(sharding.quantised(df, ["x"], 4)[0].alias("c")).groupBy("c").count().collect()
    assert len(sizes) == 16 and all(abs(r["count"] - 6000 / 16) <= 1 for r in sizes)  # from all rows, not from some
