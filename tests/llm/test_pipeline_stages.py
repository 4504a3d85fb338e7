import random
import re
import uuid

import corpus_pipeline
import pytest
from lamina.llm import lsh_forest, queries
from lamina.llm.common import WordHashes, jaccard_counts, table

from .conftest import prose

BAD = ["idiot", "moron", "worthless", "scum", "pathetic"]


@pytest.fixture(scope="module")
def corpus(spark, make_docs, tmp_path_factory):
    """Clean, toxic, near-equal, passage-sharing and private documents, and odd rows."""
    rng = random.Random(21)
    rows, labels, kinds = [], [], {}
    passage = prose(rng, 80)
    for n in range(240):
        text = prose(rng, rng.randint(60, 120))
        kind = ("toxic" if n % 6 == 0 else "near" if n % 6 == 1 and n > 6 else "passage" if n % 6 == 2 else
                "private" if n % 6 == 3 else "clean")
        if kind == "toxic":
            w = text.split(" ")
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
            text = " ".join(w)
        elif kind == "near":
            w = rows[n - 6][1].split(" ") if n > 7 else text.split(" ")
            w[len(w) // 2] = f"edit{n}"
            text = " ".join(w)
        elif kind == "passage":
            text += "\n" + passage
        elif kind == "private":
            text += f" Mail jane.{n}@example.com or +1 (415) 555-{1000 + n}."
        rows.append((n, text))
        kinds[n] = kind
        labels.append((n, 1, int(kind == "toxic")))
    rows += [(500, None), (501, ""), (502, "short"), (502, "short"), (503, "long " + "x" * 30_000), (None, prose(rng, 60))]
    path = tmp_path_factory.mktemp(f"sf{uuid.uuid4().hex[:6]}")
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), dict(rows), kinds, passage


def test_stages_one_by_one(spark, corpus):
    sf_dir, texts, kinds, passage = corpus
    docs, seen = table(spark, sf_dir, "documents"), {}
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stage(step(spark, docs, sf_dir), f"test_{name}")
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert docs.columns == columns and docs.schema.simpleString() == before.schema.simpleString()
    assert not [n for n in seen["toxicity"] if kinds.get(n) == "toxic"]
    assert {n for n, k in kinds.items() if k != "toxic"} <= set(seen["toxicity"])

    kept, hashes = seen["near_duplicates"], WordHashes()
    sets = {n: lsh_forest.text_set(r["text"], hashes, 5) for n, r in seen["toxicity"].items()}
    links = [(a, b) for a in sets for b in sets if a is not None and b is not None and a < b and len(sets[a])
             and 100 * jaccard_counts(sets[a], sets[b])[0] >= 80 * jaccard_counts(sets[a], sets[b])[1]]
    gone = set(seen["toxicity"]) - set(kept)
    assert gone and gone <= {b for _, b in links} and all(not (a in kept and b in kept) for a, b in links)
    assert {500, 501, 502, 503, None} <= set(kept)

    cut = seen["substring_dedup"]
    assert sum(passage in r["text"] for r in cut.values() if r["text"]) == 1  # the first one stays
    untouched = [n for n in cut if kinds.get(n) in ("clean", "private", "near") or n in (500, 501, 502, 503, None)]
    assert all(cut[n]["text"] == kept[n]["text"] for n in untouched) and set(cut) == set(kept)

    masked = seen["pii"]
    assert set(masked) == set(cut)
    for n, r in masked.items():
        if kinds.get(n) == "private":
            assert "@" not in r["text"] and "(415) 555" not in r["text"] and "[EMAIL]" in r["text"]
            assert r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == cut[n]["text"]
    assert set(seen["packing"]) == set(masked)


def test_run_equals_its_stages(spark, corpus):
    sf_dir, texts, kinds, _ = corpus
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in used.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(used) == -(-sum(r["length"] for r in rows) // 4096)


def test_stages_on_an_empty_table(spark, make_docs, tmp_path):
    docs = make_docs([])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "pii", "packing"]


def test_stages_get_bounded_arrow_batches(spark, make_docs):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def sizes(rows):
        def count(frames):
            for pdf in frames:
                yield pdf.iloc[:1].assign(n=len(pdf))[["n"]]

        return [r["n"] for r in rows.coalesce(1).mapInPandas(count, "n long").collect()]

    docs = make_docs([(n, f"text {n}") for n in range(2500)])
    step = dict(corpus_pipeline.STAGES)["packing"]
    try:
        for given, most in (("10000", 1000), ("0", 1000), ("300", 300)):
            spark.conf.set(key, given)
            assert step(spark, docs, "").count() == 2500
            found = sizes(docs)
            assert max(found) <= most and sum(found) == 2500
    finally:
        spark.conf.set(key, before)
