import hashlib
import random
import re

import pytest
from lamina.llm import pii
from pyspark.sql import functions as F

from .conftest import prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def card(rng, digits=16):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(digits - 2))
    return next(d + c for c in "0123456789" if luhn(d + c))


TRICKY = [
    "a@b.c.@d.e", "a@b..c x@y.z-.", "a.b_c%d+e-f@g-h.i_j", "x@y", "a@b.c_d@e.f.g", "@a.b", "a@b.c@d.e", "é@b.c ß a@é.b",
    "1.2.3.4.5.6.7.8.9", "001.02.3.255 1.2.3.256", "9" * 30 + ".1.1.1", "1.2.3", "1..2.3.4", "4111 1111-1111 1111",
    "4111  1111 1111 1111", "4111-1111-1111-1111-", "5 ", "12", "+1 (555) 123-4567.", "+1", "++49 30 12.34.56 78", "+1 )( 2",
    "😀 +44 20 7946 0958 and 4111111111111111 at b@c.de", "+123456789012345678", "4" * 19, "1-" * 40 + "1",
]


def test_base_spans_equal_brute_force(make_docs):
    rng = random.Random(3)
    pieces = ["a@b.c", ".", "@", "1.2.3.4", "+1 555 0100 22", card(rng), " ", "-", "x", "9", "(", ")", "é", "\n", "+", "255."]
    texts = TRICKY + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    rows = pii.find_spans(make_docs(texts), pii.Model()).collect()
    for r in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in r["pii_base"]] == brute(r["text"]), r["text"]
        assert r["pii_added"] == []


def test_very_long_runs_do_not_overflow(make_docs):
    texts = ["a" * 200_000, "1" * 200_000, "1 " * 100_000, "a@b" + ".c" * 50_000, "+1" + "(" * 100_000, "1.2.3." * 30_000]
    rows = {r["doc_id"]: r for r in pii.find_spans(make_docs(texts), pii.Model()).collect()}
    assert [len(rows[i]["pii_base"]) for i in range(5)] == [0, 0, 0, 1, 0]
    assert rows[3]["pii_base"][0]["end"] == len(texts[3])


@pytest.fixture(scope="module")
def model(make_docs):
    rng = random.Random(5)
    texts = []
    for n in range(400):
        w = prose(rng, 40).split(" ")
        person = "".join(rng.choice("abcdefgh") for _ in range(6))
        w.insert(9, rng.choice([
            f"{person}.{n}@mail{n % 9}.example.com", ".".join(str(rng.randrange(1, 256)) for _ in range(4)), card(rng),
            card(rng, rng.randint(12, 19)), "0" * 30 + ".1.2.3", f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"]))
        texts.append(" ".join(w))
    return pii.learn(make_docs(texts))


def test_method_adds_disguised_spans(model, make_docs, rng):
    number = card(rng)
    quads = ".".join(number[i : i + 4] for i in range(0, 16, 4))
    cases = {
        "mail me: jane.doe [at] example [dot] com thanks": "jane.doe [at] example [dot] com",
        "the host 10[.]20[.]30[.]40 is up": "10[.]20[.]30[.]40",
        f"my card {quads} is gone": quads,
        "my phone (415) 555-0132 rings": "(415) 555-0132",
    }
    plain = ["version 2.0 of 2021-03-04 and 12/05/1999, pages 10-12", "look at the word and the dot on it", "add 1 2 3 4 5 6 7 8",
             prose(rng, 200)]
    rows = {r["text"]: r for r in pii.find_spans(make_docs([*cases, *plain]), model).collect()}
    for text, span in cases.items():
        got = [text[s["start"]:s["end"]] for s in rows[text]["pii_added"]]
        assert got == [span], (text, got)
    for text in plain:
        assert rows[text]["pii_added"] == [] and rows[text]["pii_base"] == [], (text, rows[text])


def test_added_spans_do_not_overlap(model, make_docs):
    rng = random.Random(6)
    bits = ["415 555 0132", "4111.1111.1111.1111", "10 . 20 . 30 . 40", "a at b dot com", "x (at) y.org", " ", ",", "call 00 44 20 7946 0958"]
    texts = [" ".join(rng.choice(bits) for _ in range(12)) for _ in range(60)]
    for r in pii.find_spans(make_docs(texts), model).collect():
        ends = sorted((s["start"], s["end"]) for s in r["pii_added"])
        assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
        assert not any(a["start"] < b["end"] and b["start"] < a["end"] for a in r["pii_base"] for b in r["pii_added"])


def test_digests_and_redaction(make_docs):
    text = "é a@b.c +1 555 010 2233, 1.2.3.4"
    df = pii.find_spans(make_docs([text, None, ""]), pii.Model())
    row = df.select("doc_id", pii.span_text(F.col("pii_base")).alias("s"), pii.redact(F.col("text"), F.col("pii_base")).alias("r"),
                    F.sha2(pii.span_text(F.col("pii_base")), 256).alias("h")).orderBy("doc_id").collect()
    want = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in brute(text))
    assert row[0]["s"] == want and row[0]["h"] == hashlib.sha256(want.encode()).hexdigest()
    assert row[0]["r"] == "é [EMAIL] [PHONE], [IP]"
    assert row[1]["s"] == row[2]["s"] == "" and row[1]["h"] == hashlib.sha256(b"").hexdigest()


def test_edges_and_native_plan(edge_docs, no_docs, model):
    out = pii.find_spans(edge_docs, model)
    assert out.count() == edge_docs.count()
    assert pii.find_spans(no_docs, model).count() == 0 and pii.learn(no_docs).thresholds is None
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_names_of_its_own_do_not_clash(model, make_docs):
    docs = make_docs(["mail bob@example.com now", None])
    for name in ("base", "added", "pii_base", "pii_added", "t", "pieces", "__pii_t", "kind", "s"):
        docs = docs.selectExpr("*", f"'x' as `{name}`")
    out = pii.find_spans(docs, model)
    assert [c for c in out.columns if not c.startswith("pii_")] == [c for c in docs.columns if not c.startswith("pii_")]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows[0]["base"] == "x" and len(rows[0]["pii_base"]) == 1 and rows[1]["pii_base"] == []


def test_a_long_table_of_numbers_takes_linear_time(spark, make_docs):
    import time

    def seconds(n):
        text = " ".join(f"10.0.{i % 256}.{i // 256 % 256}" for i in range(n))
        df = pii.find_spans(make_docs([text]), pii.Model()).select(
            F.size("pii_base").alias("n"), F.length(pii.redact(F.col("text"), F.col("pii_base"))).alias("l"))
        t = time.time()
        row = df.first()
        assert row["n"] == n and row["l"] == 5 * n - 1
        return time.time() - t

    seconds(1_000)
    small, large = seconds(20_000), seconds(80_000)
    assert large < 10 * max(small, 1.0)


def test_overlaps_are_settled_as_by_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = []
    for n in range(30):
        spans = [(s := rng.randrange(300), rng.randrange(4), s + rng.randint(1, 12), rng.random()) for _ in range(rng.randrange(0, 60))]
        others = sorted((s := rng.randrange(300), 0, s + rng.randint(1, 5), 1.0) for _ in range(rng.randrange(0, 20)))
        rows.append((n, spans, others))
    kind = "array<struct<start:int,kind:int,end:int,score:double>>"
    df = spark.createDataFrame(rows, f"n int, spans {kind}, others {kind}")
    better = lambda a, b: F.when(a["score"] > b["score"], -1).otherwise(1)
    got = {r["n"]: r for r in df.select("n", pii.best_apart(F.col("spans"), better).alias("best"),
                                        pii.clear_of(F.col("spans"), F.col("others")).alias("clear")).collect()}
    for n, spans, others in rows:
        clear = [s for s in spans if not any(s[0] < o[2] and o[0] < s[2] for o in others)]
        best = []
        for s in sorted(spans, key=lambda s: -s[3]):
            if not any(s[0] < b[2] and b[0] < s[2] for b in best):
                best.append(s)
        assert [tuple(s) for s in got[n]["clear"]] == clear and [tuple(s) for s in got[n]["best"]] == sorted(best)


def test_the_trees_learn_from_every_base_span(spark, make_docs):
    docs = make_docs([f"number {i}: write to user{i}@host{i}.example today" for i in range(3500)])
    rows = pii.training_rows(docs, pii.Boosting(), "text")
    seen = {r["y"]: (r["forms"], r["rows"]) for r in rows.groupBy("y").agg(F.sum("n").alias("forms"), F.count("x").alias("rows")).collect()}
    assert seen[1][0] == 10 * 3500 and seen[0][0] == 5 * 3500  # ten right and five spoilt forms of each
    assert seen[1][1] < 3500  # forms of equal features are one row
