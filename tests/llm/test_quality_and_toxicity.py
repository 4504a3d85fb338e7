import random

import pytest
from lamina.llm import toxicity
from lamina.llm.quality import LineCleaner, LineRules, clean_lines, repeated_words
from lamina.llm.toxicity import FuzzyLexicon, Learning, Term

from .conftest import prose


def slow_repeats(words):
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + j for at in seen.values() if len(at) > 1 for i in at for j in range(3)})


def test_repeated_words_equal_brute_force():
    rng = random.Random(1)
    for n in range(40):
        words = [b"%d" % rng.randrange(1 + n % 6) for _ in range(n)]
        assert repeated_words(words) == slow_repeats(words)


def test_line_rules(rng):
    c = LineCleaner(LineRules())
    good = prose(rng, 60)
    cases = {
        "of%%% the*** words### are&&& noisy$$$": True, "Home | News | About | Contact": True,
        "THIS WHOLE LINE IS SHOUTED AT YOU": True, "word " * 12: True, "plain " + " ".join(f"a{i}" for i in range(25)): True,
        "Licensed under the Apache License, Version 2.0.": True, "We use cookies to improve things.": True,
        "A normal line, with a comma.": False, "Heading without mark": False, "NASA and ESA agreed, they said.": False,
    }
    for line, fails in cases.items():
        assert c.line_fails(line, line.encode(), line.encode().split()) is fails, line
    counts, left = c(good + "\n" + "Home | News | About | Contact" + "\n" + good)
    assert left == good and counts[3] == 1 and not counts[6]  # the repeated line is over half of the words
    assert c(good + "\nAll rights reserved by us.")[0][6]


def test_clean_lines_edges(edge_docs, no_docs):
    out = clean_lines(edge_docs)
    rows = out.collect()
    assert len(rows) == edge_docs.count() and set(edge_docs.columns) <= set(out.columns)
    by_id = {r["doc_id"]: r for r in rows}
    for i in (0, 1, 2):
        assert by_id[i]["n_words"] == 0 and by_id[i]["base_failed"] and not by_id[i]["kept"]
    assert by_id[8]["n_words"] == 4  # only ASCII white space divides words
    assert by_id[9]["n_dup_lines"] == 1
    assert clean_lines(no_docs).count() == 0


# --- toxicity -------------------------------------------------------------

def osa(a, b):
    """Edit distance with exchanges of neighbours, by table."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_equals_edit_distance():
    terms = [Term(t, False, 1.0) for t in ("idiot", "moron", "worthless", "scum", "pathetic")] + [Term("veq", True, 2.0)]
    lexicon = FuzzyLexicon(terms)
    rng = random.Random(7)
    for _ in range(3000):
        w = list(rng.choice(terms).text + rng.choice(["", "", "s", "en"]))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w) + 1)
            op = rng.randrange(4)
            if op == 0:
                w.insert(at, rng.choice("idotmrs"))
            elif op == 1 and w:
                w.pop(at % len(w))
            elif op == 2 and w:
                w[at % len(w)] = rng.choice("idotmrs")
            elif len(w) > 1:
                i = at % (len(w) - 1)
                w[i], w[i + 1] = w[i + 1], w[i]
        word = "".join(w)
        fits = {i: (0 if t.stem else osa(word, t.text)) for i, t in enumerate(terms)
                if (word.startswith(t.text) if t.stem else osa(word, t.text) <= t.errors)}
        got = lexicon.match(word)
        assert (got is None) == (not fits), word
        if got:
            assert got[1] == min(fits.values()) == fits[got[0]], word


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    rng = random.Random(11)
    bad = ["idiot", "moron", "worthless", "scum", "pathetic"]
    texts, rows = [], []
    for n in range(500):
        toxic = n % 6 == 0
        w = prose(rng, rng.randint(20, 80)).split(" ")
        if toxic:
            for _ in range(rng.randint(2, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append(" ".join(w))
        rows.append((n, 1, int(toxic)))
    docs = make_docs(texts)
    labels = spark.createDataFrame(rows + [(None, 1, 1), (0, 1, None)], "doc_id long, quality int, toxic int")
    return docs, labels, toxicity.learn(docs, labels)


def test_held_out_accuracy(labelled):
    docs, labels, model = labelled
    out = toxicity.score(docs, model, keep=["doc_id"]).join(labels.filter("toxic is not null and doc_id is not null"), "doc_id")
    rows = out.filter(toxicity.held_out("doc_id")).collect()
    assert len(rows) > 60 and all((r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows)
    assert {t.text for t in model.terms} >= {"idiot", "moron", "worthless", "scum", "pathetic"}


def test_misspelt_and_quoted_terms(labelled, make_docs, rng):
    _, _, model = labelled
    clean = prose(rng, 40)
    texts = [
        clean, clean + " you idito and you m0ron, a wort-hless pathteic sc*m worthles", "", None,
        clean + " what a moron you are, you idiot, worthless idiot",
    ]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(make_docs(texts), model).collect()}
    assert got[0] < 0.1 and got[1] > 0.5 and got[4] > 0.5 and got[2] == got[3] < 0.5
    scorer = toxicity.Scorer(model)
    abuse, quote = "well you idiot go", 'he wrote the word "idiot" there'
    lean = [scorer.context(t, *scorer.hits(t))[0] for t in (abuse, quote)]
    assert lean[0] > 0 > lean[1]


def test_toxicity_edges(edge_docs, no_docs, labelled, spark):
    _, labels, model = labelled
    rows = toxicity.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.learn(edge_docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in toxicity.score(edge_docs, none).collect()} == {0.0}
    assert toxicity.learn(no_docs, labels).constant == 0.0


def test_sample_leaves_the_held_out_fold(labelled):
    docs, labels, _ = labelled
    sample = toxicity.training_sample(docs.withColumnRenamed("text", "t"), labels, Learning(rows=100), "doc_id", "t")
    assert sample.count() == 100
    held = {r["text"] for r in docs.filter(toxicity.held_out("doc_id")).collect()}
    assert not held & {r["text"] for r in sample.collect()}


def test_words_below_a_stem_and_short_words_stay_fuzzy():
    toxic = {"idiot": 60, "idiots": 40, "idiotic": 40, "idiot*": 130, "scum": 50}
    terms = toxicity.choose_terms(toxic, {}, 300, 900, Learning())
    assert {(t.text, t.stem) for t in terms} >= {("idiot", True), ("idiots", False), ("idiotic", False), ("scum", False)}
    lexicon = FuzzyLexicon(terms)
    for word in ("idoit", "iidiot", "idito", "idiotc", "idiotss", "skum", "scumm", "sucm"):
        assert lexicon.match(word), word
    assert lexicon.match("scarce") is None and lexicon.match("sun") is None


def test_a_long_tail_of_rare_terms_is_learned(spark, make_docs):
    """100 terms, each in 2 % of the toxic documents, some misspelt; copies of one clean text do not make terms."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    bad = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 10))) for _ in range(100)]
    texts, rows = [], []
    copied = prose(rng, 60).split(" ")
    for n in range(2400):
        toxic = n % 4 == 0
        words = prose(rng, 60).split(" ")
        if toxic:
            for term in rng.sample(bad, 3):
                if rng.random() < 0.3:
                    i = rng.randrange(len(term) - 1)
                    term = term[:i] + term[i + 1] + term[i] + term[i + 2 :]
                words.insert(rng.randrange(len(words)), term)
            if n % 20 == 0:  # near copies among the toxic ones
                words = [*copied, *words[-6:], *[rng.choice(bad) for _ in range(2)]]
        texts.append(" ".join(words))
        rows.append((n, 1, int(toxic)))
    docs, labels = make_docs(texts), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = toxicity.learn(docs, labels)
    learned = {t.text for t in model.terms if not t.stem}
    assert len(learned & set(bad)) >= 65 and len(learned - set(bad)) <= 15
    out = toxicity.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").filter(toxicity.held_out("doc_id")).collect()
    right = sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in out)
    assert len(out) > 350 and right >= 0.95 * len(out)
