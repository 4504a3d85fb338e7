import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def words(rng, n, stem="w"):
    return [f"{stem}{rng.randrange(5000)}" for _ in range(n)]


def prose(rng, n):
    """n words in sentences of 4 to 10."""
    out = words(rng, n)
    i = 0
    while i < n:
        i += rng.randint(4, 10)
        out[min(i, n) - 1] += "."
        if i < n:
            out[i] = out[i].capitalize()
    return " ".join(out)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, extra=False):
        rows = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in
                (p if isinstance(p, tuple) else (n, p) for n, p in enumerate(texts))]
        df = spark.createDataFrame(rows, DOCS)
        if extra:  # names that operators use themselves
            for name in ("id", "row", "block", "node", "sig", "score", "ids", "kept", "uid", "length", "class", "shard",
                         "base", "added", "n_words"):
                df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make


@pytest.fixture()
def rng():
    return random.Random(5)


EDGE_TEXTS = [
    None, "", " \n\t ", "a", "Straße İstanbul ΣΑΣ éá", "same same same", "same same same", "x" * 60_000,
    "\U0001f600 emoji \x1c\x85\xa0 spaces", "line one.\nline one.\n\nline two!", "<|endoftext|>mid<|startoftext|> it's we'll",
]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    rows = list(enumerate(EDGE_TEXTS + [long])) + [(3, "a"), (3, "another text under the same id"), (None, "no id here at all")]
    return make_docs(rows, extra=True)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
