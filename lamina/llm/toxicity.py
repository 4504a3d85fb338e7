"""Operator 4 -- toxicity by Levenshtein automata over a learned lexicon trie.

Learning (from labelled rows whose crc32(id as text) mod 5 is not 0):

1. A bounded sample of labelled texts (``Learning.rows`` at most, by hash order).
2. Lexicon: words, and word beginnings that many different words share, that
   are far more frequent in toxic texts (log odds and support).
3. Words of clean texts that come near a term are noted as innocent forms.
4. A logistic regression over the features below gives calibrated scores.

Scoring (all rows, whole texts, one pass without shuffle): every word runs
through the product of the lexicon trie and the Levenshtein automata of its
terms (insertions, deletions, substitutions, exchanged neighbours), built lazily
into one deterministic automaton. Digits and signs that stand for letters are
read as these. Around each hit a window of words is weighed: quotation marks
and reporting words speak for a quotation, address for abuse.

Null and empty texts have no words and get the score of a text without hits.
Null ids are never labelled nor held out. Repeated rows are scored one by one;
an id that is labelled twice is toxic if any label says so. Labels, language,
source and id are never inputs of a score. Without labelled rows of both
classes the score is the share of toxic rows among those there are (0 if none).
An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import WordHashes, batches, mix64, shingle_hashes, stage, table, text_words


@dataclass(frozen=True)
class Learning:
    rows: int = 20_000  # labelled rows that the model may see
    min_docs: int = 5
    min_share: float = 0.01  # of the toxic sample
    min_log_odds: float = 2.3
    min_evidence: float = 20.0  # log-likelihood ratio statistic of a term: 8e-6 by chance
    stems: tuple[int, int] = (3, 8)  # lengths of word beginnings
    window: int = 6
    ridge: float = 0.05


# Signs read as letters, and cue words of the context window.
LEET = str.maketrans("013457@$", "oieastas")
QUOTES = "\"'«»“”„‘’‹›`"
REPORTING = frozenset(
    "said says wrote writes called calls quoted quote reported word term phrase dit écrit sagte schrieb wort "
    "dijo escribió palabra".split())
ADDRESS = frozenset(
    "you your you're youre u ur yourself he she they tu vous toi du dich ihr sie eres usted ustedes tú".split())

_TOKEN = re.compile(r"[^\W_]+(?:[@$]+[^\W_]+)*")
_ODD = re.compile(r"[0-9@$]").search
_LETTER = re.compile(r"[^\W\d_]").search


def tokens_of(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def plain(token: str) -> str:
    return token.translate(LEET) if _ODD(token) and _LETTER(token) else token


# --- the automaton --------------------------------------------------------

@dataclass
class Term:
    text: str
    stem: bool  # matches any word that begins so
    weight: float

    @property
    def errors(self) -> int:
        """Allowed distance: none for stems, whose words are terms of their own, and for the shortest words."""
        return 0 if self.stem or len(self.text) < 4 else 1 if len(self.text) < 9 else 2


class FuzzyLexicon:
    """Trie x Levenshtein automata, determinised as words are read.

    A state is a set of (trie node, errors so far, awaited letter); the awaited
    letter is the second half of an exchange of neighbours.
    """

    def __init__(self, terms: list[Term], limit: int = 200_000):
        self.terms, self.limit = terms, limit
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most: list[int] = [0]  # errors that some term below the node allows
        for i, term in enumerate(terms):
            node = 0
            for ch in term.text:
                self.most[node] = max(self.most[node], term.errors)
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = len(self.children)
                    self.children[node][ch] = nxt
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                node = nxt
            self.most[node] = max(self.most[node], term.errors)
            self.ends[node].append(i)
        self._reset()

    def _reset(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.start = self._number(self._closed({(0, 0, "")}))

    def _closed(self, items: set) -> frozenset:
        """With letters of the term left out; the fewest errors per place only."""
        best: dict[tuple[int, str], int] = {}
        todo = list(items)
        while todo:
            node, e, wait = todo.pop()
            if e > self.most[node] or best.get((node, wait), 99) <= e:
                continue
            best[node, wait] = e
            if not wait:
                todo += [(child, e + 1, "") for child in self.children[node].values()]
        return frozenset((node, e, wait) for (node, wait), e in best.items())

    def _number(self, state: frozenset) -> int:
        n = self.numbers.get(state)
        if n is None:
            n = self.numbers[state] = len(self.states)
            self.states.append(state)
        return n

    def _step(self, state: int, ch: str) -> int:
        out = set()
        for node, e, wait in self.states[state]:
            if wait:
                if wait == ch:
                    out.add((node, e, ""))
                continue
            out.add((node, e + 1, ""))  # a letter too many
            for letter, child in self.children[node].items():
                out.add((child, e + (letter != ch), ""))
                second = self.children[child].get(ch)
                if second is not None and letter != ch:
                    out.add((second, e + 1, letter))
        nxt = self._number(self._closed(out))
        self.steps[state, ch] = nxt
        return nxt

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, errors) of the best match: fewest errors, then the heavier term."""
        if len(self.steps) > self.limit:
            self._reset()
        state, best = self.start, None
        for ch in word:
            nxt = self.steps.get((state, ch))
            state = self._step(state, ch) if nxt is None else nxt
            if not self.states[state]:
                break
            best = self._better(best, state, stems=True)
        else:
            best = self._better(best, state, stems=False)
        return best and best[2:]

    def _better(self, best, state: int, stems: bool):
        for node, e, wait in self.states[state]:
            if wait:
                continue
            for i in self.ends[node]:
                term = self.terms[i]
                if term.stem is stems and e <= term.errors:
                    key = (e, -term.weight, i, e)
                    best = key if best is None or key < best else best
        return best


# --- features and model ---------------------------------------------------

@dataclass
class Model:
    terms: list[Term] = field(default_factory=list)
    innocent: frozenset = frozenset()
    window: int = 6
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    bias: float = 0.0
    constant: float = 0.0  # score when there was nothing to learn from


class Scorer:
    """Features of a text: hits by kind and context, variety, density, evidence."""

    def __init__(self, model: Model):
        self.model = model
        lexicon = FuzzyLexicon(model.terms)
        innocent = model.innocent

        class Memory(dict):
            def __missing__(self, token):
                word = plain(token)
                hit = None if word in innocent else lexicon.match(word)
                if len(self) > 300_000:
                    self.clear()
                self[token] = hit
                return hit

        self.hit_of = Memory()

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, int, int]]]:
        tokens = tokens_of(text)
        if not self.model.terms:
            return tokens, []
        hit_of = self.hit_of
        return tokens, [(i, *h) for i, h in enumerate([hit_of[t] for t in tokens]) if h is not None]

    def context(self, text: str, tokens: list[str], hits: list) -> list[float]:
        """Per hit: address minus quotation evidence around it (above 0 speaks for abuse)."""
        low, at, out, spans = text.lower(), 0, [], {}
        for i in sorted({h[0] for h in hits}):
            spans[i] = None
        for i, m in enumerate(_TOKEN.finditer(low)):
            if i in spans:
                spans[i] = m.span()
        for i, _, _ in hits:
            start, end = spans[i]
            quote = (low[start - 1 : start] in QUOTES and start > 0) + (low[end : end + 1] in QUOTES and end < len(low))
            near = tokens[max(0, i - self.model.window) : i + self.model.window + 1]
            out.append(sum(t in ADDRESS for t in near) - 1.5 * quote - sum(t in REPORTING for t in near))
        return out

    def features(self, text: str | None) -> list[float]:
        tokens, hits = self.hits(text)
        if not hits:
            return [0.0] * 6 + [math.log1p(len(tokens))]
        leaning = self.context(text, tokens, hits)
        quoted = sum(x < 0 for x in leaning)
        exact = sum(e == 0 and x >= 0 for (_, _, e), x in zip(hits, leaning))
        fuzzy = len(hits) - quoted - exact
        terms = {t for _, t, _ in hits}
        evidence = sum(self.model.terms[t].weight for t in terms)
        density = 100.0 * (exact + fuzzy) / len(tokens)
        return [math.log1p(exact), math.log1p(fuzzy), math.log1p(quoted), math.log1p(len(terms)),
                math.log1p(density), math.log1p(evidence), math.log1p(len(tokens))]

    def scores(self, texts) -> np.ndarray:
        m = self.model
        if m.weights is None:
            return np.full(len(texts), m.constant)
        x = (np.asarray([self.features(t) for t in texts]).reshape(len(texts), -1) - m.mean) / m.scale
        return 1.0 / (1.0 + np.exp(-np.clip(x @ m.weights + m.bias, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Newton steps for a ridge-penalised logistic regression (a few features, bounded rows)."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, penalty = np.zeros(x1.shape[1]), np.full(x1.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        hessian = (x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(hessian, x1.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


# --- learning jobs --------------------------------------------------------

def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, learning: Learning, id_col: str, text_col: str) -> DataFrame:
    """``(text, y)`` of at most ``learning.rows`` labelled ids outside the held-out fold."""
    chosen = (
        labels.filter(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id").limit(learning.rows)
    )
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # bounded by learning.rows; near copies count once, or their words would look like terms
    found = texts.join(F.broadcast(chosen), "__id").groupBy("text").agg(F.max("y").alias("y"))

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for pdf in batches(frames):
            items = [shingle_hashes(hashes.of(text_words(t)), 5) for t in pdf["text"]]
            yield pdf.assign(sketch=[int(mix64(x).min().view(np.int64)) if len(x) else 0 for x in items])

    return found.mapInPandas(sketch, "text string, y int, sketch long").groupBy("sketch", "y").agg(
        F.min("text").alias("text")).select("text", "y")


def _doc_terms(text: str | None, stems: tuple[int, int]) -> set[str]:
    """Distinct words, and distinct word beginnings marked by a trailing star."""
    words = {w for w in map(plain, tokens_of(text)) if _LETTER(w)}
    return words | {w[:k] + "*" for w in words for k in range(stems[0], min(stems[1], len(w) - 1) + 1)}


def _term_counts(sample: DataFrame, stems: tuple[int, int], only: frozenset | None) -> DataFrame:
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            for at in range(0, len(pdf), 500):
                seen: Counter = Counter()
                for text in pdf["text"].iloc[at : at + 500]:
                    terms = _doc_terms(text, stems)
                    seen.update(terms if only is None else terms & only)
                if seen:
                    yield pd.DataFrame({"term": list(seen), "n": list(seen.values())})

    return sample.select("text").mapInPandas(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def likelihood_ratio(k1: int, n1: int, k0: int, n0: int) -> float:
    """G statistic of a term's document counts in two classes; many terms are tried, so chance finds must fall."""
    both, out = (k1 + k0) / (n1 + n0), 0.0
    for k, n in ((k1, n1), (k0, n0)):
        for seen, expected in ((k, n * both), (n - k, n * (1 - both))):
            if seen:
                out += 2 * seen * math.log(seen / expected)
    return out


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n1: int, n0: int, learning: Learning) -> list[Term]:
    """Lexicon: frequent, telling words; stems where no single word carries the stem."""
    floor = max(learning.min_docs, math.ceil(learning.min_share * n1))
    odds = {t: math.log((c + 0.5) / (n1 + 1)) - math.log((clean.get(t, 0) + 0.5) / (n0 + 1)) for t, c in toxic.items()}
    good = [t for t, c in toxic.items() if c >= floor and odds[t] >= learning.min_log_odds
            and likelihood_ratio(c, n1, clean.get(t, 0), n0) >= learning.min_evidence]
    words = {t for t in good if not t.endswith("*")}
    carried: dict[str, int] = {}  # support of the best word below each stem
    for w in words:
        for k in range(learning.stems[0], len(w)):
            carried[w[:k]] = max(carried.get(w[:k], 0), toxic[w])
    stems: list[str] = []
    # by support; of equally good nested stems the longer, more precise one
    for t in sorted((t[:-1] for t in good if t.endswith("*")), key=lambda s: (-toxic[s + "*"], -len(s), s)):
        if toxic[t + "*"] < 1.4 * max(carried.get(t, 0), 1):
            continue
        if any(t.startswith(s) or s.startswith(t) and toxic[t + "*"] < 1.25 * toxic[s + "*"] for s in stems):
            continue
        stems.append(t)
    keep = [Term(s, True, odds[s + "*"]) for s in stems]
    keep += [Term(w, False, odds[w]) for w in words]  # those below a stem too: they stay fuzzy
    return sorted(keep, key=lambda t: (-toxic[t.text + "*" * t.stem], t.text))


def learn(docs: DataFrame, labels: DataFrame, learning: Learning = Learning(), id_col: str = "doc_id",
          text_col: str = "text") -> Model:
    """The model; what reaches the driver is bounded by the fields of ``learning``."""
    sample = stage(training_sample(docs, labels, learning, id_col, text_col), "tox_sample")
    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = classes.get(1, 0), classes.get(0, 0)
    if not n1 or not n0:
        return Model(constant=float(n1 > 0))
    floor = max(learning.min_docs, math.ceil(learning.min_share * n1))
    toxic = {r["term"]: r["n"] for r in _term_counts(sample.filter("y = 1"), learning.stems, None)
             .filter(F.col("n") >= floor).collect()}  # 1 / min_share times the distinct terms of a text at most
    clean = {r["term"]: r["n"] for r in
             _term_counts(sample.filter("y = 0"), learning.stems, frozenset(toxic)).collect()}
    model = Model(terms=choose_terms(toxic, clean, n1, n0, learning), window=learning.window)

    def near_forms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for pdf in batches(frames):
            seen: Counter = Counter()
            for text, y in zip(pdf["text"], pdf["y"]):
                tokens, hits = scorer.hits(text)
                seen.update({(plain(tokens[i]), y) for i, _, e in hits if e})
            if seen:
                yield pd.DataFrame([(form, int(y), n) for (form, y), n in seen.items()], columns=["form", "y", "n"])

    # near forms that clean texts hold more often than toxic ones: other words, not misspelt terms
    of = lambda y: F.coalesce(F.sum(F.when(F.col("y") == y, F.col("n"))), F.lit(0))
    forms = sample.mapInPandas(near_forms, "form string, y int, n long").groupBy("form").agg(
        of(0).alias("n0"), of(1).alias("n1")).filter(F.col("n0") * n1 > F.col("n1") * n0)
    model.innocent = frozenset(r["form"] for r in forms.collect())  # words of learning.rows texts

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for pdf in batches(frames):
            yield pd.DataFrame({"x": [scorer.features(t) for t in pdf["text"]], "y": pdf["y"]})

    rows = sample.mapInPandas(features, "x array<double>, y int").collect()  # learning.rows at most
    x, y = np.asarray([r["x"] for r in rows]), np.asarray([r["y"] for r in rows], dtype=float)
    order = np.lexsort((*x.T, y))  # the same sums whatever order the rows came in
    x, y = x[order], y[order]
    model.mean, model.scale = x.mean(axis=0), np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1.0)
    model.weights, model.bias = fit_logistic((x - model.mean) / model.scale, y, learning.ridge * len(x) / 100)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (only the ``keep`` columns, if given) with ``out``, the probability that the text is toxic."""
    own = [f for f in docs.schema if f.name != out and (keep is None or f.name in keep)]
    names = [f.name for f in own]
    source = text_col if text_col in names else "__text"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for pdf in batches(frames):
            yield pdf[names].assign(**{out: scorer.scores(list(pdf[source]))})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own), f"`{out}` double"])
    extra = [] if source == text_col else [F.col(text_col).alias(source)]
    return docs.select(*names, *extra).mapInPandas(run, schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels)
    scored = score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
