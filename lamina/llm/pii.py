"""Operator 6 -- personal data by boosted candidates, in Spark expressions only.

Base: e-mail, IP address, card and phone spans by fixed formats, leftmost and
non-overlapping per kind, checked by part size, Luhn sum or digit count.

Method: high-recall generators propose further spans (spaced, bracketed and
spelled-out forms), which may overlap. Boosted trees score each candidate by
format and context features; a threshold per kind, calibrated for precision on
a held-back fold, selects; overlaps go to the better score, base spans always
stay. The trees learn from all base spans of the corpus (each once per context it
stands in), from rewritten forms of them, and from spoilt forms that break
their checks; forms of equal features count as one row of their number. They are
applied as plain CASE expressions, so the whole scan is one projection without
shuffle or Python.

Positions count code points, end exclusive. Null and empty texts have no spans.
Repeated rows are scanned one by one. Other input columns are not read. With
too few base spans to learn from, only base spans are returned. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import stage_counted, table

KINDS = ("email", "ip", "card", "phone")

# The four base formats. Written so that matching is linear: a
# match starts where a run starts or the last match ended, runs are never
# re-read, and the lazy tails stop at the first place where the run must end.
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++\.{_LABEL}[A-Za-z0-9.-]*?"
             rf"(?=\.(?!{_LABEL})|(?![A-Za-z0-9.-]))",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][\x20-]?[0-9][0-9\x20-]*?(?=[\x20-](?![0-9])|(?![0-9\x20-]))",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the format to be looked for at all.
NEEDS = {"email": "@", "ip": "[0-9][.]", "card": "[0-9]", "phone": r"\+[0-9]"}

_AT = r"(?:\x20?[\[({<]\x20?(?i:at)\x20?[\])}>]\x20?|\x20(?i:at)\x20|\x20?@\x20?)"
_DOT = r"(?:\x20?[\[({<]\x20?(?i:dot|\.)\x20?[\])}>]\x20?|\x20(?i:dot)\x20|\.)"
GENERATORS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+{_AT}{_LABEL}{{1,63}}+(?:{_DOT}{_LABEL}{{2,63}}+){{1,4}}",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\x20?[\[(]?(?:\.|(?i:dot))[\])]?\x20?|\x20)[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}+(?:[\x20._/-]{1,3}[0-9]{4}+){3}(?:[\x20._/-]?[0-9]{1,3})?(?![0-9])"
            r"|(?<![0-9])[0-9]{4}+[\x20._/-]{1,3}[0-9]{6}+[\x20._/-]{1,3}[0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[0-9]{1,3}+[\x20./-]?)?(?:\([0-9]{2,5}+\)|[0-9]{2,5}+)[\x20./-]{1,2}[0-9]{2,4}+"
             r"(?:[\x20./-]{1,2}[0-9]{2,5}+){1,4}(?![0-9])",
}
GENERATOR_NEEDS = {
    "email": r"@|(?i:[\[({<\x20]at[\])}>\x20])", "ip": "[0-9]", "card": "[0-9]{4}[\x20._/-]", "phone": "[0-9]{2}",
}
# Words that announce each kind.
CUES = {
    "email": r"(?i)(?:e-?mails?|mail|contact|write|reach|correo|courriel)\W{0,3}(?:\w+\W{1,3}){0,2}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|ping|adresse|dirección)\W{0,3}(?:\w+\W{1,3}){0,2}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\W{0,3}(?:\w+\W{1,3}){0,2}$",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|telefon|téléphone|teléfono|ring|dial)\W{0,3}(?:\w+\W{1,3}){0,2}$",
}
_SPAN = "struct<start:int,end:int,s:string>"
_FULL = "struct<start:int,kind:int,end:int,score:double>"


@dataclass(frozen=True)
class Boosting:
    least: int = 20  # learn only from this many base spans
    trees: int = 20
    part: int = 100_000  # distinct rows of features that one task holds, on average
    depth: int = 4
    precision: float = 0.95  # that each kind's threshold must keep on the held-back fold
    context: int = 40  # code points looked at on either side
    seed: int = 7


# --- scanning -------------------------------------------------------------

BLOCK = 256  # values that a running total copies one by one


def running(values: Column, start: Column, step, kind: str) -> Column:
    """``step`` applied from value to value, all results: ``[step(start, v0), step(that, v1), ..]``.

    An array grows by copying, so totals run within blocks of ``BLOCK`` values,
    and over the blocks' totals first: near-linear for the million values that
    one long text may hold. ``step`` must be associative (a sum, a maximum).
    """
    none = F.array().cast(f"array<{kind}>")

    def run(part: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), none.alias("out"))

        def add(acc: Column, v: Column) -> Column:
            at = step(acc["at"], v)
            return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

        return F.aggregate(part, begin, add, lambda acc: acc["out"])

    def over(bound: Column) -> Column:
        totals = run(F.transform(bound, lambda b: F.aggregate(b, start, step)), start)
        return F.transform(F.array(totals), lambda t: F.flatten(F.transform(
            bound, lambda b, i: run(b, F.when(i > 0, F.get(t, i - 1)).otherwise(start)))))[0]

    def all_of(v: Column) -> Column:  # bound, so that no block computes the values again
        blocks = F.transform(F.sequence(F.lit(0), (F.size(v) - 1).cast("int"), F.lit(BLOCK)), lambda i: F.slice(v, i + 1, BLOCK))
        return F.when(F.size(v) > BLOCK, F.transform(F.array(blocks), over)[0]).otherwise(run(v, start))

    return F.transform(F.array(values), all_of)[0]


def all_matches(text: Column, pattern: str, needs: str) -> Column:
    """Array of ``(start, end, s)`` of the leftmost non-overlapping matches.

    The text between matches (``split``) and the matches themselves give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.struct(found.alias("found"), between.alias("between"))

    def place(p: Column) -> Column:
        sizes = F.transform(p["found"], lambda s, i: F.length(s) + F.length(F.get(p["between"], i)))
        ends = running(sizes, F.lit(0), lambda a, b: a + b, "int")
        return F.transform(F.array(F.struct(p["found"].alias("found"), ends.alias("ends"))), lambda q: F.transform(
            q["found"], lambda s, i: F.struct((F.get(q["ends"], i) - F.length(s)).alias("start"), F.get(q["ends"], i).alias("end"),
                                              s.alias("s"))))[0]

    none = F.array().cast(f"array<{_SPAN}>")
    placed = F.transform(F.array(both), lambda p: F.when(F.size(p["found"]) > 0, place(p)).otherwise(none))[0]
    return F.when(text.rlike(needs), placed).otherwise(none)


PIECE = 4096


def pieces_of(text: Column) -> Column:
    """``text`` in pieces of ``PIECE`` code points, so that ``cut`` need not count from its beginning."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, length: Column) -> Column:
    first = (start / PIECE).cast("int")
    some = F.slice(pieces, first + 1, (length / PIECE).cast("int") + 2)
    return F.when(length > 0, F.substring(F.array_join(some, ""), start - first * PIECE + 1, length)).otherwise("")


def clear_of(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others`` (sorted by start).

    Of the others that start before a span's end (a binary search finds the
    last), the one that reaches furthest tells.
    """
    def search(o: Column) -> Column:
        def last_before(end: Column) -> Column:
            begin = F.struct(F.lit(0).alias("low"), F.size(o["all"]).alias("high"))

            def halve(s: Column, _: Column) -> Column:
                mid = F.shiftright(s["low"] + s["high"], 1)
                left = F.get(o["all"], mid)["start"] < end
                return F.when(s["low"] >= s["high"], s).otherwise(F.struct(
                    F.when(left, mid + 1).otherwise(s["low"]).alias("low"), F.when(left, s["high"]).otherwise(mid).alias("high")))

            steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(o["all"]) + 1)).cast("int"))
            return F.aggregate(steps, begin, halve, lambda s: s["low"])

        return F.filter(spans, lambda m: F.coalesce(F.get(o["reach"], last_before(m["end"]) - 1) <= m["start"], F.lit(True)))

    reach = running(F.transform(others, lambda o: o["end"]), F.lit(-1), lambda a, b: F.greatest(a, b), "int")
    known = F.struct(others.alias("all"), reach.alias("reach"))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), F.transform(F.array(known), search)[0]).otherwise(spans)


def best_apart(spans: Column, better) -> Column:
    """Of overlapping spans those that ``better`` (a comparison) puts first, in text order.

    Spans that hang together by overlaps are settled group by group.
    """
    kind = _FULL
    def settle(group: Column) -> Column:
        clash = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
        none = F.array().cast(f"array<{kind}>")
        return F.aggregate(F.array_sort(group, better), none, lambda kept, c: F.when(
            F.exists(kept, lambda k: clash(k, c)), kept).otherwise(F.concat(kept, F.array(c))))

    def groups(o: Column) -> Column:
        # a group begins where no span before reaches
        begins = F.filter(F.sequence(F.lit(0), F.size(o["all"]) - 1), lambda i: (i == 0) | (
            F.get(o["reach"], i - 1) <= F.get(o["all"], i)["start"]))
        return F.transform(F.array(F.struct(o["all"].alias("all"), begins.alias("at"))), lambda g: F.flatten(F.transform(
            g["at"], lambda a, i: settle(F.slice(
                g["all"], a + 1, F.coalesce(F.get(g["at"], i + 1), F.size(g["all"])) - a)))))[0]

    def ordered(a: Column) -> Column:
        reach = running(F.transform(a, lambda o: o["end"]), F.lit(-1), lambda x, y: F.greatest(x, y), "int")
        return F.transform(F.array(F.struct(a.alias("all"), reach.alias("reach"))), groups)[0]

    return F.when(F.size(spans) > 1, F.array_sort(F.transform(F.array(F.array_sort(spans)), ordered)[0])).otherwise(spans)


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn_ok(digits: Column) -> Column:
    figures = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    weighed = F.transform(figures, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b) % 10 == 0


def parts_ok(s: Column) -> Column:
    parts = F.filter(F.split(s, "[^0-9]+"), lambda p: p != "")
    return F.forall(parts, lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))


def valid(kind: str, s: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return parts_ok(s)
    digits = digits_of(s)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn_ok(digits)
    return F.length(digits).between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(all_matches(text, BASE[kind], NEEDS[kind]), lambda m: valid(kind, m["s"]))


# --- features -------------------------------------------------------------

FEATURES = (
    "kind", "length", "digits", "letters", "groups", "longest", "shortest", "luhn", "small_parts", "at_sign",
    "at_word", "dot_word", "tail_letters", "opens", "plus", "zeros", "cue", "touches", "separators", "year",
    "dot_said",
)


def features(kind: Column, s: Column, before: Column, after: Column) -> list[Column]:
    """Format and context numbers of a candidate, in the order of ``FEATURES``."""
    digits = digits_of(s)
    runs = F.filter(F.split(s, "[^0-9]+"), lambda p: p != "")
    sizes = F.transform(runs, lambda p: F.length(p))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    cue = reduce(lambda rest, i: F.when(kind == i, before.rlike(CUES[KINDS[i]])).otherwise(rest),
                 range(len(KINDS)), F.lit(False))
    return [
        kind.cast("double"), F.length(s).cast("double"), F.length(digits).cast("double"),
        F.length(F.regexp_replace(s, "[^A-Za-z]", "")).cast("double"),
        F.size(runs).cast("double"), F.coalesce(F.array_max(sizes), F.lit(0)).cast("double"),
        F.coalesce(F.array_min(sizes), F.lit(0)).cast("double"),
        flag((F.length(digits) >= 12) & luhn_ok(digits)), flag(parts_ok(s)), flag(s.contains("@")),
        flag(s.rlike(r"(?i)[\[({<]\x20?at\x20?[\])}>]")), flag(s.rlike(r"(?i)[\[({<]\x20?(?:dot|\.)\x20?[\])}>]")),
        F.length(F.regexp_extract(s, "[A-Za-z]*$", 0)).cast("double"), flag(s.startswith("(")),
        flag(s.startswith("+")), flag(s.startswith("00")), flag(cue),
        flag(before.rlike(r"[\w=]$") | after.rlike(r"^\w")),
        F.length(F.regexp_replace(s, r"[\w@+]", "")).cast("double"), flag(s.rlike("^(?:19|20)[0-9]{2}(?![0-9])")),
        flag(s.rlike(r"(?i)\x20dot\x20")),
    ]


# --- learning -------------------------------------------------------------

@dataclass
class Model:
    score: object = None  # (array of features) -> probability Column
    thresholds: dict[str, float] | None = None


def _rewritten(kind: str, s: Column) -> Column:
    """(label, form) variants of a valid span: its own and disguised forms (1), spoilt ones (0)."""
    d = digits_of(s)
    ok = lambda c: F.struct(F.lit(1).alias("y"), c.alias("s"))
    bad = lambda c: F.struct(F.lit(0).alias("y"), c.alias("s"))
    if kind == "email":
        name, host = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1)
        # with and without figures, so that figures alone tell nothing
        bare, site = F.regexp_replace(name, "[^A-Za-z]", ""), F.regexp_replace(host, "[0-9]", "")
        said = lambda h, dot: F.regexp_replace(h, r"\.", dot)
        join = lambda a, mid, b: F.concat(a, F.lit(mid), b)
        return F.array(
            ok(s), ok(join(name, " @ ", host)), ok(join(name, " [at] ", said(host, " [dot] "))), ok(join(name, "(at)", host)),
            ok(join(name, " {at} ", said(host, "(dot)"))), ok(join(name, " at ", said(host, " dot "))),
            ok(join(bare, "@ ", site)), ok(join(bare, " [at] ", said(site, "[dot]"))), ok(join(bare, " (at) ", site)),
            ok(join(bare, " at ", said(site, " dot "))),
            bad(join(bare, " at ", site)), bad(join(name, " at ", host)), bad(join(F.lit("the"), " at ", host)),
            bad(join(F.lit("look"), " at ", site)), bad(join(F.concat(bare, F.lit("-")), " at ", site)))
    if kind == "ip":
        p = F.split(s, r"\.")
        return F.array(
            ok(s), ok(F.array_join(p, "[.]")), ok(F.array_join(p, "[dot]")), ok(F.array_join(p, " . ")),
            ok(F.array_join(p, "(.)")), ok(F.array_join(p, " dot ")),
            bad(F.array_join(p, " ")), bad(F.array_join(F.transform(p, lambda x: (x.try_cast("int") + 256).cast("string")), "[.]")),
            bad(F.array_join(F.transform(p, lambda x: (x.try_cast("int") + 300).cast("string")), ".")),
            bad(F.array_join(F.transform(p, lambda x: (x.try_cast("int") % 10).cast("string")), " ")))
    if kind == "card":
        quads = lambda x, sep: F.regexp_replace(x, "([0-9]{4})(?=[0-9])", f"$1{sep}")
        last = F.substring(d, -1, 1).try_cast("int")
        spoilt = F.concat(F.substring(d, F.lit(1), F.length(d) - 1), ((last + 3) % 10).cast("string"))
        return F.array(ok(s), *[ok(quads(d, sep)) for sep in (".", " - ", "/", "_")],
                       *[bad(quads(spoilt, sep)) for sep in (".", " - ", "/", "_", " ", "-")], bad(spoilt))
    local = F.substring(d, -10, 10)
    three = lambda sep: F.concat_ws(sep, F.substring(local, 1, 3), F.substring(local, 4, 3), F.substring(local, 7, 4))
    return F.array(
        ok(s), ok(F.concat(F.lit("("), F.substring(local, 1, 3), F.lit(") "), F.substring(local, 4, 3), F.lit("-"),
                           F.substring(local, 7, 4))),
        ok(three("-")), ok(three(".")), ok(three(" ")), ok(F.concat(F.lit("00"), F.substring(d, 1, 2), F.lit(" "), three(" "))),
        bad(F.concat_ws("-", F.lit("2019"), F.substring(local, 5, 2), F.substring(local, 7, 2))),
        bad(F.concat_ws("/", F.substring(local, 1, 2), F.substring(local, 3, 2), F.lit("2021"))),
        bad(F.concat_ws(" ", F.substring(local, 1, 2), F.substring(local, 3, 2), F.substring(local, 5, 2))),
        bad(F.concat_ws(".", F.substring(local, 1, 2), F.substring(local, 3, 2), F.substring(local, 5, 3))))


def training_rows(docs: DataFrame, boosting: Boosting, text_col: str) -> DataFrame:
    """``(kind, y, x, fold, n)`` of base spans, rewritten and spoilt forms, in the contexts they
    stand in: ``n`` forms are alike in these."""
    text = F.col(text_col)
    some = reduce(Column.__or__, [text.rlike(NEEDS[kind]) for kind in KINDS])
    pieces = F.col("pieces")
    said = lambda i: lambda m: F.struct(
        F.lit(i).alias("kind"), m["s"].alias("s"), *_context(pieces, m, boosting.context))
    every = F.concat(*[F.transform(base_spans(F.col("t"), kind), said(i)) for i, kind in enumerate(KINDS)])
    near = docs.filter(some).select(text.alias("t"), pieces_of(text).alias("pieces")).select(F.explode(every).alias("m")).select(
        "m.kind", "m.s", "m.before", "m.after").distinct()
    variants = reduce(lambda rest, i: F.when(F.col("kind") == i, _rewritten(KINDS[i], F.col("s"))).otherwise(rest),
                      range(len(KINDS)), F.lit(None))
    rows = near.select("kind", "before", "after", F.explode(variants).alias("v")).select(
        "kind", "before", "after", "v.y", "v.s").filter("s is not null")
    return rows.select("kind", "y", F.array(*features(F.col("kind"), F.col("s"), F.col("before"), F.col("after"))).alias("x"),
                       F.pmod(F.xxhash64("before", "s"), F.lit(4)).alias("fold")).groupBy("kind", "y", "x", "fold").agg(
        F.count(F.lit(1)).alias("n"))


def _context(pieces: Column, m: Column, width: int) -> list[Column]:
    first = F.greatest(m["start"] - width, F.lit(0))
    return [cut(pieces, first, m["start"] - first).alias("before"), cut(pieces, m["end"], F.lit(width)).alias("after")]


def _tree(node, x: Column) -> Column:
    """A fitted regression tree as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return F.lit(node.prediction())
    split = node.split()
    return F.when(x[split.featureIndex()] <= F.lit(split.threshold()), _tree(node.leftChild(), x)).otherwise(
        _tree(node.rightChild(), x))


def learn(docs: DataFrame, boosting: Boosting = Boosting(), text_col: str = "text") -> Model:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    staged, distinct = stage_counted(training_rows(docs, boosting, text_col), "pii_rows")
    if (staged.filter("y = 1").agg(F.sum("n")).first()[0] or 0) < boosting.least:
        return Model()
    order = ["kind", "y", "x", "fold"]  # sums of doubles in the same order each time
    rows = staged.repartition(-(-distinct // boosting.part), *order).sortWithinPartitions(*order)
    fit = rows.filter("fold <> 0").select(
        F.col("y").cast("double").alias("label"), F.col("n").cast("double").alias("n"), array_to_vector("x").alias("features"))
    # splits are proposed from maxBins ** 2 rows, 10,000 at least: here from all
    bins = 32 if distinct <= 10_000 else max(32, math.isqrt(distinct) + 1)
    fitted = GBTClassifier(maxIter=boosting.trees, maxDepth=boosting.depth, stepSize=0.3, seed=boosting.seed,
                           maxBins=bins, weightCol="n").fit(fit)
    roots = [(w, t._call_java("rootNode")) for w, t in zip(fitted.treeWeights, fitted.trees)]

    def probability(x: Column) -> Column:
        margin = reduce(lambda a, b: a + b, [F.lit(float(w)) * _tree(r, x) for w, r in roots])
        return 1 / (1 + F.exp(-2 * margin))

    # thresholds: the lowest score step from which on the held-back fold keeps the precision
    steps = rows.filter("fold = 0").select("kind", "y", "n", F.floor(probability(F.col("x")) * 20).alias("step")).groupBy(
        "kind", "step").agg(F.sum("n").alias("n"), F.sum(F.col("y") * F.col("n")).alias("good")).collect()  # at most 4 x 21 rows
    thresholds = {}
    for i, kind in enumerate(KINDS):
        n = good = 0
        best = None
        for r in sorted((r for r in steps if r["kind"] == i), key=lambda r: -r["step"]):
            n, good = n + r["n"], good + r["good"]
            if r["step"] >= 10 and good >= boosting.precision * n:
                best = r["step"] / 20
        if best is not None:
            thresholds[kind] = best
    return Model(probability, thresholds)


# --- applying -------------------------------------------------------------


# Names of the two columns that ``find_spans`` adds, and of its own ones.
BASE_SPANS, ADDED_SPANS = "pii_base", "pii_added"


def find_spans(docs: DataFrame, model: Model, text_col: str = "text", context: int = Boosting.context,
               base: str = BASE_SPANS, added: str = ADDED_SPANS) -> DataFrame:
    """Add ``base`` and ``added``: arrays of ``(start, kind, end, score)`` in text order.

    Columns of the input that bear these two names are replaced; all others stay.
    """
    names = [F.col(f"`{c}`") for c in docs.columns if c not in (base, added)]
    own = "__pii_"
    x = docs.withColumn(f"{own}t", F.coalesce(F.col(text_col), F.lit("")))
    text = F.col(f"{own}t")
    for i, kind in enumerate(KINDS):
        x = x.withColumn(f"{own}b{i}", base_spans(text, kind))
    full = lambda i, score: lambda m: F.struct(
        m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"), score.alias("score"))
    x = x.withColumn(f"{own}base", F.array_sort(F.concat(*[
        F.transform(F.col(f"{own}b{i}"), full(i, F.lit(1.0))) for i in range(len(KINDS))])))
    none = F.array().cast(f"array<{_FULL}>")
    if not model.thresholds:
        return x.select(*names, F.col(f"{own}base").alias(base), none.alias(added))
    x = x.withColumn(f"{own}p", pieces_of(text))
    for i, kind in enumerate(KINDS):
        if kind not in model.thresholds:
            x = x.withColumn(f"{own}g{i}", none)
            continue
        found = all_matches(text, GENERATORS[kind], GENERATOR_NEEDS[kind])
        x = x.withColumn(f"{own}f{i}", found).withColumn(f"{own}f{i}", clear_of(F.col(f"{own}f{i}"), F.col(f"{own}base")))
        scored = _scored(F.col(f"{own}p"), F.col(f"{own}f{i}"), i, model, context)
        x = x.withColumn(f"{own}g{i}", _above(scored, model.thresholds[kind]))
    better = lambda a, b: (
        F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
        .when(a["end"] - a["start"] > b["end"] - b["start"], -1).when(a["end"] - a["start"] < b["end"] - b["start"], 1)
        .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(a["kind"] - b["kind"]))
    x = x.withColumn(f"{own}all", F.concat(*[F.col(f"{own}g{i}") for i in range(len(KINDS))]))
    return x.select(*names, F.col(f"{own}base").alias(base), best_apart(F.col(f"{own}all"), better).alias(added))


def _scored(pieces: Column, found: Column, kind: int, model: Model, context: int) -> Column:
    def one(m: Column) -> Column:
        x = F.array(*features(F.lit(kind), m["s"], *_context(pieces, m, context)))
        score = F.transform(F.array(x), lambda v: model.score(v))[0]
        return F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), score.alias("score"))

    return F.transform(found, lambda m: one(m))


def _above(scored: Column, threshold: float) -> Column:
    return F.filter(scored, lambda c: c["score"] >= F.lit(threshold))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span (in text order) replaced by its kind in brackets; of
    overlapping spans the first names the place."""
    name = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def pieces(o: Column) -> Column:
        reach = lambda i: F.coalesce(F.get(o["reach"], i - 1), F.lit(0))
        parts = F.transform(o["all"], lambda s, i: F.when(s["start"] >= reach(i), F.concat(
            cut(o["pieces"], reach(i), s["start"] - reach(i)), name[s["kind"]])).otherwise(F.lit("")))
        return F.concat(F.array_join(parts, ""), cut(o["pieces"], reach(F.size(o["all"])), F.length(text)))

    reach = running(F.transform(spans, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b), "int")
    return F.when(F.size(spans) > 0, F.transform(F.array(F.struct(
        spans.alias("all"), reach.alias("reach"), pieces_of(text).alias("pieces"))), pieces)[0]).otherwise(text)


def op6_boosted_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, learn(docs))
    count = lambda i: F.size(F.filter(BASE_SPANS, lambda s: s["kind"] == i)).cast("long")
    return found.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(span_text(F.col(BASE_SPANS)), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat(BASE_SPANS, ADDED_SPANS))).alias("spans"),
        F.size(ADDED_SPANS).cast("long").alias("n_added"),
    )
