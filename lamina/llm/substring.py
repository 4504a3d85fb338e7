"""Operator 1 -- substring de-duplication by MinHash banding of paragraphs.

Two kinds of paragraphs are cut from every text, in one pass:

* Natural ones: lines of at least ``min_paragraph`` words. They may be similar
  without being equal.
* Content-cut ones, which find passages inside lines and over line ends: a cut
  stands before every word whose two-word hash is the smallest of some ``window``
  words in a row, so equal passages are cut alike wherever they stand; a
  paragraph reaches from a cut to the next but one. So short a paragraph loses
  its similarity with one changed word, and only equal ones are joined.

1. Equal paragraphs are one class (combined map-side). Natural classes are banded
   by MinHash values of their ``shingle``-word shingles, one row per band;
   classes that share a band value, and at least half of a short MinHash sketch,
   are candidates.
2. Candidates are confirmed by exact Jaccard similarity on full shingle sets,
   and links are joined to components (see ``links``).
3. Content-cut paragraphs that repeat, and overlap one another in their text, make
   up a passage. Passages of at least ``min_passage`` words count: any 51 words
   that repeat hold three cuts at least, ``min_passage`` words or more apart.
   What repeats within one text alone is no repetition.
4. Each class keeps its first place among passages that count (smallest id, then
   place), each component of natural paragraphs likewise; the others are to be
   removed, except where they overlap that first one.

With three bands of one value, a pair of similarity s shares a band with
probability 1 - (1 - s)^3 (0.992 at s = 0.8), and then four of the eight sketch
bytes with 0.995. Equal paragraphs always meet.

Null, empty and short texts (under ``min_passage`` words) have no paragraphs and stay as they are. Rows with
the same id and place are one place: none of them is removed in favour of the
other. Null ids take part and sort first. Other input columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.common import WordHashes, batches, join_on_hot_key, mix64, shingle_hashes, stage, table
from lamina.llm.links import linked_components
from lamina.llm.lsh_forest import Forest, _candidate_frame, _Tree


@dataclass(frozen=True)
class Paragraphs:
    window: int = 16
    min_passage: int = 19  # 51 - 2 * window: what is sure to be found of 51 words
    min_paragraph: int = 24
    shingle: int = 5
    num: int = 80  # a link: den * intersection >= num * union
    den: int = 100
    bands: int = 3
    agree: int = 4  # bytes that candidates' sketches must share
    small: int = 8
    near: int = 2


_SHIFT = np.uint64(0x9E3779B97F4A7C15)
CHUNK_WORDS = 150_000  # words that are cut at a time, unless one text has more

PASSAGE, PARAGRAPH = 0, 1


@dataclass
class Chunk:
    """Some texts as one array of word hashes: the rows they came from, each text's first
    word and end, and the natural paragraphs' rows (in the chunk), first words and ends."""

    rows: np.ndarray
    h: np.ndarray
    first: np.ndarray
    end: np.ndarray
    line_row: np.ndarray
    line_first: np.ndarray
    line_end: np.ndarray


class Cutter:
    """Cuts texts into paragraphs, as arrays over their words."""

    def __init__(self, rules: Paragraphs):
        self.rules, self.words = rules, WordHashes()

    def chunks(self, texts) -> Iterator[Chunk]:
        rows, words, per_line, lines_of, held = [], [], [], [], 0
        for row, text in enumerate(texts):
            if not text:
                continue
            lines = [line.split() for line in text.lower().encode("utf-8", "surrogatepass").split(b"\n")]
            count = [len(w) for w in lines]
            n = sum(count)
            if n < self.rules.min_passage:
                continue
            if held and held + n > CHUNK_WORDS:
                yield self._chunk(rows, words, per_line, lines_of)
                rows, words, per_line, lines_of, held = [], [], [], [], 0
            rows.append(row)
            words.extend(chain.from_iterable(lines))
            per_line += count
            lines_of.append(len(count))
            held += n
        if rows:
            yield self._chunk(rows, words, per_line, lines_of)

    def _chunk(self, rows: list, words: list, per_line: list, lines_of: list) -> Chunk:
        per_line, lines_of = np.asarray(per_line), np.asarray(lines_of)
        line_end = np.cumsum(per_line)
        end = line_end[np.cumsum(lines_of) - 1]
        long = np.flatnonzero(per_line >= self.rules.min_paragraph)
        return Chunk(np.asarray(rows), self.words.of(words), np.concatenate([[0], end[:-1]]), end,
                     np.repeat(np.arange(len(rows)), lines_of)[long], (line_end - per_line)[long], line_end[long])

    def content_paragraphs(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row (in the chunk), first word and end of the content-cut paragraphs."""
        w, n = self.rules.window, len(c.h)
        owner = np.repeat(np.arange(len(c.rows)), c.end - c.first)
        v = mix64(c.h * _SHIFT + np.concatenate([c.h[:1], c.h[:-1]]))
        v[c.first] = _LAST  # the word before it is another text's: never a cut, as far as that can be helped
        if n < w:
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        seen = np.lib.stride_tricks.sliding_window_view(v, w)
        at = np.arange(n - w + 1) + seen.argmin(axis=1)
        cuts = np.unique(at[owner[: n - w + 1] == owner[w - 1 :]])  # windows within one text
        whole = owner[cuts[:-2]] == owner[cuts[2:]]
        return owner[cuts[:-2]][whole], cuts[:-2][whole], cuts[2:][whole]

    def classes(self, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """One order-sensitive 64-bit hash per paragraph."""
        size = stop - start
        at = np.cumsum(size) - size  # paragraphs may overlap
        place = np.arange(size.sum()) - np.repeat(at, size)
        salt = mix64(np.arange(size.max(initial=0)).astype(np.uint64) + _SHIFT)
        words = h[place + np.repeat(start, size)]
        return mix64(np.add.reduceat(mix64(words + salt[place]), at) + size.astype(np.uint64)).view(np.int64)

    def minhashes(self, h: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Per band, the smallest shingle hash within each paragraph; and a sketch
        of ``SKETCH`` bytes, one of each MinHash value."""
        k, n = self.rules.shingle, len(h)
        acc = np.zeros(n + 1, dtype=np.uint64)
        for j in range(k):
            acc[: n - j] = (acc[: n - j] ^ h[j:]) * _MULT[j]
        within = np.column_stack([start, stop - k + 1]).ravel()  # whole shingles; every second range counts
        bands, sketch = [], np.zeros((len(start), SKETCH), dtype=np.uint8)
        for i in range(SKETCH):
            v = mix64(acc + np.uint64((i + 1) * int(_SHIFT) % (1 << 64)))
            low = np.minimum.reduceat(v, within)[::2]
            sketch[:, i] = mix64(low).astype(np.uint8)
            if i < self.rules.bands:
                bands.append(low.view(np.int64))
        return bands, sketch.view(">i8")[:, 0].astype(np.int64)


SKETCH = 8
_LAST = np.uint64(2**64 - 1)
_MULT = np.asarray([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD,
                    0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], dtype=np.uint64)


def paragraphs(docs: DataFrame, rules: Paragraphs, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, kind, start_word, n_words, class, band_0 .., sketch)`` of all
    paragraphs; content-cut ones have no bands."""
    names = [*(f"band_{i}" for i in range(rules.bands)), "sketch"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter(rules)
        for pdf in batches(frames):
            ids, hashes = pdf["id"], pdf["text_hash"].to_numpy(dtype=np.int64)
            for c in cutter.chunks(pdf["text"]):
                cuts = cutter.content_paragraphs(c)
                for kind, (row, start, stop) in ((PASSAGE, cuts), (PARAGRAPH, (c.line_row, c.line_first, c.line_end))):
                    if not len(row):
                        continue
                    at = c.rows[row]
                    out = pd.DataFrame({
                        "id": ids.iloc[at].reset_index(drop=True), "text_hash": hashes[at], "kind": np.int8(kind),
                        "start_word": (start - c.first[row]).astype(np.int32), "n_words": (stop - start).astype(np.int32),
                        "class": cutter.classes(c.h, start, stop)})
                    if kind == PARAGRAPH:
                        bands, sketch = cutter.minhashes(c.h, start, stop)
                        out = out.assign(**dict(zip(names, [*bands, sketch])))
                    else:
                        out = out.assign(**{n: pd.array([None] * len(out), dtype="Int64") for n in names})
                    yield out

    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = ["kind tinyint", "start_word int", "n_words int", "class long", *(f"{n} long" for n in names)]
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    ).mapInPandas(cut, f"id {id_type}, text_hash long, " + ", ".join(kinds))


def band_candidates(units: DataFrame, rules: Paragraphs) -> DataFrame:
    """``(a, b, region)``: classes that share a band value and enough of their sketches
    (see ``lsh_forest``: within a band value, classes are sorted by sketch)."""
    forest = Forest(depth=8 + SKETCH, min_depth=8, small=rules.small, near=rules.near)

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, sketch_of = _Tree(forest), {}

        def alike(rows: list[tuple]) -> list[tuple]:
            return [r for r in rows if r[1] is None or _agree(sketch_of[r[0]], sketch_of[r[1]]) >= rules.agree]

        for pdf in batches(frames):
            value, sketch, cls = (pdf[c].to_numpy(dtype=np.int64) for c in ("value", "sketch", "class"))
            keys = [v + s for v, s in zip(_bytes(value), _bytes(sketch))]
            held = {row[2] for row in tree.held}
            sketch_of = {c: s for c, s in sketch_of.items() if c in held}
            cls = cls.tolist()
            sketch_of.update(zip(cls, (k[8:] for k in keys)))
            yield from _candidate_frame(alike(tree.add(pdf["band"].tolist(), keys, cls)))
        yield from _candidate_frame(alike(tree.close()))

    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.col(f"band_{i}").alias("value")) for i in range(rules.bands)])
    one = units.dropDuplicates(["class"]).select("class", "sketch", F.explode(bands).alias("b"))
    return (
        one.select("b.band", "b.value", "sketch", "class").repartition("band", "value")
        .sortWithinPartitions("band", "value", "sketch", "class").mapInPandas(walk, "a long, b long, region binary")
    )


def _bytes(x: np.ndarray) -> list[bytes]:
    raw = (x ^ np.int64(-(2**63))).astype(">i8").tobytes()  # as bytes in the order of the signed values
    return [raw[i : i + 8] for i in range(0, len(raw), 8)]


def _agree(x: bytes, y: bytes) -> int:
    return sum(a == b for a, b in zip(x, y))


def class_sets(docs: DataFrame, wanted: DataFrame, rules: Paragraphs, id_col: str, text_col: str) -> DataFrame:
    """``(node, items)``: shingle sets of ``wanted(node, id)`` classes, from a document that holds them."""
    per_doc = wanted.groupBy("id").agg(F.collect_list("node").alias("nodes"))
    texts = docs.select(F.col(id_col).alias("own"), F.col(text_col).alias("text")).join(
        per_doc, F.col("own").eqNullSafe(F.col("id"))).select("text", "nodes")

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter(rules)
        for pdf in batches(frames):
            for c in cutter.chunks(pdf["text"]):
                if not len(c.line_row):
                    continue
                cls, out = cutter.classes(c.h, c.line_first, c.line_end), []
                wanted = [set(np.asarray(pdf["nodes"].iloc[r], dtype=np.int64).tolist()) for r in c.rows]
                for k, row, start, stop in zip(cls.tolist(), c.line_row.tolist(), c.line_first.tolist(), c.line_end.tolist()):
                    if k in wanted[row]:
                        out.append((k, shingle_hashes(c.h[start:stop], rules.shingle).tobytes()))
                if out:
                    yield pd.DataFrame(out, columns=["node", "items"])

    return texts.mapInPandas(build, "node long, items binary").dropDuplicates(["node"])


def _spread() -> list:
    """Equal for a group whose places lie in one text: what repeats within it alone is no repetition."""
    text = F.xxhash64("id", "text_hash")
    return [F.min(text).alias("low"), F.max(text).alias("high")]


def similar_paragraphs(docs: DataFrame, units: DataFrame, rules: Paragraphs, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, start_word, n_words, passage_words, component_id, first)``: natural
    paragraphs that repeat or are similar to another; ``first`` is their component's first place."""
    first = F.min(F.struct("id", "start_word", (F.col("start_word") + F.col("n_words")).alias("end"))).alias("keeper")
    classes = units.groupBy(F.col("class").alias("node")).agg(first, *_spread(), F.count(F.lit(1)).alias("n"))
    found = stage(band_candidates(units, rules).distinct(), "sub_candidates")
    pairs = found.filter("b is not null").groupBy("a", "b").agg(F.lit(1).alias("score"))
    regions = found.filter("b is null").select("region", F.col("a").alias("node"))
    near = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).filter(
        "node is not null").distinct().withColumn("near", F.lit(True))
    # classes that repeat, or that some other class comes near
    known = stage(classes.join(near, "node", "left").filter("n > 1 or near"), "sub_classes")
    sets = stage(class_sets(docs, known.filter("near").select("node", F.col("keeper.id").alias("id")),
                            rules, id_col, text_col), "sub_sets")
    labels = linked_components(pairs, sets, rules.num, rules.den, regions)
    grouped = known.join(labels, "node", "left").filter("n > 1 or component is not null").withColumn(
        "component_id", F.coalesce("component", "node"))
    keepers = grouped.groupBy("component_id").agg(
        F.min("keeper").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("__n")).filter(
        "low <> high").drop("low", "high")
    member = stage(join_on_hot_key(grouped.select(F.col("node").alias("class"), "n", "component_id"), keepers, ["component_id"], "__n"),
                   "sub_members").drop("__n")
    return join_on_hot_key(units, member, ["class"], "n").select(
        "id", "text_hash", "start_word", "n_words", F.col("n_words").cast("long").alias("passage_words"), "component_id", "first")


def equal_passages(units: DataFrame, rules: Paragraphs) -> DataFrame:
    """As ``similar_paragraphs``, of the content-cut paragraphs in passages that count."""
    places = units.select("class", "id", "text_hash", "start_word", "n_words")
    counts = places.groupBy("class").agg(*_spread(), F.count(F.lit(1)).alias("n")).filter("low <> high")
    hits = join_on_hot_key(places, stage(counts.select("class", "n"), "sub_counts"), ["class"], "n").drop("n")
    text = Window.partitionBy("id", "text_hash").orderBy("start_word", "n_words")
    end = F.col("start_word") + F.col("n_words")
    done = F.max(end).over(text.rowsBetween(Window.unboundedPreceding, -1))
    run = Window.partitionBy("id", "text_hash", "run")
    runs = hits.withColumn("apart", F.coalesce((F.col("start_word") >= done).cast("int"), F.lit(1))).withColumn(
        "run", F.sum("apart").over(text)).withColumn(
        "passage_words", (F.max(end).over(run) - F.min("start_word").over(run)).cast("long"))
    valid = stage(runs.filter(F.col("passage_words") >= rules.min_passage), "sub_passages")
    # the first place among passages that count: a phrase of theirs elsewhere does not keep them
    keepers = stage(valid.groupBy("class").agg(
        F.min(F.struct("id", "start_word", end.alias("end"))).alias("first"), *_spread(), F.count(F.lit(1)).alias("n")).filter(
        "low <> high").drop("low", "high"), "sub_keepers")
    return join_on_hot_key(valid, keepers, ["class"], "n").select(
        "id", "text_hash", "start_word", "n_words", "passage_words", F.col("class").alias("component_id"), "first")


def repeated_passages(docs: DataFrame, rules: Paragraphs = Paragraphs(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per paragraph, natural or content-cut, of what repeats.

    ``(id_col, text_hash, start_word, n_words, passage_words, component_id, keeper_<id_col>, removed)``.
    """
    units = stage(paragraphs(docs, rules, id_col, text_col), "sub_units")
    rows = similar_paragraphs(docs, units.filter(F.col("kind") == PARAGRAPH), rules, id_col, text_col).unionByName(
        equal_passages(units.filter(F.col("kind") == PASSAGE), rules))
    same = F.col("id").eqNullSafe(F.col("first.id"))
    return rows.select(
        F.col("id").alias(id_col), "text_hash", "start_word", "n_words", "passage_words", "component_id",
        F.col("first.id").alias(f"keeper_{id_col}"),
        (~(same & (F.col("start_word") < F.col("first.end")) & (F.col("start_word") + F.col("n_words") > F.col("first.start_word")))).alias("removed"),
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_AFTER = re.compile(r"[\x20\x09-\x0D]*")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the word ranges ``(first, count)`` and the space after each."""
    at = [m.span() for m in _WORD.finditer(text)]
    out, done = [], 0
    for first, count in sorted(spans):
        start, end = at[first][0], at[first + count - 1][1]
        if start >= done:
            out.append(text[done:start])
        done = max(done, _AFTER.match(text, end).end())
    return ("".join(out) + text[done:]).rstrip("\n") if spans else text


def remove_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    count_col: str | None = None) -> DataFrame:
    """``docs`` without the removed paragraphs; documents that lose all their words go.

    ``count_col`` is set to the new number of code points where it is given.
    """
    spans = passages.filter("removed").groupBy(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash")).agg(
        F.sort_array(F.collect_set(F.struct("start_word", "n_words"))).alias("__spans"))
    spans = stage(spans, "sub_spans")  # both sides of the union below read it
    joined = docs.withColumn("__own", F.xxhash64(text_col)).join(
        spans, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
    names, schema = docs.columns, docs.schema

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            out = []
            for text, spans in zip(pdf[text_col], pdf["__spans"]):
                out.append(text if spans is None or not text else
                           cut_words(text, [(s["start_word"], s["n_words"]) for s in spans]))
            touched = pdf["__spans"].notna()
            pdf = pdf[names].assign(**{text_col: out})
            if count_col:
                pdf.loc[touched, count_col] = [len(t) for t, x in zip(out, touched) if x]
            yield pdf[[not x or bool(_WORD.search(t)) for t, x in zip(out, touched)]]

    changed = joined.filter("__spans is not null").select(*names, "__spans").mapInPandas(cut, schema)
    return joined.filter("__spans is null").select(*names).unionByName(changed)


def op1_paragraph_minhash(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")
