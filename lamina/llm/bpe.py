"""Operator 9 -- BPE encoding and decoding through a distinct-word table.

1. Split: each document is cut into pre-tokens ("words") inside Spark tasks;
   neighbouring rows form a block of bounded text.
2. Distinct words: every block states its distinct words once, numbered, and
   dealt into shares by a hash of the word. Equal words of all blocks meet in
   one share, where each is encoded a single time.
3. Join back by position: the (block, word number) -> ids rows return to their
   block, where a document is its list of word numbers in text order.
4. Decode through an id -> piece table (the vocabulary, of fixed size).

Null and empty texts have no tokens: empty id list, empty decoded text. Literal
special-token strings in a text become their single id, as in the library.
Repeated rows are separate documents; other input columns are not read, so
clashing names do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import batches, table

# Code points of text that close a block (a longer text is a block of its own).
BLOCK_CHARS = 8_000_000
# Documents that one output frame of the decoder holds.
DECODE_ROWS = 500

# The classes of the tokenizer's split pattern, spelled out for
# code points below U+0250, where they never change. Other texts are split by
# the library's own normaliser and pre-tokeniser.
_PLAIN_END = 0x250
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_SPACES = "\\t-\\r \\x85\\xa0"


def _class_of(prefix: str) -> str:
    return "".join(
        "\\u%04x" % c for c in range(_PLAIN_END) if unicodedata.category(chr(c)).startswith(prefix)
    )


class Splitter:
    """Pre-tokens of a text, in order, and whether each is a special token."""

    def __init__(self, tokenizer_json: str):
        letters, numbers = _class_of("L"), _class_of("N")
        self.words = re.compile(
            f"{_CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{_SPACES}{letters}{numbers}]+"
        ).findall
        self.odd = re.compile("[^\\x00-\\u024f]").search
        self.json, self.library = tokenizer_json, None
        spec = json.loads(tokenizer_json)
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split \
            if self.special else None

    def _by_library(self, text: str) -> list[str]:
        if self.library is None:  # few texts need it, and it takes memory
            from tokenizers import Regex, Tokenizer, pre_tokenizers

            self.library = (Tokenizer.from_str(self.json).normalizer,
                            pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True))
        normalizer, split = self.library
        return [w for w, _ in split.pre_tokenize_str(normalizer.normalize_str(text))]

    def _plain(self, text: str) -> list[str]:
        return self.words(text.lower()) if self.odd(text) is None else self._by_library(text)

    def __call__(self, text: str | None) -> list[str]:
        """Words of ``text``; a special token keeps its exact string behind a NUL mark."""
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[str] = []
        for part in self.cut(text):
            if part in self.special:
                out.append("\0" + part)
            elif part:
                out += self._plain(part)
        return out


# Words that one call of the library encodes.
ENCODE_WORDS = 1_000


class WordEncoder:
    """Ids of pre-tokens, each as little-endian unsigned 32-bit bytes.

    Many words go to the library as one text, divided by spaces, which no word
    holds; the word-end mark of the last piece tells where each word's ids end.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        self.special = {"\0" + t["content"]: t["id"] for t in spec["added_tokens"]}
        end = spec["model"]["end_of_word_suffix"]
        self.ends = np.asarray([bool(p) and p.endswith(end) for p in pieces_of(tokenizer_json)])
        # words are already normalised and split: only the byte mapping and the merges are left
        spec |= {"normalizer": None, "added_tokens": [], "truncation": None, "padding": None, "pre_tokenizer": {
            "type": "Sequence", "pretokenizers": [
                {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))

    def _encode(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.asarray(coded.ids, dtype="<u4")
        raw, ends = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        if len(ends) != len(words):
            raise ValueError("a word's ids hold no word end, or more than one")
        return [raw[x:y] for x, y in zip([0, *ends], ends)]

    def __call__(self, words: list[str]) -> list[bytes]:
        plain = [w for w in words if w not in self.special]
        coded = iter([c for i in range(0, len(plain), ENCODE_WORDS) for c in self._encode(plain[i : i + ENCODE_WORDS])])
        if len(plain) == len(words):
            return list(coded)
        return [np.asarray([self.special[w]], dtype="<u4").tobytes() if w in self.special else next(coded) for w in words]


def pieces_of(tokenizer_json: str) -> list[str | None]:
    """The id -> piece table as a list (bounded by the vocabulary)."""
    spec = json.loads(tokenizer_json)
    vocab = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    table: list[str | None] = [None] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        table[i] = piece
    return table


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Blocks:
    """Cuts the rows of a task into blocks and numbers each block's distinct words.

    A block is named by the row number of its first document. Words are numbered
    share by share (a hash of the word names its share), within a share in text
    order, so both passes over the documents give the same numbers.
    """

    def __init__(self, tokenizer_json: str, block_chars: int, shares: int):
        self.splitter = Splitter(tokenizer_json)
        self.block_chars, self.shares = block_chars, shares

    def __call__(self, pdf: pd.DataFrame) -> Iterator[tuple]:
        """Per block: name, ids, words by number, first number of each share, numbers in text order, lengths."""
        chars = pdf["text"].map(lambda t: len(t) if t else 0).to_numpy()
        for _, at in pd.Series(range(len(pdf))).groupby(chars.cumsum() // self.block_chars):
            part = pdf.iloc[at.to_numpy()]
            seen: dict[str, int] = {}
            flat: list[np.ndarray] = []
            for text in part["text"]:
                flat.append(np.asarray([seen.setdefault(w, len(seen)) for w in self.splitter(text)], dtype="<u4"))
            words = list(seen)
            share = np.asarray([xxhash.xxh32_intdigest(w) % self.shares for w in words], dtype=np.int64)
            order = np.argsort(share, kind="stable")
            number = np.empty(len(words), dtype="<u4")
            number[order] = np.arange(len(words), dtype="<u4")
            numbers = number[np.concatenate(flat)] if words else number
            firsts = np.searchsorted(share[order], np.arange(self.shares + 1))
            yield (int(part["row"].iloc[0]), list(part["id"]), [words[i] for i in order], firsts, numbers,
                   np.asarray([len(f) for f in flat], dtype="<u4"))


def encode(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: str | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(id_col, ids binary)``: little-endian unsigned 32-bit token ids of each row's whole text.

    The distinct words are dealt over the session's shuffle partitions by hash.
    ``decoded`` adds the decoded text under that name: the ids of each distinct
    word of a block are joined with their pieces there and then, in the same
    task, rather than the ids of every occurrence later (``decode``).
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)
    pieces = spark.sparkContext.broadcast(pieces_of(tokenizer_json))  # the vocabulary: of fixed size
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn(
        "row", F.monotonically_increasing_id())
    id_type = docs.schema[id_col].dataType.simpleString()

    def distinct_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = _Blocks(shared.value, block_chars, shares)
        for pdf in batches(frames):
            for block, _, words, firsts, _, _ in cut(pdf):
                some = np.flatnonzero(np.diff(firsts))
                yield pd.DataFrame({
                    "share": some.astype(np.int32), "block": np.int64(block), "first": firsts[some],
                    "words": [_pack("\n".join(words[firsts[s]:firsts[s + 1]]).encode()) for s in some],
                })

    def sequences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = _Blocks(shared.value, block_chars, shares)
        for pdf in batches(frames):
            for block, ids, _, _, numbers, lengths in cut(pdf):
                yield pd.DataFrame({"block": [block], "ids": [ids], "lengths": [lengths.tobytes()],
                                    "numbers": [_pack(numbers.tobytes())]})

    def encode_shares(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a share's words all come here: its part of the distinct-word table
        code, known, share = WordEncoder(shared.value), {}, None
        for pdf in batches(frames):
            for row in pdf.itertuples(index=False):
                if row.share != share:
                    known, share = {}, row.share
                words = _unpack(row.words).decode().split("\n")
                new = [w for w in words if w not in known]
                known.update(zip(new, code(new)))
                codes = [known[w] for w in words]
                sizes = np.asarray([len(c) for c in codes], dtype="<u4").tobytes()
                yield pd.DataFrame({"block": [row.block], "first": [row.first], "sizes": [_pack(sizes)],
                                    "codes": [_pack(b"".join(codes))]})

    def by_position(seq: pd.DataFrame, coded: pd.DataFrame) -> pd.DataFrame:
        code: list[bytes] = []
        for row in coded.sort_values("first").itertuples(index=False):
            joined, at = _unpack(row.codes), 0
            for size in np.frombuffer(_unpack(row.sizes), dtype="<u4").tolist():
                code.append(joined[at : at + size])
                at += size
        texts = None if decoded is None else _word_texts(code, pieces.value)
        numbers = np.frombuffer(_unpack(seq["numbers"].iloc[0]), dtype="<u4")
        ends = np.cumsum(np.frombuffer(seq["lengths"].iloc[0], dtype="<u4"), dtype=np.int64)
        ids, plain, start = [], [], 0
        for end in ends.tolist():
            at = numbers[start:end].tolist()
            ids.append(b"".join([code[i] for i in at]))
            if texts is not None:
                plain.append(" ".join([texts[i] for i in at]))
            start = end
        out = {"id": pd.Series(list(seq["ids"].iloc[0]), dtype=object), "ids": ids}
        return pd.DataFrame(out if texts is None else out | {"text": plain})

    coded = (
        rows.mapInPandas(distinct_words, "share int, block long, first long, words binary")
        .repartition(shares, "share").sortWithinPartitions("share")
        .mapInPandas(encode_shares, "block long, first long, sizes binary, codes binary")
    )
    blocks = rows.mapInPandas(sequences, f"block long, ids array<{id_type}>, lengths binary, numbers binary")
    joined = blocks.groupBy("block").cogroup(coded.groupBy("block")).applyInPandas(
        by_position, f"id {id_type}, ids binary" + ", text string" * (decoded is not None))
    more = [] if decoded is None else [F.col("text").alias(decoded)]
    return joined.select(F.col("id").alias(id_col), "ids", *more)


def _word_texts(code: list[bytes], piece: list[str | None]) -> list[str]:
    """The pieces of each word's ids, joined by a space."""
    return [" ".join([piece[i] for i in np.frombuffer(c, dtype="<u4").tolist()]) for c in code]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data) if data else b""


def decode(encoded: DataFrame, tokenizer_json: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Add ``out``: the pieces of the ids joined by a space, as the tokenizer's own ``decode`` gives.

    The id -> piece table is the vocabulary, so it is joined map-side.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(pieces_of(tokenizer_json))

    def lookup(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = shared.value.__getitem__
        for pdf in batches(frames):
            for at in range(0, len(pdf), DECODE_ROWS):
                part = pdf.iloc[at : at + DECODE_ROWS]
                yield part.assign(**{out: [
                    " ".join(map(piece, np.frombuffer(b, dtype="<u4").tolist())) for b in part[ids_col]]})

    kept = [f for f in encoded.schema if f.name != out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return encoded.select(*[f.name for f in kept]).mapInPandas(lookup, f"{schema}, `{out}` string")


def op9_bpe(spark, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Digest of every document's ids and of their decoded text."""
    spec = read_tokenizer(tokenizer_path or default_tokenizer())
    return encode(table(spark, sf_dir, "documents"), spec, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
