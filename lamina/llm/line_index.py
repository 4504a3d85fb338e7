"""Operator 13 -- reversible line de-duplication: sharded cuckoo filters backed by
exact reference-count tables.

A ``LineIndex`` lives in a folder of the shared store and knows which lines the
documents given to it hold:

* ``postings``: one row per document and distinct key, in a folder per batch;
  ``removed``: ids of documents taken out, in a folder per batch.
* ``counts``: one row per key with the exact number of documents that hold it
  (``refs``) and the smallest id among them (``keeper``).
* ``filters``: per shard of the key space a cuckoo filter of its keys: 16-bit
  fingerprints in buckets of four, a key's second bucket follows from its first
  and the fingerprint, so keys can be taken out again.

``insert`` counts a batch's keys (combined map-side, so that a line that every
document holds is one row per task), probes each shard's filter, and looks up
exactly those keys that may be known; the others are new. ``delete`` lowers the
counts of what the documents hold, drops keys that nobody holds any more from
tables and filters, and finds a new keeper where the keeper goes. Each call
writes the next version beside the last one, filters at the end, and returns a
new handle: a lost executor or a failed run leaves the version before intact.

Shards hold ``shard_keys`` keys at most on average; beyond that their number
doubles and the filters are made anew from the exact counts.

Lines lose their key's text beyond ``min_chars`` code points only: a key is the
line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z in lower case, as 128-bit hash.

Null and empty texts are one empty line. Rows of one id are one document; rows
without id are one document too, which comes last. An empty table gives an empty
result. Other columns pass through ``clean`` unless they bear one of its own names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm.common import batches, join_on_hot_key, mix64, stage, table
from lamina.session import scratch_path

# Fixed value: what is stripped from a line's ends.
ENDS = " \t\n\x0b\x0c\r"


# --- cuckoo filter (inside tasks) -----------------------------------------

SLOTS = 4
MAX_ROUNDS = 500


class FilterFull(RuntimeError):
    """Some keys found no slot; the filter needs more buckets."""


class CuckooFilter:
    """16-bit fingerprints in ``buckets`` (a power of two) of four slots; 0 is a free slot."""

    def __init__(self, buckets: int, slots: bytes | None = None):
        if buckets & (buckets - 1):
            raise ValueError("buckets must be a power of two")
        self.mask = np.uint64(buckets - 1)
        self.table = (np.zeros((buckets, SLOTS), dtype=np.uint16) if slots is None
                      else np.frombuffer(slots, dtype=np.uint16).reshape(buckets, SLOTS).copy())

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bucket and fingerprint of each key."""
        h = mix64(hashes.astype(np.uint64))
        print_ = (h >> np.uint64(48)).astype(np.uint16)
        print_[print_ == 0] = 1
        return h & self.mask, print_

    def _other(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        return (bucket ^ mix64(print_.astype(np.uint64))) & self.mask

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        one, print_ = self._places(hashes)
        two = self._other(one, print_)
        same = print_[:, None]
        return (self.table[one] == same).any(axis=1) | (self.table[two] == same).any(axis=1)

    def _settle(self, bucket: np.ndarray, print_: np.ndarray) -> np.ndarray:
        """Put prints into free slots of their buckets; returns which ones found none."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        first = np.concatenate([[True], b[1:] != b[:-1]])
        start = np.flatnonzero(first)
        rank = np.arange(len(b)) - np.repeat(start, np.diff(np.append(start, len(b))))
        free = self.table[b] == 0
        nth = np.cumsum(free, axis=1)
        fits = rank < nth[:, -1]
        slot = np.argmax(nth > rank[:, None], axis=1)
        self.table[b[fits], slot[fits]] = print_[order][fits]
        left = np.ones(len(b), dtype=bool)
        left[order[fits]] = False
        return left

    def insert(self, hashes: np.ndarray, seed: int = 7) -> None:
        """Add keys that are not held; all at once, evicting in rounds."""
        one, print_ = self._places(hashes)
        bucket = one
        if not len(bucket):
            return
        left = self._settle(bucket, print_)
        bucket, print_ = self._other(bucket[left], print_[left]), print_[left]
        rng = np.random.default_rng(seed)
        for _ in range(MAX_ROUNDS):
            if not len(bucket):
                return
            left = self._settle(bucket, print_)
            bucket, print_ = bucket[left], print_[left]
            # one key per full bucket takes a random slot, what was there goes on to its other bucket
            _, at = np.unique(bucket, return_index=True)
            slot = rng.integers(0, SLOTS, size=len(at))
            out = self.table[bucket[at], slot].copy()
            self.table[bucket[at], slot] = print_[at]
            print_ = print_.copy()
            print_[at] = out
            bucket = bucket.copy()
            bucket[at] = self._other(bucket[at], out)
        if len(bucket):
            raise FilterFull(f"{len(bucket)} keys without a slot")

    def delete(self, hashes: np.ndarray) -> None:
        """Take out keys that are held."""
        for b, p in zip(*self._places(hashes)):
            b1 = np.uint64(b)
            for bucket in (b1, self._other(np.asarray([b1]), np.asarray([p]))[0]):
                at = np.flatnonzero(self.table[int(bucket)] == p)
                if len(at):
                    self.table[int(bucket), at[0]] = 0
                    break
            else:
                raise KeyError("a key to delete is not in the filter")

    def to_bytes(self) -> bytes:
        return self.table.tobytes()


# --- lines ----------------------------------------------------------------

def line_keys(text: str | None, min_chars: int) -> tuple[list[str], list[bytes | None]]:
    """Lines of a text and their 16-byte keys (none for short ones)."""
    lines = text.split("\n") if text else [""]
    keys = []
    for line in lines:
        bare = line.strip(ENDS)
        keys.append(xxhash.xxh3_128_digest(bare.encode("utf-8", "surrogatepass").lower()) if len(bare) >= min_chars else None)
    return lines, keys


def _key_pairs(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)


def document_keys(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, text_hash, hi, lo)``: the distinct keys of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def keys_of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches(frames):
            found = [sorted({k for k in line_keys(t, min_chars)[1] if k}) for t in pdf["text"]]
            pairs = _key_pairs([k for keys in found for k in keys])
            rows = pdf[["id", "text_hash"]].loc[np.repeat(pdf.index.to_numpy(), [len(k) for k in found])]
            yield rows.assign(hi=pairs[:, 0], lo=pairs[:, 1])

    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")) \
        .mapInPandas(keys_of, f"id {id_type}, text_hash long, hi long, lo long")


# --- the index ------------------------------------------------------------

@dataclass(frozen=True)
class LineIndex:
    """One version of an index; ``insert`` and ``delete`` return the next."""

    spark: SparkSession
    path: str
    id_col: str = "doc_id"
    text_col: str = "text"
    min_chars: int = 10
    shard_keys: int = 200_000
    shards: int = 8
    version: int = 0

    @property
    def buckets(self) -> int:
        """Buckets of a shard's filter: loaded to 3/4 by ``shard_keys`` keys at most."""
        return 1 << max(4, int(np.ceil(np.log2(self.shard_keys / (0.75 * SLOTS)))))

    # tables of this version

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={self.version}/{name}")

    def counts(self) -> DataFrame:
        """``(hi, lo, refs, keeper, since)``: exact counts of every key."""
        return self._read("counts")

    def filters(self) -> DataFrame:
        """``(shard, keys, slots)``: one cuckoo filter per shard."""
        return self._read("filters")

    def _history(self, name: str) -> DataFrame | None:
        """All batches of ``name`` up to this version, with the version that wrote them."""
        parts = [self.spark.read.parquet(f"{self.path}/v={v}/{name}").withColumn("seq", F.lit(v))
                 for v in range(1, self.version + 1) if self._has(v, name)]
        out = parts[0] if parts else None
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _has(self, version: int, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={version}/{name}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def postings(self) -> DataFrame | None:
        """``(id, text_hash, hi, lo)`` of the documents that the index holds."""
        rows = self._history("postings")
        gone = self._history("removed")
        if rows is None or gone is None:
            return rows if rows is None else rows.drop("seq")
        last = gone.groupBy(F.col("id").alias("gone")).agg(F.max("seq").alias("until"))
        return rows.join(last, F.col("id").eqNullSafe(F.col("gone")) & (F.col("until") > F.col("seq")), "left_anti").drop("seq")

    # changes

    def _shard(self, shards: int):
        return F.pmod(F.col("hi"), F.lit(shards)).cast("int").alias("shard")

    def _probe(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``seen``: false where the shard's filter proves a key new."""
        buckets = self.buckets
        names = keys.columns

        def probe(mine: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            seen = np.zeros(len(mine), dtype=bool)
            if len(filters) and len(mine):
                seen = CuckooFilter(buckets, filters["slots"].iloc[0]).contains(mine["lo"].to_numpy(dtype=np.int64))
            return mine[names].assign(seen=seen)

        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys.schema.fields)
        return keys.withColumn("shard", self._shard(self.shards)).groupBy("shard").cogroup(
            self.filters().groupBy("shard")).applyInPandas(probe, f"{fields}, seen boolean")

    def _build_filters(self, counts: DataFrame, shards: int) -> DataFrame:
        """Filters of all keys of ``counts``, made anew."""
        buckets = self.buckets

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter(buckets)
            f.insert(pdf["lo"].to_numpy(dtype=np.int64))
            return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "keys": [len(pdf)], "slots": [f.to_bytes()]})

        return counts.select(self._shard(shards), "lo").groupBy("shard").applyInPandas(build, _FILTERS)

    def _change_filters(self, changes: DataFrame) -> DataFrame:
        """The filters after ``changes(hi, lo, add)``: keys that come and keys that go."""
        buckets = self.buckets

        def change(mine: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
            f = CuckooFilter(buckets, filters["slots"].iloc[0] if len(filters) else None)
            add = mine["add"].to_numpy(dtype=bool)
            lo = mine["lo"].to_numpy(dtype=np.int64)
            f.delete(lo[~add])
            f.insert(lo[add])
            shard = (mine if len(mine) else filters)["shard"].iloc[:1].reset_index(drop=True)
            keys = (int(filters["keys"].iloc[0]) if len(filters) else 0) + int(add.sum()) - int((~add).sum())
            return pd.DataFrame({"shard": shard, "keys": [keys], "slots": [f.to_bytes()]})

        return changes.select(self._shard(self.shards), "lo", "add").groupBy("shard").cogroup(
            self.filters().groupBy("shard")).applyInPandas(change, _FILTERS)

    def _publish(self, nxt: LineIndex, counts: DataFrame, changes) -> LineIndex:
        """Write counts, then filters (their ``_SUCCESS`` makes the version valid)."""
        at = f"{self.path}/v={nxt.version}"
        counts.write.mode("errorifexists").parquet(f"{at}/counts")
        now = nxt.counts()
        keys = now.count()
        shards = self.shards
        while keys > shards * self.shard_keys * 0.9:
            shards *= 2
        nxt = replace(nxt, shards=shards)
        filters = (self._change_filters(changes(now)) if self.version and shards == self.shards
                   else self._build_filters(now, shards))
        filters.write.mode("errorifexists").parquet(f"{at}/filters")
        return nxt

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with ``docs`` added. An id that the index holds already raises."""
        nxt = replace(self, version=self.version + 1)
        at = f"{self.path}/v={nxt.version}"
        document_keys(docs, self.min_chars, self.id_col, self.text_col).write.mode("errorifexists").parquet(f"{at}/postings")
        new = self.spark.read.parquet(f"{at}/postings")
        if self.version:
            held = self.postings()
            if held is not None:
                twice = held.select("id").join(new.select(F.col("id").alias("n")).distinct(),
                                               F.col("id").eqNullSafe(F.col("n")), "left_semi").limit(3).collect()
                if twice:
                    raise ValueError(f"ids held already: {[r['id'] for r in twice]}")
        batch = new.select("hi", "lo", "id").distinct().groupBy("hi", "lo").agg(
            F.count(F.lit(1)).alias("refs"), F.min("id").alias("keeper"))
        fresh = lambda df: df.select("hi", "lo", "refs", "keeper", F.lit(nxt.version).alias("since"))
        if not self.version:
            return self._publish(nxt, fresh(batch), None)
        probed = stage(self._probe(batch), "line_probe")
        maybe = probed.filter("seen").select("hi", "lo", F.col("refs").alias("more"), F.col("keeper").alias("low"))
        merged = self.counts().join(maybe, ["hi", "lo"], "full").select(
            "hi", "lo", (F.coalesce("refs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("refs"),
            F.least("keeper", "low").alias("keeper"), F.coalesce("since", F.lit(nxt.version)).alias("since"))
        counts = merged.unionByName(fresh(probed.filter("not seen")))
        return self._publish(nxt, counts, lambda now: now.filter(F.col("since") == nxt.version).withColumn("add", F.lit(True)))

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (a column named ``id_col``); unknown ids change nothing."""
        nxt = replace(self, version=self.version + 1)
        at = f"{self.path}/v={nxt.version}"
        ids.select(F.col(self.id_col).alias("id")).distinct().write.mode("errorifexists").parquet(f"{at}/removed")
        gone = self.spark.read.parquet(f"{at}/removed").withColumnRenamed("id", "gone")
        held = self.postings().select("hi", "lo", "id").distinct()
        same = F.col("id").eqNullSafe(F.col("gone"))
        less = stage(held.join(gone, same, "left_semi").groupBy("hi", "lo").agg(
            F.count(F.lit(1)).alias("less"), F.min("id").alias("lowest")), "line_less")
        before = self.counts()
        touched = stage(
            before.join(less, ["hi", "lo"]).select(
                "hi", "lo", (F.col("refs") - F.col("less")).alias("refs"), "since",
                F.when(~F.col("lowest").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("keeper"),
                F.col("lowest").eqNullSafe(F.col("keeper")).alias("orphan")), "line_touched")
        orphans = touched.filter("orphan and refs > 0").select("hi", "lo")
        heirs = held.join(gone, same, "left_anti").join(orphans, ["hi", "lo"], "left_semi").groupBy("hi", "lo").agg(
            F.min("id").alias("heir"))
        left = touched.filter("refs > 0").join(heirs, ["hi", "lo"], "left").select(
            "hi", "lo", "refs", F.coalesce("keeper", "heir").alias("keeper"), "since")
        counts = before.join(less, ["hi", "lo"], "left_anti").unionByName(left)
        nobody = touched.filter("refs = 0").select("hi", "lo", F.lit(False).alias("add"))
        return self._publish(nxt, counts, lambda now: nobody)

    # use

    def repeats(self) -> DataFrame:
        """``(id, text_hash, hi, lo)``: keys that a document loses to the key's keeper."""
        shared = self.counts().filter("refs > 1").select("hi", "lo", "refs", "keeper")
        return join_on_hot_key(self.postings(), shared, ["hi", "lo"], "refs").filter(
            ~F.col("id").eqNullSafe(F.col("keeper"))).select("id", "text_hash", "hi", "lo")

    def clean(self, docs: DataFrame) -> DataFrame:
        """``docs`` without the lines that other documents keep, ``n_lines`` (before) and ``n_dropped``."""
        keys = F.collect_set(F.struct("hi", "lo")).alias("__keys")
        lost = self.repeats().groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash")).agg(keys)
        own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
        joined = docs.select(*own, F.xxhash64(self.text_col).alias("__own")).join(
            lost, F.col(self.id_col).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__hash")), "left")
        text_col, min_chars = self.text_col, self.min_chars

        def drop(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches(frames):
                texts, lines_of, dropped = [], [], []
                for text, lost in zip(pdf[text_col], pdf["__keys"]):
                    if lost is None:
                        texts.append(text or "")
                        lines_of.append(1 + texts[-1].count("\n"))
                        dropped.append(0)
                        continue
                    pairs = np.asarray([(k["hi"], k["lo"]) for k in lost], dtype="<i8")
                    gone = {row.tobytes() for row in pairs}
                    lines, keys = line_keys(text, min_chars)
                    kept = [line for line, key in zip(lines, keys) if key is None or key not in gone]
                    texts.append("\n".join(kept))
                    lines_of.append(len(lines))
                    dropped.append(len(lines) - len(kept))
                yield pdf[own].assign(**{text_col: texts, "n_lines": lines_of, "n_dropped": dropped})

        fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
        return joined.select(*own, "__keys").mapInPandas(drop, f"{fields}, n_lines long, n_dropped long")


_FILTERS = "shard int, keys long, slots binary"


def new_index(spark: SparkSession, path: str, **options) -> LineIndex:
    """An empty index in folder ``path``, which must not hold one."""
    return LineIndex(spark, path, **options)


def op13_cuckoo_lines(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = new_index(spark, scratch_path(spark, "line_index")).insert(docs)
    return index.clean(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP13_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
l as (select r, doc_id, unnest(string_split(text, chr(10))) as line,
        unnest(generate_series(1, len(string_split(text, chr(10))))) as i from d),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, min(doc_id) as keeper from k where length(key) >= 10 group by key),
j as (select r, doc_id, line, i, f.keeper is not null and doc_id is distinct from f.keeper as dropped
      from k left join f on f.key = k.key and length(k.key) >= 10)
select any_value(doc_id) as doc_id, count(*)::bigint as n_lines, count(*) filter (dropped)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
from j group by r
"""
