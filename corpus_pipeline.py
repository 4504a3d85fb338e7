"""Cleaning a corpus end to end: toxic documents go, one document of each group
of near-duplicates stays, repeated passages are cut, personal data is masked,
and what is left is packed into training sequences.

Every stage reads what the one before wrote (Parquet in the shared folder), so
a lost executor repeats part of one stage at most. All stages but the last
return the columns of ``documents``. Documents without text pass the filters
and are packed as a lone separator. Rows with equal id and equal text are one
document from the near-duplicate stage on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import bpe, lsh_forest, packing, pii, substring, toxicity
from lamina.llm.common import small_batches, stage, table

# No SQL oracle: a learned score, MinHash candidates and tokens are beyond SQL.
# tests/llm checks the stages against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out="__toxic").filter(F.col("__toxic") < 0.5).drop("__toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group (5-word shingles, similarity 0.8)."""
    return lsh_forest.keep_one(docs, lsh_forest.Forest())


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    passages = substring.repeated_passages(docs)
    return substring.remove_passages(docs, passages, count_col="n_chars" if "n_chars" in docs.columns else None)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.find_spans(docs, pii.learn(docs), base="__base_spans", added="__added_spans")
    spans = F.array_sort(F.concat("__base_spans", "__added_spans"))
    masked = found.withColumn("text", F.when(F.size(spans) > 0, pii.redact(F.col("text"), spans)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long"))
                                   .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spec = bpe.read_tokenizer(bpe.default_tokenizer())
    return packing.pack(packing.token_pieces(docs, spec))


def in_small_batches(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``step``, whose result may be computed later, with Arrow batches of bounded size."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return step(spark, docs, sf_dir)

    return run_step


STAGES = [(name, in_small_batches(step)) for name, step in (
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
