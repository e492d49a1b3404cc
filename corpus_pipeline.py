"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

All stages but the last return the columns they were given. Rows of any stage with null or empty texts, repeated rows
and tables without rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import bpe, minhash, mixing, pii, toxicity
from dimflow.llm.common import load, small_batches, stored
from dimflow.llm.queries import TOXIC

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not count as toxic; learned from these documents and the labels."""
    small_batches(spark)
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__score")
    return scored.filter(F.col("__score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id; rows that repeat an id are one document."""
    small_batches(spark)
    found = stored(minhash.near_duplicates(docs), "near-duplicates")
    by_id = found.filter("doc_id is not null").groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    marked = stored(by_id.filter("not kept or n > 1").select(F.col("doc_id").alias("__id"), "kept"), "duplicates")
    single = docs.join(marked, F.col("doc_id") == F.col("__id"), "left_anti")
    repeated = docs.join(marked.filter("kept"), F.col("doc_id") == F.col("__id"), "left_semi")
    row = F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("row")
    return single.unionByName(repeated.groupBy("doc_id").agg(row).select("row.*"))


def remove_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced in their texts; ``n_chars`` follows the text."""
    small_batches(spark)
    clean = pii.redact(pii.detect(docs, spans="__spans", extra="__terms"), spans="__spans", extra="__terms")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat(mixing.mix(docs, prefix="__")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their texts."""
    small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("pii", remove_private_data),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: A trained classifier and byte-level encoding are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
