"""A corpus from documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lanewarden.llm import decontaminate, near_dedup, packing, quality, secrets
from lanewarden.llm.queries import tokenizer_path
from lanewarden.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_fluent(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text stays within their language's bound."""
    return quality.accept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return near_dedup.keep_one(docs)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; those with one go whole."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 4096 tokens."""
    return packing.pack(packing.tokenize(docs, tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_fluent),
    ("near-duplicates", keep_distinct),
    ("decontamination", keep_unseen),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: No SQL: tokens, perplexities and components are beyond it. The stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each stage's rows written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
