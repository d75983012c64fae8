"""The registered queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewarden.llm import (
    decontaminate, language, licenses, near_dedup, packing, phrases, quality, repeats, secrets, toxicity, vectors, warc,
    whitening,
)
from lanewarden.llm.oracle import ORACLE

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file, which every worker has at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.tokenize(_table(spark, sf_dir, "documents"), tokenizer_path()))


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query
def op2_quality_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.perplexities(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id", "lang"])


@_query
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents"), ["doc_id"]))


@_query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), ["doc_id"], n=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


@_query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.find_licenses(_table(spark, sf_dir, "documents"), ["doc_id"]))


@_query
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


@_query
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_windows(docs, benchmark, ["doc_id"]))


@_query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), longest=3, least=10, covered=50, top=2000)


@_query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs, language.train(docs), ["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@_query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(_table(spark, sf_dir, "embeddings"), keep=["vec_id"], most=16)
    return whitening.by_component(whitened, ["vec_id"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
