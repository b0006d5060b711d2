"""Registered queries of the operators, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import (
    chunk_dedup, exact_dedup, filter_audit, mixing, ngram_join, oracles, packing, pii, quality, resharding, secrets, suffix_dedup, token_counts, whitening,
)
from dockflow.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_mix_sources": oracles.MIX,
    "op4_ngram_join": oracles.NEAR,
    "op6_suffix_dedup": oracles.SUFFIXES,
    "op8_quality_ledger": oracles.QUALITY,
    "op10_exact_dedup": oracles.EXACT,
    "op11_reshard": oracles.RESHARD,
    "op12_filter_audit": oracles.AUDIT,
}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_schedule(documents(spark, sf_dir))


@query
def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(documents(spark, sf_dir))
    base = quality.passes(quality.POLICIES[0])
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~base).alias("base_failed"), quality.passes(quality.CURRENT).alias("kept"), "failed_bits")


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_ledger(documents(spark, sf_dir))


@query
def op7_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_private(documents(spark, sf_dir)))


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(documents(spark, sf_dir)))


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_join(documents(spark, sf_dir))


@query
def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.dedup_chunks(documents(spark, sf_dir))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard_documents(documents(spark, sf_dir))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
