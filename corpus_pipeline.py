"""Corpus pipeline: quality rules, exact dedup, near duplicates, mixing and packing over `documents`.

Each stage gets what its predecessor kept, read again from Parquet. The first three return the rows they keep, as they are; mixing keeps all rows
and puts them in the order of the schedule; files read again come in any order, so packing works the schedule out once more and numbers its
sequences by range of slots; it returns one row per piece of a document.
Null and empty texts fail the quality rules; later stages would treat them as the operators say. An empty table passes through as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockflow.llm import exact_dedup, mixing, ngram_join, packing, quality
from dockflow.llm.common import documents, staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(mixing.mix(docs), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has no tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
