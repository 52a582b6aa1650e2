"""The corpus pipeline: quality rules, near duplicates, secrets, source mix, tokens. Each stage works on all that its predecessor kept."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from creditecho.llm import byte_bpe, jaccard_join, mixing, quality_rules, secret_scan
from creditecho.llm.queries import VOCABULARY
from creditecho.llm.store import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the rules or the calibrated model reject."""
    return quality_rules.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least doc_id of each class of near duplicates."""
    return jaccard_join.one_per_class(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays."""
    return secret_scan.masked_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as often as the mix does."""
    return mixing.mixed_documents(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token ids and the bytes decoded from them."""
    return byte_bpe.encode(docs, public_tokenizers.path(VOCABULARY), round_trip=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_quality),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("byte_bpe", tokenise),
]

ORACLE_SQL = None  # the first stage is a trained model, the last a tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
