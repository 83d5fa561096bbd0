"""From raw documents to tokens: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadpipe.llm import bpe, credentials, decontaminate, langid, neardup
from leadpipe.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The stages learn, compare and count over all the documents they get, so SQL cannot express them.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressors of the labelled ones tell; the rest goes."""
    return langid.keep_known(docs, langid.learn(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets replaced and the number of characters set to the new one."""
    return credentials.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its tokens, how many, and whether they decode to its text."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    kept = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    decoded = bpe.decode(bpe.encode(kept, ranks, pattern), ranks, pattern)
    return decoded.select(
        "doc_id", "n_tokens", "tokens", (F.sha2("decoded", 256) == F.col("text_sha256")).alias("decodes")
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
