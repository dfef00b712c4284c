"""Training-corpus pipeline: each stage takes the documents that its predecessor kept.

All stages but the last return the columns of ``documents``; the last returns one row of token ids for each document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalyst.llm import bpe, decontaminate, neardup, quality_cnn, secrets
from medalyst.session import durable


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network rejects go."""
    return quality_cnn.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id."""
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked in the text; ``n_chars`` follows."""
    masked = secrets.redact(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the hash of the bytes that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [("quality classifier", quality), ("near-duplicates", near_duplicates), ("benchmark decontamination", decontamination),
          ("secret scan", secret_scan), ("byte-level tokens", tokens)]
ORACLE_SQL = None       # SQL can't train a network, so the stages are tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder before the next reads them."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = durable(docs)
    return docs
