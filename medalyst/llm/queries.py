"""One query for each operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from medalyst.llm import (bond, bpe, decontaminate, edit_fingerprint, html_mincut, neardup, oracle, periodic_runs, pii_crf, quality_cnn, quality_rules, rans,
                          secrets, sharding)
from medalyst.session import durable

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    both = bpe.decode(ids, path, public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = rans.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii_crf.report(docs, pii_crf.learn(docs))


def op6_longest_first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_minimum_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_mincut.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


def op9_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.near_groups(durable(edit_fingerprint.edited_copies(read(spark, sf_dir, "documents"))))


def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return secrets.report(secrets.judged(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return bond.mine(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(read(spark, sf_dir, "documents"), periodic_runs.repeated_tail)


def op13_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(read(spark, sf_dir, "documents")).drop("longest_repeat", "n_maximal")


QUERIES: dict[str, Query] = {
    "op1_quality_network": op1_quality_network,
    "op2_benchmark_leaks": op2_benchmark_leaks,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_files": op4_token_files,
    "op5_personal_data": op5_personal_data,
    "op6_longest_first_shards": op6_longest_first_shards,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_minimum_cut_text": op8_minimum_cut_text,
    "op9_edit_fingerprint": op9_edit_fingerprint,
    "op10_secret_ownership": op10_secret_ownership,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_repetition_rules": op13_repetition_rules,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op7_near_duplicates": oracle.NEAR_DUPLICATES,
    "op10_secret_ownership": oracle.secret_ownership(),
    "op11_hard_negatives": oracle.HARD_NEGATIVES,
    "op13_repetition_rules": oracle.REPETITION_RULES,
}
