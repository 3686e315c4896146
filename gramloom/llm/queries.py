"""One query per operator of this folder, over its whole table, and the same rows in SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.llm import credentials, embeddings, licenses, lm, mix, negatives, pack, quality, repeats, shards, simhash, tokenfile, whitening
from gramloom.llm.common import documents
from gramloom.llm.oracle import CREDENTIALS, MIX, NEGATIVES, QUALITY

TOKENIZER = "word_bpe_49k.json"

Query = Callable[[SparkSession, str], DataFrame]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix.mix_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op2_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(documents(spark, sf_dir))


def op3_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.roundtrip(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op6_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", noisy), anchors=F.col("vec_id") % 100 == 0)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.scan(documents(spark, sf_dir)).drop("found")


def op13_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_shard_documents": op2_shard_documents,
    "op3_near_embeddings": op3_near_embeddings,
    "op4_license_scan": op4_license_scan,
    "op5_token_file": op5_token_file,
    "op6_pack_documents": op6_pack_documents,
    "op7_lm_scores": op7_lm_scores,
    "op8_simhash": op8_simhash,
    "op9_quality_rules": op9_quality_rules,
    "op10_repeated_strings": op10_repeated_strings,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_secret_scan": op12_secret_scan,
    "op13_whiten_embeddings": op13_whiten_embeddings,
}

ORACLE: dict[str, str] = {
    "op1_mix_sources": MIX,
    "op9_quality_rules": QUALITY,
    "op11_hard_negatives": NEGATIVES,
    "op12_secret_scan": CREDENTIALS,
}
