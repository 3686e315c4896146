"""Metric reports as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.operators.score import METRICS

METRICS_SCHEMA = (
    "accuracy double, perplexity double, perplexity_no_punctuation double, vocabulary_size bigint"
)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON object with the four metrics of the final model."""
    metrics.select(*METRICS).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def write_funnel(funnel: DataFrame, path: str) -> None:
    """One JSON line per cleaning stage, in their order."""
    funnel.coalesce(1).write.mode("overwrite").json(path)


def write_comparison(comparison: DataFrame, path: str) -> None:
    """One JSON object keyed `n=<n>`; it has one entry per order tried."""
    entry = F.struct(F.concat(F.lit("n="), F.col("n")).alias("key"), F.struct(*METRICS).alias("value"))
    by_n = F.map_from_entries(F.transform(
        F.array_sort(F.collect_list(F.struct("n", entry.alias("entry")))), lambda row: row["entry"]
    ))
    comparison.agg(F.to_json(by_n).alias("value")).write.mode("overwrite").text(path)


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    parsed = F.from_json("value", f"map<string, struct<{METRICS_SCHEMA.replace(' ', ':').replace(',:', ',')}>>")
    return (
        spark.read.text(path)
        .select(F.explode(parsed).alias("key", "metrics"))
        .select(F.regexp_extract("key", r"^n=(\d+)$", 1).cast("int").alias("n"), "metrics.*")
    )
