"""The three jobs of a full run, from files to files: harvest, clean, model.

Each leaves its outputs only.  Given `run_folder` on shared storage, a job that failed can be started
again with the same inputs and settings and goes on from the tables that it had written there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.operators import choose, clean, harvest
from gramloom.operators.corpus import DEFAULT_TEST_SIZE
from gramloom.operators.fit import DEFAULT_SMOOTHING
from gramloom.plans.scratch import scratch_run
from gramloom.sources import files, models, reports


def harvest_methods(
    spark: SparkSession,
    repositories_csv: str,
    snapshots: DataFrame,
    output: str,
    limit: int | None = None,
    file_format: str = "csv",
    run_folder: str | None = None,
) -> None:
    """Methods of the listed Java repositories as CSV or Parquet: all, or the first `limit` of them."""
    with scratch_run(spark, run_folder):
        listed = harvest.java_repositories(files.read_repository_list(spark, repositories_csv))
        sources = harvest.java_files(harvest.repository_files(listed, snapshots))
        methods = harvest.extract_methods(sources)
        if limit is not None:
            methods = harvest.cap_methods(methods, limit)
        files.write_extracted(harvest.with_provenance(methods), output, file_format)


def clean_methods(
    spark: SparkSession,
    source: str,
    output: str,
    funnel_json: str | None = None,
    source_format: str = "csv",
    file_format: str = "csv",
    run_folder: str | None = None,
) -> None:
    """Any methods file to a processed one with cleaned code alone and, given a path, the rows each stage removed."""
    with scratch_run(spark, run_folder):
        methods = files.read_methods(spark, source, source_format)
        files.write_processed(clean.clean_methods(methods), output, file_format)
        if funnel_json is not None:
            reports.write_funnel(clean.cleaning_funnel(methods), funnel_json)


def model_methods(
    spark: SparkSession,
    processed_file: str | None = None,
    training_txt: str | None = None,
    output_dir: str = "./results",
    min_n: int = choose.DEFAULT_MIN_N,
    max_n: int = choose.DEFAULT_MAX_N,
    smoothing_k: float = DEFAULT_SMOOTHING,
    quick: bool = False,
    test_size: float = DEFAULT_TEST_SIZE,
    exact: bool = False,
    file_format: str = "csv",
    run_folder: str | None = None,
) -> choose.RunResult:
    """Select, train, test and save, from a processed file or a text file with one method per line.

    What is returned reads the saved reports and the saved model.
    """
    if (processed_file is None) == (training_txt is None):
        raise ValueError("give either processed_file or training_txt")
    with scratch_run(spark, run_folder):
        if training_txt is not None:
            methods = files.read_text_methods(spark, training_txt)
        else:
            methods = files.read_processed(spark, processed_file, file_format=file_format)
        best_n = choose.train_and_test(
            methods, output_dir, min_n, max_n, smoothing_k, quick, test_size=test_size, exact=exact
        ).best_n
    comparison = reports.read_comparison(spark, f"{output_dir}/metrics_compare.json")
    metrics = reports.read_metrics(spark, f"{output_dir}/metrics.json").withColumn("n", F.lit(best_n))
    model = models.load_model(spark, f"{output_dir}/{models.DEFAULT_NAME}")
    return choose.RunResult(best_n, comparison, model, metrics)
