"""Model selection: compare orders, keep the best, train and test it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.operators.compare import evaluate_orders, fit_orders
from gramloom.operators.corpus import (
    DEFAULT_SEED,
    DEFAULT_TEST_SIZE,
    TEST,
    TRAIN,
    VALIDATION,
    exact_split_methods,
    place_methods,
    quick_sample,
    split_methods,
    training_and_validation,
)
from gramloom.operators.fit import DEFAULT_LAMBDA, DEFAULT_SMOOTHING, NGramModel, fit
from gramloom.operators.score import METRICS, evaluate
from gramloom.plans.scratch import write_table
from gramloom.sources.models import save_model
from gramloom.sources.reports import write_comparison, write_metrics

DEFAULT_MIN_N = 2
DEFAULT_MAX_N = 8


@dataclass(frozen=True)
class RunResult:
    best_n: int
    comparison: DataFrame
    model: NGramModel
    metrics: DataFrame


def orders(min_n: int, max_n: int) -> range:
    """The orders to try, `max_n` excluded."""
    if max_n <= min_n:
        raise ValueError("max_n must be above min_n")
    return range(min_n, max_n)


def compare_orders(
    train: DataFrame,
    validation: DataFrame,
    min_n: int = DEFAULT_MIN_N,
    max_n: int = DEFAULT_MAX_N,
    smoothing_k: float = DEFAULT_SMOOTHING,
    lambda_factor: float = DEFAULT_LAMBDA,
) -> DataFrame:
    """Validation metrics of every order, all trained and scored together."""
    models = fit_orders(train, orders(min_n, max_n), smoothing_k, lambda_factor)
    return filter_comparison_metrics(evaluate_orders(models, validation))


def filter_comparison_metrics(metrics: DataFrame) -> DataFrame:
    """The four metrics kept for comparison."""
    return metrics.select("n", *METRICS)


def best_order(comparison: DataFrame) -> DataFrame:
    """The row of lowest perplexity; of equals, the smallest n."""
    finite = F.col("perplexity") < float("inf")
    return comparison.filter(finite).orderBy("perplexity", "n").limit(1)


def final_model(
    methods: DataFrame,
    n: int,
    smoothing_k: float = DEFAULT_SMOOTHING,
    lambda_factor: float = DEFAULT_LAMBDA,
) -> tuple[NGramModel, DataFrame]:
    """Train on train and validation, evaluate on test."""
    model = fit(training_and_validation(methods), n, smoothing_k, lambda_factor)
    return model, evaluate(model, methods.filter(F.col("split") == TEST))


def train_and_test(
    tokenised: DataFrame,
    output_dir: str | None = None,
    min_n: int = DEFAULT_MIN_N,
    max_n: int = DEFAULT_MAX_N,
    smoothing_k: float = DEFAULT_SMOOTHING,
    quick: bool = False,
    include_test: bool = False,
    seed: int = DEFAULT_SEED,
    test_size: float = DEFAULT_TEST_SIZE,
    exact: bool = False,
) -> RunResult:
    """Split, select n, retrain, test and, given a folder, save metrics and model.

    `quick` selects on a sample of 1,000 methods; the final model still uses
    all of them.  `exact` splits to exact sizes.  Only the chosen n passes through the driver.
    """
    orders(min_n, max_n)
    placed = tokenised if "place" in tokenised.columns else place_methods(write_table(tokenised, "tokenised"))
    if exact:
        methods = write_table(exact_split_methods(placed, test_size, seed), "methods")
    else:
        methods = split_methods(placed, seed, test_size)
    pool = methods
    if quick:
        pool = write_table(quick_sample(methods, seed=seed, include_test=include_test), "quick-sample")
    train, validation = (pool.filter(F.col("split") == split) for split in (TRAIN, VALIDATION))
    comparison = write_table(compare_orders(train, validation, min_n, max_n, smoothing_k), "comparison")
    best = best_order(comparison).head()
    if best is None:
        raise ValueError("no order could be evaluated: the validation set is empty")
    model, metrics = final_model(methods, best["n"], smoothing_k)
    metrics = write_table(metrics, "metrics")
    if output_dir is not None:
        write_comparison(comparison, f"{output_dir}/metrics_compare.json")
        write_metrics(metrics, f"{output_dir}/metrics.json")
        save_model(model, output_dir)
    return RunResult(best["n"], comparison, model, metrics)
