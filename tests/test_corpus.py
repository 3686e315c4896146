import math

import pytest
from pyspark.sql import functions as F

from gramloom.operators import corpus


def test_empty_methods_are_dropped(frame):
    raw = frame([(0, None), (1, " "), (2, "// c"), (3, "a b")], "method_id bigint, code string")
    assert [(r.method_id, r.tokens) for r in corpus.tokenize_methods(raw).collect()] == [(3, ["a", "b"])]


def test_each_text_is_lexed_once(spark, frame):
    raw = frame([(3, "a b")], "method_id bigint, code string")
    plan = corpus.tokenize_methods(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-*(0123456789)").startswith("Filter")]
    assert filters and not any("regexp_extract_all" in line for line in filters)


def test_split_is_stable_and_about_80_10_10(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "method_id")
    first = {r.method_id: r.split for r in corpus.split_methods(ids).collect()}
    again = {r.method_id: r.split for r in corpus.split_methods(ids.repartition(7)).collect()}
    assert first == again
    shares = [sum(s == name for s in first.values()) / 20_000 for name in ("train", "val", "test")]
    assert shares == pytest.approx([0.8, 0.1, 0.1], abs=0.01)
    assert {r.split for r in corpus.split_methods(ids, seed=1).collect()} == {"train", "val", "test"}
    assert corpus.training_and_validation(corpus.split_methods(ids)).filter("split = 'test'").isEmpty()


@pytest.mark.parametrize("rows", [0, 1, 2, 5, 9, 10, 11, 123, 1000])
def test_exact_split_sizes(spark, rows):
    ids = spark.range(rows).withColumnRenamed("id", "method_id")
    counts = {r.split: r["count"] for r in corpus.exact_split_methods(ids).groupBy("split").count().collect()}
    held_out = math.ceil(rows * 0.2)
    test = math.ceil(held_out * 0.5)
    expected = {"train": rows - held_out, "val": held_out - test, "test": test}
    assert counts == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("test_size", [0.3, 0.5, 0.05])
def test_split_shares(spark, test_size):
    ids = spark.range(20_000).withColumnRenamed("id", "method_id")
    counts = {r.split: r["count"] for r in corpus.split_methods(ids, test_size=test_size).groupBy("split").count().collect()}
    shares = [counts[name] / 20_000 for name in ("train", "val", "test")]
    assert shares == pytest.approx([1 - test_size, test_size / 2, test_size / 2], abs=0.01)


@pytest.mark.parametrize("test_size", [0, 1, -0.1])
def test_split_share_is_checked(spark, test_size):
    ids = spark.range(3).withColumnRenamed("id", "method_id")
    for split in (lambda: corpus.split_methods(ids, test_size=test_size), lambda: corpus.exact_split_methods(ids, test_size)):
        with pytest.raises(ValueError):
            split()


def test_exact_split_ranks_across_many_prefixes(spark):
    ids = spark.range(3000).withColumnRenamed("id", "method_id")
    rows = corpus.exact_split_methods(ids).withColumn("k", corpus.sample_key(F.col("method_id"), 42)).collect()
    ordered = [r.split for r in sorted(rows, key=lambda r: (r.k, r.method_id))]
    assert ordered == ["train"] * 2400 + ["val"] * 300 + ["test"] * 300


def test_quick_sample(spark):
    ids = spark.range(5000).withColumnRenamed("id", "method_id")
    sample = corpus.quick_sample(ids, size=1000)
    assert sample.count() == 1000
    test_ids = corpus.split_methods(ids).filter("split = 'test'").select("method_id")
    assert sample.join(test_ids, "method_id").isEmpty()
    everything = corpus.quick_sample(ids, size=1000, include_test=True)
    assert everything.count() == 1000 and not everything.join(test_ids, "method_id").isEmpty()
    keyed = ids.withColumn("k", corpus.sample_key(F.col("method_id"), 42))
    lowest = {r.method_id for r in keyed.orderBy("k", "method_id").limit(1000).collect()}
    assert {r.method_id for r in everything.collect()} == lowest
    assert corpus.quick_sample(spark.range(3).withColumnRenamed("id", "method_id"), include_test=True).count() == 3
