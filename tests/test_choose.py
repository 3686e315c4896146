import json
import random

import pytest
from brute_force import Model

from gramloom.operators import choose, corpus

METRICS = "n int, accuracy double, perplexity double, perplexity_no_punctuation double, vocabulary_size bigint"


def test_best_order(frame):
    inf = float("inf")
    rows = [(4, 0.9, 5.0, 1.0, 9), (2, 0.1, 5.0, 1.0, 9), (3, 0.5, 6.0, 1.0, 9), (7, 0.5, inf, 1.0, 9)]
    assert choose.best_order(frame(rows, METRICS)).head().n == 2
    assert choose.best_order(frame([(2, 0.0, inf, inf, 9)], METRICS)).head() is None


def test_orders_are_checked():
    assert list(choose.orders(2, 8)) == [2, 3, 4, 5, 6, 7]
    for low, high in ((3, 3), (4, 2)):
        with pytest.raises(ValueError):
            choose.orders(low, high)


@pytest.fixture
def tokenised(methods):
    random.seed(8)
    statements = [["int", "a", "=", "1", ";"], ["f", "(", "a", ")", ";"], ["return", "a", ";"]]
    return methods([sum(random.choices(statements, k=random.randint(1, 4)), []) for _ in range(300)])


@pytest.mark.parametrize("quick", [False, True])
def test_run(spark, tokenised, tmp_path, quick):
    result = choose.train_and_test(tokenised, str(tmp_path), min_n=1, max_n=4, quick=quick)
    rows = {r.method_id: (r.split, r.tokens) for r in corpus.split_methods(tokenised).collect()}
    train_val = [t for _, (s, t) in sorted(rows.items()) if s != "test"]
    test = [t for _, (s, t) in rows.items() if s == "test"]
    comparison = {r.n: r.perplexity for r in result.comparison.collect()}
    assert set(comparison) == {1, 2, 3} and result.best_n == min(comparison, key=lambda n: (comparison[n], n))
    metrics = result.metrics.head().asDict()
    assert metrics.pop("n") == result.best_n
    assert metrics == pytest.approx(Model(train_val, result.best_n).metrics(test))
    assert json.loads(spark.read.text(str(tmp_path / "metrics.json")).head()[0])["vocabulary_size"] == metrics["vocabulary_size"]
    assert set(json.loads(spark.read.text(str(tmp_path / "metrics_compare.json")).head()[0])) == {"n=1", "n=2", "n=3"}


def test_comparison_equals_brute_force(tokenised):
    split = corpus.split_methods(tokenised)
    rows = split.orderBy("method_id").collect()
    train = [r.tokens for r in rows if r.split == "train"]
    validation = [r.tokens for r in rows if r.split == "val"]
    compared = choose.compare_orders(split.filter("split = 'train'"), split.filter("split = 'val'"), 2, 5)
    for row in compared.collect():
        metrics = row.asDict()
        assert Model(train, metrics.pop("n")).metrics(validation) == pytest.approx(metrics)
