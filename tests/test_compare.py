import os
import random

import pytest
from brute_force import Model
from pyspark.sql import functions as F

from gramloom.operators import compare, fit, score
from gramloom.plans import scratch


def corpus(seed, size):
    random.seed(seed)
    words = ["a", "b", ";", "(", "x\x1fy", "<END>", "<START>", "w" + str(seed)]
    return [random.choices(words, weights=[9, 6, 9, 4, 2, 1, 1, 1], k=random.randint(1, 10)) for _ in range(size)]


@pytest.mark.parametrize("n_values", [[1], [3], [2, 3, 4, 5, 6, 7], [1, 4], [2, 5]])
def test_counts_and_best_targets_equal_each_model_alone(methods, n_values):
    data = corpus(21, 40)
    models = compare.fit_orders(methods(data), n_values)
    ngrams, contexts = models.ngrams.collect(), models.contexts.collect()
    for n in n_values:
        expected = Model(data, n)
        assert (models.vocab_size, models.positions) == (len(expected.words), sum(len(m) + 1 for m in data))
        alone = fit.fit(methods(data), n)
        assert {(r.m, r.ctx, r.target): r[f"c_{n}"] for r in ngrams if r[f"c_{n}"] is not None} == {
            (r.m, r.ctx, r.target): r.c for r in alone.ngrams.collect()
        }
        assert {(r.m, r.ctx): r[f"cc_{n}"] for r in contexts if r[f"cc_{n}"] is not None} == {
            (r.m, r.ctx): r.cc for r in alone.contexts.collect()
        }
        first = {(r.ctx, r.first_seen): r.target for r in ngrams if r.m == n - 1}
        together = {r.ctx: first[(r.ctx, r.best)] for r in contexts if r.m == n - 1}
        best = fit.best_targets(alone.ngrams, alone.contexts.filter(f"m = {n - 1}"))
        assert together == {r.ctx: r.pred for r in best.collect()}


@pytest.mark.parametrize("n_values", [[2, 3, 4, 5, 6, 7], [1, 3]])
def test_metrics_equal_brute_force(methods, n_values):
    train, test = corpus(31, 40), corpus(32, 12)
    models = compare.fit_orders(methods(train), n_values, smoothing_k=0.05)
    rows = compare.evaluate_orders(models, methods(test)).orderBy("n").collect()
    assert [r.n for r in rows] == n_values
    for row in rows:
        metrics = row.asDict()
        assert Model(train, metrics.pop("n"), k=0.05).metrics(test) == pytest.approx(metrics)


def test_same_as_scoring_models_with_n_as_a_key(methods):
    train, test = methods(corpus(41, 30)), methods(corpus(42, 10))
    together = compare.evaluate_orders(compare.fit_orders(train, [2, 4]), test).orderBy("n").collect()
    keyed = score.evaluate(fit.fit(train, [2, 4]), test).orderBy("n").collect()
    for a, b in zip(together, keyed, strict=True):
        assert a.asDict() == pytest.approx(b.asDict())


def test_edges(methods):
    train = methods([["a", "b"]])
    rows = compare.evaluate_orders(compare.fit_orders(train, [2, 3]), train.limit(0)).collect()
    assert [(r.accuracy, r.perplexity) for r in rows] == [(0.0, float("inf"))] * 2
    with pytest.raises(ValueError):
        compare.fit_orders(train.limit(0), [2])
    with pytest.raises(ValueError):
        compare.fit_orders(train, [0, 1])


def test_counting_and_contexts_stay_in_hash_aggregation(methods):
    models = compare.fit_orders(methods([["a", "b"]]), [2, 3])
    for frame in (compare.order_counts(methods([["a", "b"]]), [2, 3]), compare._order_contexts(models.ngrams, [2, 3])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_orders_are_counted_in_parts(monkeypatch, spark, methods):
    """No part deals out much more than the longest windows, and the windows go when the parts are counted."""
    for longest in range(1, 12):
        parts = compare._parts(longest)
        assert [k for part in parts for k in part] == list(range(1, longest + 1)) and parts[0] == [1]
        assert max(map(sum, parts)) <= longest + 2
    written = []

    def counting(frame, name):
        table = scratch.write_table(frame, name)
        written.append((name, table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")))
        return table

    monkeypatch.setattr(compare, "write_table", counting)
    models = compare.fit_orders(methods(corpus(51, 30)), [2, 4, 7])
    names = [name for name, _ in written]
    assert names[-11:] == ["order-windows"] + ["order-ngrams"] * 5 + ["order-contexts"] * 5
    assert [name for name, path in written if not os.path.exists(path)] == ["order-windows"]
    plan = models.ngrams.join(models.ngrams.select("gram", F.col("m").alias("o")), "gram")._jdf.queryExecution().executedPlan()
    assert "hashpartitioning" not in plan.toString()


def test_empty_tokens_are_no_empty_contexts(methods):
    data = methods([["", "a", ""], ["a", ""], [""]])
    contexts = compare.fit_orders(data, [1, 2, 3]).contexts.collect()
    for n in (1, 2, 3):
        alone = {(r.m, r.ctx): r.cc for r in fit.fit(data, n).contexts.collect()}
        assert {(r.m, r.ctx): r[f"cc_{n}"] for r in contexts if r[f"cc_{n}"] is not None} == alone
