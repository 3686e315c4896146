import math
import os
import random
from dataclasses import replace

import pytest
from brute_force import Model
from pyspark.sql import functions as F

from gramloom.operators import fit, score
from gramloom.plans.scratch import scratch_root, write_table

GOLDEN = [["a", "b", "a"], ["a", "c"]]


def corpus(seed, size):
    random.seed(seed)
    words = ["a", "b", ";", "(", ")", "x\x1fy", "<END>", "rare" + str(seed)]
    return [random.choices(words, weights=[9, 6, 9, 4, 4, 2, 1, 1], k=random.randint(1, 12)) for _ in range(size)]


def one(metrics):
    return metrics.head().asDict()


def test_worked_example(methods):
    model = fit.fit(methods(GOLDEN), 3)
    rows = score.score_positions(model, methods([(9, ["a", "b", "c"])])).orderBy("pos").collect()
    assert [r.target for r in rows] == ["a", "b", "c", "<END>"]
    assert [r.pred for r in rows] == ["a", "b", "a", None]
    assert [r.p for r in rows] == pytest.approx(
        [0.711582263737531, 0.41217644006227294, 0.007160283687943261, 0.0014184397163120568]
    )
    metrics = one(score.evaluate(model, methods([["a", "b", "c"]])))
    assert metrics["accuracy"] == 0.5 and metrics["vocabulary_size"] == 5
    assert metrics["perplexity"] == pytest.approx(24.07064081161475)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_scores_equal_brute_force(methods, n):
    train, test = corpus(n, 30), corpus(n + 50, 8)
    expected = Model(train, n)
    model = fit.fit(methods(train), n)
    rows = score.score_positions(model, methods(test)).collect()
    got = {(r.method_id, r.pos): (r.p, r.pred, r.correct) for r in rows}
    for i, tokens in enumerate(test):
        for pos, context, target in expected.positions(tokens):
            p, pred, correct = got.pop((i, pos))
            assert p == pytest.approx(expected.p(context, target), rel=1e-12)
            best = expected.best(context)
            assert pred == best
            assert correct == (best == target)
    assert not got
    metrics = one(score.evaluate(model, methods(test)))
    metrics.pop("n")
    assert metrics == pytest.approx(expected.metrics(test))


def test_several_orders_in_one_job(methods):
    train, test = corpus(1, 30), corpus(2, 10)
    model = fit.fit(methods(train), [2, 3, 4])
    for row in score.evaluate(model, methods(test)).collect():
        metrics = row.asDict()
        n = metrics.pop("n")
        assert metrics == pytest.approx(Model(train, n).metrics(test))


def test_probabilities_and_predictions_of_any_context(frame, methods):
    train = corpus(3, 30)
    expected, model = Model(train, 3), fit.fit(methods(train), 3)
    random.seed(4)
    words = ["a", "b", ";", "zz", "<START>", "x\x1fy"]
    contexts = [random.choices(words, k=random.randint(0, 4)) for _ in range(60)] + [["zz", "zz"]] * 50
    queries = frame(
        [(i, c, random.choice(words)) for i, c in enumerate(contexts)], "id int, context array<string>, token string"
    )
    rows = score.probabilities(model, queries).collect()
    assert len(rows) == len(contexts)
    for r in rows:
        assert r.raw == pytest.approx(expected.raw(r.context, r.token))
        assert r.p == pytest.approx(expected.p(r.context, r.token))
    rows = score.predict_next(model, queries).collect()
    assert len(rows) == len(contexts)
    for r in rows:
        matched, pred, p = expected.predict(r.context[-2:])
        assert (r.matched, r.pred) == (matched, pred)
        assert r.p == pytest.approx(p)


def test_probabilities_sum_to_one(spark, methods):
    model = fit.fit(methods(GOLDEN), 3)
    for context in ([], ["a"], ["a", "b"], ["<START>", "a"], ["zz", "c"]):
        queries = model.vocabulary.select(
            F.array(*[F.lit(t) for t in context]).cast("array<string>").alias("context"), "token"
        )
        assert score.probabilities(model, queries).agg(F.sum("p")).head()[0] == pytest.approx(1.0)


def test_no_positions(methods):
    model = fit.fit(methods(GOLDEN), [2, 3])
    rows = score.evaluate(model, methods(GOLDEN).limit(0)).collect()
    assert [(r.accuracy, r.perplexity, r.perplexity_no_punctuation) for r in rows] == [(0.0, math.inf, math.inf)] * 2


def test_impossible_token_without_smoothing_is_an_error(methods):
    model = fit.fit(methods(GOLDEN), 2, smoothing_k=0.0)
    assert one(score.evaluate(model, methods([["a"]])).select("accuracy"))["accuracy"] >= 0
    with pytest.raises(Exception, match="impossible token"):
        score.evaluate(model, methods([["never"]])).collect()


def test_empty_model(frame, methods):
    trained = fit.fit(methods(GOLDEN), 2)
    queries = frame([(["a"], "b")], "context array<string>, token string")
    no_counts = replace(trained, ngrams=trained.ngrams.limit(0), contexts=trained.contexts.limit(0), positions=0)
    row = score.predict_next(no_counts, queries).head()
    assert row.pred in {"a", "b", "c", "<START>", "<END>"} and row.p == pytest.approx(1 / 5)
    nothing = replace(no_counts, vocabulary=trained.vocabulary.limit(0), vocab_size=0)
    assert score.predict_next(nothing, queries).select("pred", "p").head() == (None, None)
    assert score.probabilities(nothing, queries).head().p == 0.0


def test_metrics_report(frame):
    metrics = frame([(2, 0.12345, 9.87654, 1.0, 7)], "n int, accuracy double, perplexity double, perplexity_no_punctuation double, vocabulary_size bigint")
    assert tuple(score.metrics_report(metrics).head()) == (2, 0.123, 9.877, 1.0, 7)


def test_scoring_writes_few_tables_and_numbers_nothing(monkeypatch, frame, methods):
    written = []

    def counting(data, name, *row_group):
        written.append(name)
        return write_table(data, name, *row_group)

    for module in (fit, score):
        monkeypatch.setattr(module, "write_table", counting)
    data = methods(corpus(3, 12))
    model = fit.fit(data, 3)
    positions = score.score_positions(model, data)
    assert written == ["ngrams", "contexts", "scored-pairs", "answered-pairs"]
    del written[2:]
    asked = frame([(["a"],), (["b", "a"],)], "context array<string>")
    predictions = score.predict_next(model, asked)
    assert written == ["ngrams", "contexts", "matched-contexts", "answered-contexts"]
    for rows in (positions, predictions):
        assert "monotonically" not in rows._jdf.queryExecution().executedPlan().toString()


def test_a_trained_model_is_read_without_an_exchange(spark, methods):
    """Lookups in a model that was just trained deal out the questions only."""
    model = fit.fit(methods(corpus(6, 20)), 3)
    pairs = score.evaluation_pairs(methods(corpus(7, 5)), model)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = score.pair_probabilities(model, pairs)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    read_by = []

    def walk(node, above):
        name = node.nodeName()
        above = name if "Exchange" in name or "Join" in name else above
        if name.startswith("Scan parquet") and "Bucketed: true" in node.toString():
            read_by.append(above)
        for i in range(node.children().size()):
            walk(node.children().apply(i), above)

    walk(plan, "")
    # One scan of the contexts and one of each length of grams.
    assert read_by.count("SortMergeJoin") == 4 and set(read_by) <= {"SortMergeJoin", "BroadcastExchange"}, plan.toString()


def test_lookups_drop_what_they_wrote_between(spark, frame, methods):
    """What stays after scoring and prediction are the model and the answers."""
    data = methods(corpus(8, 12))
    folder = scratch_root(spark)
    model = fit.fit(data, 3)
    before = set(os.listdir(folder))
    score.score_positions(model, data)
    score.predict_next(model, frame([(["a"],), (["b", "a"],)], "context array<string>"))
    score.probabilities(model, frame([(["a"], "b")], "context array<string>, token string"))
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before)
    assert left == ["answered-contexts", "answered-pairs", "answered-pairs"]
    model.drop()
    assert len(before - set(os.listdir(folder))) == 2
