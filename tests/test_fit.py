import random

import pytest
from brute_force import Model
from pyspark.sql import functions as F

from gramloom.operators import corpus as corpora
from gramloom.operators import fit
from gramloom.plans import scratch

S, E = "<START>", "<END>"
GOLDEN = [["a", "b", "a"], ["a", "c"]]


def counts(model):
    return {
        (r.n, r.m, tuple(r.ctx.split("\x1f")) if r.m else (), r.target): r.c for r in model.ngrams.collect()
    }


def test_worked_example(methods):
    model = fit.fit(methods(GOLDEN), 3)
    expected = {
        ((), S): 4, ((), "a"): 2, ((), "b"): 1,
        ((S,), S): 2, ((S,), "a"): 2, (("a",), "b"): 1, (("a",), "c"): 1, (("b",), "a"): 1,
        ((S, S), "a"): 2, ((S, "a"), "b"): 1, ((S, "a"), "c"): 1, (("a", "b"), "a"): 1,
        (("a", "c"), E): 1, (("b", "a"), E): 1,
    }
    assert counts(model) == {(3, len(ctx), ctx, t): c for (ctx, t), c in expected.items()}
    assert (model.vocab_size, model.positions) == (5, 7)
    contexts = {(r.m, r.ctx): (r.cc, r.pred) for r in fit.best_targets(model.ngrams, model.contexts).collect()}
    assert contexts[(2, f"{S}\x1fa")] == (2, "b")
    assert contexts[(0, "")] == (7, S)


def corpus(seed, size=40):
    random.seed(seed)
    return [random.choices(["a", "b", "c", ";", "(", "x\x1fy", "<END>"], k=random.randint(1, 9)) for _ in range(size)]


@pytest.mark.parametrize("n", [1, 2, 4])
def test_counts_equal_brute_force(methods, n):
    data = corpus(n)
    model = fit.fit(methods(data), n)
    expected = Model(data, n)
    got = {}
    for r in model.ngrams.collect():
        got.setdefault((r.m, r.ctx), {})[r.target] = r.c

    def key(context):
        return "\x1f".join(t.replace("\x1f", "\x1es") for t in context)

    assert got == {
        (len(c), key(c)): {t.replace("\x1f", "\x1es"): v for t, v in after.items()} for c, after in expected.after.items()
    }
    best = {(r.m, r.ctx): r.pred for r in fit.best_targets(model.ngrams, model.contexts).collect()}
    assert best == {(len(c), key(c)): expected.best(c).replace("\x1f", "\x1es") for c in expected.after}
    assert model.vocab_size == len(expected.words)


def test_several_orders_together_equal_each_alone(methods):
    data = methods(corpus(5))
    together = counts(fit.fit(data, [2, 3, 5]))
    apart = {}
    for n in (2, 3, 5):
        apart |= counts(fit.fit(data, n))
    assert together == apart


def test_invariants(methods):
    data = corpus(9)
    model = fit.fit(methods(data), [1, 3])
    positions = sum(len(m) + 1 for m in data)
    assert model.positions == positions
    assert {r.total for r in model.ngrams.groupBy("n", "m").agg(F.sum("c").alias("total")).collect()} == {positions}
    sums = model.ngrams.groupBy("n", "m", "ctx").agg(F.sum("c").alias("s"))
    assert model.contexts.join(sums, ["n", "m", "ctx"]).filter("s <> cc").isEmpty()
    vocabulary = {r.token for r in fit.vocabulary(methods(data)).collect()}
    assert vocabulary == {r.token for r in model.vocabulary.collect()}


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_results_do_not_depend_on_partitions(spark, methods, partitions):
    data = corpus(11)
    expected = Model(data, 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        model = fit.fit(methods(data).repartition(5), 3)
        best = {r.ctx: r.pred for r in fit.best_targets(model.ngrams, model.contexts.filter("m = 1")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert best == {
        c[0].replace("\x1f", "\x1es"): expected.best(c).replace("\x1f", "\x1es") for c in expected.after if len(c) == 1
    }


def test_first_seen_holds_any_id(methods):
    big = 2**62
    placed = corpora.place_methods(methods([(big + 5, ["a"]), (-big, ["a", "b"]), (big, ["b", "c"])]))
    rows = corpora.first_positions(fit.window_counts(placed, 1), "first_seen", placed)
    assert {r.gram: (r.first_method, r.first_pos) for r in rows.collect()} == {
        "a": (-big, 0), "b": (-big, 1), E: (-big, 2), "c": (big, 1),
    }


def test_places_are_dense_and_follow_the_ids(spark, methods):
    data = [((i * 7919) % 1009 - 500, ["x"] * (i % 5 + 1)) for i in range(1009)]
    rows = corpora.place_methods(methods(data).repartition(7)).orderBy("method_id").collect()
    assert [r.place for r in rows] == [6 * i for i in range(1009)]  # five tokens and the end marker at most
    texts = spark.createDataFrame([(3, "a b"), (1, "// none"), (2, "c"), (0, None)], "method_id bigint, code string")
    assert [(r.method_id, r.place) for r in corpora.tokenize_placed(texts).orderBy("place").collect()] == [(2, 0), (3, 3)]


@pytest.mark.parametrize("offset", [0, 2**40, 2**62])
def test_best_target_for_any_id(methods, offset):
    data = corpus(13)
    model = fit.fit(methods([(offset + 3 * i, tokens) for i, tokens in enumerate(data)]), 3)
    expected = Model(data, 3)
    best = {(r.m, r.ctx): r.pred for r in fit.best_targets(model.ngrams, model.contexts).collect()}
    assert len(best) == len(expected.after)
    assert best[(0, "")] == expected.best(()) and best[(1, ";")] == expected.best((";",))


def test_best_target_of_huge_counts_stays_in_hash_aggregation(frame):
    schema = "n int, m int, ctx string, target string, c bigint, first_seen bigint"
    late, many = 2**63 - 1, 2**62
    rows = [(1, 0, "", "a", many, late), (1, 0, "", "b", many, late - 1), (1, 0, "", "c", 5, 0), (1, 0, "x", "d", 1, 0)]
    contexts = fit.context_counts(frame(rows, schema))
    assert {r.ctx: r.best for r in contexts.select("ctx", "best").filter("ctx = 'x'").collect()} == {"x": 0}
    best = frame(rows, schema).groupBy("ctx").agg(fit.best_first_seen(F.col("c"), F.col("first_seen")).alias("best"))
    assert {r.ctx: r.best for r in best.collect()} == {"": late - 1, "x": 0}
    assert "SortAggregate" not in best._jdf.queryExecution().executedPlan().toString()


def test_parameters_are_checked(methods):
    data = methods(GOLDEN)
    for bad in ({"n_values": 0}, {"n_values": []}, {"n_values": 2, "smoothing_k": -1.0}):
        with pytest.raises(ValueError):
            fit.fit(data, **bad)
    with pytest.raises(ValueError):
        fit.fit(data.limit(0), 2)


def test_counting_stays_in_hash_aggregation(methods):
    plan = fit.ngram_counts(methods(GOLDEN), [3])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Python" not in plan


def test_contexts_and_shorter_grams_come_from_one_aggregation(methods):
    """A level is counted once and read as grams and as contexts; contexts that are asked for counts alone carry no more."""
    data = methods(corpus(17))
    levels = fit.gram_levels(data, [2, 4])
    ngrams = levels.ngrams()
    apart = {tuple(r) for r in fit.context_counts(ngrams).collect()}
    assert {tuple(r) for r in fit.context_counts(levels).select("n", "m", "ctx", "cc", "best").collect()} == apart
    assert {tuple(r) for r in ngrams.collect()} == {tuple(r) for r in fit.fit(data, [2, 4]).ngrams.collect()}
    plan = fit.context_counts(fit.gram_levels(data, [3])).select("n", "m", "ctx", "cc")._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" not in plan and "max(" not in plan


def test_best_targets_are_named_by_place_alone(methods):
    """What is dealt out to name best targets holds no contexts."""
    model = fit.fit(methods(corpus(19)), 3)
    plan = fit.best_targets(model.ngrams, model.contexts)._jdf.queryExecution().optimizedPlan().toString()
    (keys,) = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "ctx" not in keys and "best" in keys


def test_first_methods_come_along_with_the_counts(methods):
    """Repeated and null ids too: the method is that of the lowest place, without a join."""
    placed = corpora.place_methods(methods([(5, ["a", "b"]), (None, ["b"]), (5, ["c", "a"]), (-1, ["c"])]))
    joined = corpora.first_positions(fit.ngram_counts(placed, [2]), "first_seen", placed)
    carried = corpora.first_positions(
        fit.ngram_counts(placed.withColumn(corpora.FIRST_METHOD, F.col("method_id")), [2]), "first_seen", placed
    )
    assert sorted(map(str, carried.collect())) == sorted(map(str, joined.select(carried.columns).collect()))

    def joins(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(carried) < joins(joined)


def test_counts_are_made_in_small_splits(spark, methods, monkeypatch):
    """Large splits fill the hash tables of map-side partial counts, which then spill to save next to nothing."""
    key = "spark.sql.files.maxPartitionBytes"
    seen = []

    def write(frame, name, row_group=None):
        seen.append((name, spark.conf.get(key), row_group))
        return scratch.write_table(frame, name, row_group)

    monkeypatch.setattr(fit, "write_table", write)
    before = spark.conf.get(key)
    fit.fit(methods([["a", "b", "a"], ["b"]]), 2)
    assert seen == [("ngrams", str(scratch.SPLIT), scratch.SPLIT), ("contexts", str(scratch.SPLIT), scratch.SPLIT)]
    assert spark.conf.get(key) == before
    # A size that the session names stays.
    spark.conf.set(key, "64m")
    try:
        fit.fit(methods([["a", "b", "a"], ["b"]]), 2)
        assert {size for _, size, _ in seen[2:]} == {"64m"} and spark.conf.get(key) == "64m"
    finally:
        spark.conf.unset(key)


def test_small_row_groups_let_tasks_be_smaller(spark):
    rows = spark.range(20_000).repartition(1).selectExpr("id", "sha2(string(id), 256) as text")
    table = scratch.write_table(rows, "small-groups", 1 << 17)
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, str(1 << 17))
    try:
        held = table.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset(key)
    assert sum(r["count"] for r in held) == 20_000 and len(held) > 1


def test_written_counts_equal_lazy_ones_and_need_no_shuffle_after(methods):
    data = methods(corpus(23))
    for n_values in ([1], [3], [2, 4]):
        lazy, written = fit.ngram_counts(data, n_values), fit.ngram_counts(data, n_values, fit.write_counts)
        assert sorted(map(str, lazy.collect())) == sorted(map(str, written.select(lazy.columns).collect()))
        plan = written._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "max(" not in plan
