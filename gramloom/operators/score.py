"""Scoring: probabilities, predictions and metrics as lookup joins.

The probability of a target depends on its context only, so equal
(context, target) pairs are merged before any lookup.  Each pair asks for the
counts of all suffixes of its context; two lookups answer them, and the
answers are folded into one probability per pair by plain arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.functions.grams import (
    extended_key,
    gram_key,
    joinable,
    key_prefix,
    key_suffix,
    readable,
)
from gramloom.operators.fit import NGramModel, best_targets, windows
from gramloom.plans.lookup import frequent_keys, kept, lookup_join
from gramloom.plans.scratch import drop_tables, write_table

# Targets that count as punctuation.
PUNCTUATION = (
    "{", "}", "(", ")", "[", "]", ";", ",", ".", ":", "=", "+", "-", "*", "/", "%",
    "&", "|", "^", "!", "~", "<", ">", "?", "@",
)

# Fixed value: from this many occurrences on, a context needs no shorter one.
FULL_TRUST = 10.0

METRICS = ("accuracy", "perplexity", "perplexity_no_punctuation", "vocabulary_size")


def _for_every_n(model: Smoothing) -> Column:
    return F.explode(F.array(*[F.lit(n) for n in model.n_values])).alias("n")


def evaluation_pairs(methods: DataFrame, model: NGramModel) -> DataFrame:
    """Distinct (context, target) pairs of held-out methods: `n, length, ctx, target, cnt`."""
    grams = windows(methods.select("method_id", "tokens"), model.max_n)
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))
    pairs = counted.select(_for_every_n(model), "gram", "cnt").select(
        "n",
        (F.col("n") - 1).alias("length"),
        key_prefix(key_suffix(F.col("gram"), F.col("n")), F.col("n") - 1).alias("ctx"),
        key_suffix(F.col("gram"), F.lit(1)).alias("target"),
        "cnt",
    )
    if len(model.n_values) == 1:
        return pairs
    return pairs.groupBy("n", "length", "ctx", "target").agg(F.sum("cnt").alias("cnt"))


def _context_suffixes(asked: DataFrame) -> DataFrame:
    """One row per suffix of `ctx`, the empty one included: adds `m, suffix`."""
    suffixes = asked.select("*", F.explode(F.sequence(F.lit(0), F.col("length"))).alias("m"))
    return suffixes.withColumn("suffix", key_suffix(F.col("ctx"), F.col("m")))


# What a lookup asks for, first what the model's tables are bucketed by.
_CONTEXT_KEYS = ["suffix", "n", "m"]
_GRAM_KEYS = ["gram", "n", "m"]

Keep = Callable[[DataFrame, str], DataFrame]


class _Kept:
    """Tables between lookups, until `drop`."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def __call__(self, frame: DataFrame, name: str) -> DataFrame:
        self.tables.append(kept(frame, name))
        return self.tables[-1]

    def drop(self) -> None:
        drop_tables(*self.tables)
        self.tables.clear()


def _lazily(frame: DataFrame, name: str) -> DataFrame:
    return frame


def _names_best(model: NGramModel) -> bool:
    """Whether the contexts of a model name their best targets: those of a loaded one do."""
    return "pred" in model.contexts.columns


def _with_gram(asked: DataFrame) -> DataFrame:
    """Add `gram`, the key of the last `m` tokens of `ctx` and of `target`."""
    suffix = key_suffix(F.col("ctx"), F.col("m"))
    return asked.withColumn("gram", extended_key(suffix, F.col("m"), F.col("target")))


def _with_context(
    model: NGramModel, asked: DataFrame, values: list[str], spread_by: list[str], frequent: list[int]
) -> DataFrame:
    contexts = model.contexts.withColumnRenamed("ctx", "suffix")
    return lookup_join(
        asked, contexts, _CONTEXT_KEYS, values, F.col("cc"), model.positions, spread_by, frequent, "suffix"
    ).drop("suffix")


def _with_count(
    model: NGramModel, asked: DataFrame, values: list[str], spread_by: list[str], frequent: list[int]
) -> DataFrame:
    return lookup_join(
        _with_gram(asked), model.ngrams, _GRAM_KEYS, values, F.col("c"), model.positions, spread_by, frequent, "gram"
    ).drop("gram")


class Smoothing(Protocol):
    """What estimates and metrics need to know about a model."""

    n_values: tuple[int, ...]
    smoothing_k: float
    lambda_factor: float
    vocab_size: int


def raw_estimate(model: Smoothing, c: Column, cc: Column) -> Column:
    """Smoothed relative frequency within one context."""
    k = model.smoothing_k
    return (F.coalesce(c, F.lit(0)) + k) / (cc + k * model.vocab_size)


def counts_per_suffix(model: Smoothing) -> list[Column]:
    """Aggregates `c_<m>, cc_<m>` over the rows `m, c, cc` of one pair's suffixes."""
    return [
        F.max(F.when(F.col("m") == m, F.col(name))).alias(f"{name}_{m}")
        for m in range(max(model.n_values))
        for name in ("c", "cc")
    ]


def interpolate(model: Smoothing) -> Column:
    """Fold `c_<m>, cc_<m>` from the empty context to the longest one.

    A suffix that is no known context has weight zero, so each step uses the
    shorter estimate exactly once and the expression stays linear in n.
    """

    def step(shorter: Column, m: int) -> Column:
        c, cc = F.col(f"c_{m}"), F.col(f"cc_{m}")
        trust = F.least(F.lit(1.0), cc / FULL_TRUST)
        weight = model.lambda_factor + (1 - model.lambda_factor) * trust
        own = F.when(cc.isNull(), F.lit(0.0)).otherwise(weight * raw_estimate(model, c, cc))
        return own + F.when(cc.isNull(), F.lit(1.0)).otherwise(1 - weight) * shorter

    uniform = 1.0 / model.vocab_size if model.vocab_size else 0.0
    empty = F.when(F.col("cc_0").isNull(), F.lit(uniform)).otherwise(
        raw_estimate(model, F.col("c_0"), F.col("cc_0"))
    )
    return reduce(step, range(1, max(model.n_values)), empty)


def _scored(model: NGramModel, pairs: DataFrame, keep: Keep = _lazily) -> DataFrame:
    """Add `raw, p, best, correct` to distinct pairs `n, length, ctx, target, ...`.

    `raw` is the estimate of the full context alone, 0 for an unknown one; `p`
    the interpolated one; `best` names the full context's best target and
    `correct` says whether it is the pair's.  A pair is its own key on the way, so nothing is
    numbered or joined back to it.  With a loaded model `pred` is the best target itself.
    `keep` may write what a lookup answers.
    """
    place = ["ctx", "target"]
    # The model lies in buckets, which a join cannot split at run time, so keys frequent among the questions are counted before.
    pairs = kept(pairs, "asked-pairs")
    suffixes = _context_suffixes(pairs)
    often, often_counted = frequent_keys(_with_gram(suffixes), _CONTEXT_KEYS, _GRAM_KEYS)
    of_best = ["best", "pred"] if _names_best(model) else ["best"]
    known = _with_context(model, suffixes, ["cc", *of_best], place, often)
    # An unknown context has no counts to look up.  The empty one stays, so
    # that every pair keeps a row.
    known = keep(known.filter(F.col("cc").isNotNull() | (F.col("m") == 0)), "known-suffixes")
    if keep is not _lazily:
        drop_tables(pairs)
    answers = keep(_with_count(model, known, ["c", "first_seen"], place, often_counted), "counted-suffixes")
    if keep is not _lazily:
        drop_tables(known)
    full = F.col("m") == F.col("length")
    raw = F.when(F.col("cc_full").isNull(), F.lit(0.0)).otherwise(
        raw_estimate(model, F.col("c_full"), F.col("cc_full"))
    )
    # A pair's rows meet before they are widened to a column per suffix.
    return (
        answers.repartition(*place)
        .groupBy(*pairs.columns)
        .agg(
            *counts_per_suffix(model),
            F.max(F.when(full, F.col("c"))).alias("c_full"),
            F.max(F.when(full, F.col("cc"))).alias("cc_full"),
            *[F.max(F.when(full, F.col(name))).alias(name) for name in (*of_best, "first_seen")],
        )
        .select(
            *pairs.columns,
            raw.alias("raw"),
            interpolate(model).alias("p"),
            *of_best,
            F.coalesce(F.col("best") == F.col("first_seen"), F.lit(False)).alias("correct"),
        )
    )


def pair_probabilities(model: NGramModel, pairs: DataFrame, keep: Keep = _lazily) -> DataFrame:
    """Add `raw` and `p` to distinct pairs `n, length, ctx, target, ...`.

    With `keep=kept` each lookup is written, which bounds the disk taken.
    """
    return _scored(model, pairs, keep).drop("best", "pred", "correct")


def _answer_each(asked: DataFrame, answers: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Give questions the answers to their distinct keys, of which `asks` counts the questions.

    Questions of a frequent key are dealt out by all their columns.
    """
    total = answers.agg(F.sum("asks")).head()[0] or 0
    return lookup_join(asked, answers, keys, values, F.col("asks"), total, asked.columns)


def _keyed_contexts(model: NGramModel, queries: DataFrame) -> DataFrame:
    """Add `n, length, ctx, too_long` for every n of the model.

    A context longer than n - 1 was never counted; its last n - 1 tokens stand
    for it.
    """
    size = F.size("context")
    return queries.select("*", gram_key(joinable(F.col("context"))).alias("_key"), _for_every_n(model)).select(
        *queries.columns,
        "n",
        F.least(size, F.col("n") - 1).alias("length"),
        key_suffix(F.col("_key"), F.col("n") - 1).alias("ctx"),
        (size > F.col("n") - 1).alias("too_long"),
    )


def probabilities(model: NGramModel, queries: DataFrame) -> DataFrame:
    """Add `n, raw, p` to `context array<string>, token string`, for every n of the model."""
    keys = ["n", "length", "ctx", "target"]
    asked = _keyed_contexts(model, queries).withColumn("target", joinable(F.array("token"))[0])
    distinct = asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("asks"))
    between = _Kept()
    answers = write_table(pair_probabilities(model, distinct, between), "answered-pairs")
    between.drop()
    raw = F.when(F.col("too_long"), F.lit(0.0)).otherwise(F.col("raw"))
    return _answer_each(asked, answers, keys, ["raw", "p"]).select(
        *queries.columns, "n", raw.alias("raw"), "p"
    )


def _matched(model: NGramModel, distinct: DataFrame, keep: Keep) -> DataFrame:
    """Add `m, best` of the longest known suffix and `cc_0 ..`, the counts of all suffixes, to distinct contexts.

    With a loaded model `pred` comes along, the best target itself.
    """
    distinct = keep(distinct, "asked-contexts")
    suffixes = _context_suffixes(distinct)
    (often,) = frequent_keys(suffixes, _CONTEXT_KEYS)
    of_best = ["best", "pred"] if _names_best(model) else ["best"]
    known = keep(_with_context(model, suffixes, ["cc", *of_best], ["ctx"], often), "known-suffixes")
    drop_tables(distinct)
    lengths = range(model.max_n)
    return (
        known.repartition("ctx")
        .groupBy(*distinct.columns)
        .agg(
            F.max(F.when(F.col("best").isNotNull(), F.col("m"))).alias("m"),
            *[
                F.coalesce(*[F.max(F.when(F.col("m") == m, F.col(name))) for m in reversed(lengths)]).alias(name)
                for name in of_best
            ],
            *[F.max(F.when(F.col("m") == m, F.col("cc"))).alias(f"cc_{m}") for m in lengths],
        )
    )


def _named(model: NGramModel, matched: DataFrame, keep: Keep) -> DataFrame:
    """Add `pred`, the token behind `best`, to matched contexts; a loaded model has given it already."""
    if _names_best(model):
        return matched
    # A suffix that many contexts match is looked up once.
    suffixes = matched.groupBy("n", "m", F.col("suffix").alias("ctx"), "best").agg(F.count(F.lit(1)).alias("asks"))
    best = keep(best_targets(model.ngrams, suffixes).withColumnRenamed("ctx", "suffix"), "best-targets")
    return keep(lookup_join(matched, best, _CONTEXT_KEYS, ["pred"], F.col("asks"), matched.count(), ["ctx"]), "named-contexts")


def predict_next(model: NGramModel, contexts: DataFrame) -> DataFrame:
    """Add `n, matched, pred, p` to `context array<string>`, for every n of the model.

    The prediction is the best target of the longest suffix known as a
    context.  All longer suffixes are unknown, so the interpolated probability
    there is that of the whole context.  The counts of all suffixes come with the match;
    only those of the predicted target are looked up after it.  A model without counts falls back to
    one word of its vocabulary, without vocabulary to no prediction.
    """
    keys = ["n", "length", "ctx"]
    asked = _keyed_contexts(model, contexts).drop("too_long")
    distinct = asked.groupBy(*keys).agg(F.count(F.lit(1)).alias("asks"))
    between, named = _Kept(), _Kept()
    matched = write_table(
        _matched(model, distinct, between).withColumn("suffix", key_suffix(F.col("ctx"), F.col("m"))), "matched-contexts"
    )
    between.drop()
    fallback = None if model.positions else model.vocabulary.agg(F.min("token")).head()[0]
    predicted = _named(model, matched, named).withColumn("target", F.coalesce("pred", F.lit(fallback).cast("string")))
    carried = [*keys, "asks", "m", "target", *[f"cc_{m}" for m in range(model.max_n)]]
    known = predicted.select(*carried).withColumnRenamed("m", "matched")
    shorter = F.explode(F.sequence(F.lit(0), F.coalesce("matched", F.lit(0)))).alias("m")
    asking = known.select("*", shorter)
    (often,) = frequent_keys(_with_gram(asking), _GRAM_KEYS)
    counted = between(_with_count(model, asking, ["c"], ["ctx", "target"], often), "counted-suffixes")
    named.drop()
    counts = [F.max(F.when(F.col("m") == m, F.col("c"))).alias(f"c_{m}") for m in range(model.max_n)]
    scored = counted.repartition("ctx").groupBy(*known.columns).agg(*counts)
    p = F.when(F.col("target").isNotNull(), interpolate(model)).alias("p")
    answers = write_table(scored.select(*keys, "asks", "matched", "target", p), "answered-contexts")
    between.drop()
    drop_tables(matched)
    return _answer_each(asked, answers, keys, ["matched", "target", "p"]).select(
        *contexts.columns, "n", "matched", readable(F.col("target")).alias("pred"), "p"
    )


def floored(model: Smoothing, p: Column) -> Column:
    """A probability fit for a logarithm: k instead of 0, an error when that is 0 too."""
    impossible = F.raise_error(F.lit("impossible token and smoothing_k = 0")).cast("double")
    return F.when(p > 0, p).otherwise(
        F.lit(float(model.smoothing_k)) if model.smoothing_k > 0 else impossible
    )


def is_punctuation(target: Column) -> Column:
    return target.isin(*PUNCTUATION)


def score_positions(model: NGramModel, methods: DataFrame) -> DataFrame:
    """One row per held-out position: `n, method_id, pos, ctx, target, pred, p, is_punct, correct`."""
    keys = ["n", "ctx", "target"]
    pairs = evaluation_pairs(methods, model).withColumnRenamed("cnt", "asks")
    between = _Kept()
    scored = write_table(_scored(model, pairs, between).drop("raw"), "scored-pairs")
    between.drop()
    if _names_best(model):
        named = scored.withColumnRenamed("pred", "other")
    else:
        # Where the target is the best one it is the prediction; the others are looked up once per context.
        wrong = scored.filter(F.col("best").isNotNull() & ~F.col("correct"))
        contexts = wrong.select("n", F.col("length").alias("m"), "ctx", "best").distinct()
        longest = model.ngrams.filter(F.col("m") == F.col("n") - 1)
        best = best_targets(longest, contexts).select("n", "ctx", "best", F.col("pred").alias("other"))
        named = scored.join(best, ["n", "ctx", "best"], "left")
    pred = F.when(F.col("correct"), F.col("target")).otherwise(F.col("other")).alias("pred")
    answers = write_table(named.select(*keys, "asks", "p", "correct", pred), "answered-pairs")
    drop_tables(scored)
    grams = windows(methods.select("method_id", "tokens"), model.max_n)
    positions = grams.select("method_id", "pos", "gram", _for_every_n(model)).select(
        "n",
        "method_id",
        "pos",
        key_prefix(key_suffix(F.col("gram"), F.col("n")), F.col("n") - 1).alias("ctx"),
        key_suffix(F.col("gram"), F.lit(1)).alias("target"),
    )
    return (
        _answer_each(positions, answers, keys, ["pred", "p", "correct"])
        .withColumn("p", floored(model, F.col("p")))
        .withColumn("is_punct", is_punctuation(F.col("target")))
        .withColumns({"target": readable(F.col("target")), "pred": readable(F.col("pred"))})
    )


def evaluate(model: NGramModel, methods: DataFrame) -> DataFrame:
    """Metrics per n: `n, accuracy, perplexity, perplexity_no_punctuation, vocabulary_size`.

    Without positions the perplexities are infinite and the accuracy is 0.
    """
    pairs = evaluation_pairs(methods, model).withColumn("is_punct", is_punctuation(F.col("target")))
    return metrics_per_order(model, _scored(model, pairs, kept))


def metrics_per_order(model: Smoothing, scored: DataFrame) -> DataFrame:
    """The metrics of every n from scored pairs `n, cnt, is_punct, p, correct`."""
    cnt, wordy = F.col("cnt"), ~F.col("is_punct")
    bits = cnt * F.log2(floored(model, F.col("p")))
    sums = scored.groupBy("n").agg(
        F.sum(cnt).alias("total"),
        F.sum(bits).alias("bits"),
        F.sum(F.when(wordy, cnt)).alias("wordy_total"),
        F.sum(F.when(wordy, bits)).alias("wordy_bits"),
        F.sum(F.when(F.col("correct"), cnt).otherwise(0)).alias("hits"),
    )
    every_n = scored.sparkSession.range(1).select(_for_every_n(model))

    def perplexity(bits: str, total: str) -> Column:
        return F.coalesce(F.pow(F.lit(2.0), -F.col(bits) / F.col(total)), F.lit(float("inf")))

    return every_n.join(F.broadcast(sums), "n", "left").select(
        "n",
        F.coalesce(F.col("hits") / F.col("total"), F.lit(0.0)).alias("accuracy"),
        perplexity("bits", "total").alias("perplexity"),
        perplexity("wordy_bits", "wordy_total").alias("perplexity_no_punctuation"),
        F.lit(model.vocab_size).cast("bigint").alias("vocabulary_size"),
    )


def metrics_report(metrics: DataFrame) -> DataFrame:
    """The metrics to three decimals."""
    rounded = [F.round(c, 3).alias(c) for c in METRICS if c != "vocabulary_size"]
    return metrics.select("n", *rounded, "vocabulary_size")
