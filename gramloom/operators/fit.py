"""Training: n-gram counts as distributed aggregations.

Counting is anchored on the left.  A method of T tokens, padded for order n,
has T + 1 windows of n tokens, and each window adds one to every one of its
prefixes: the prefix of length m + 1 is (context of length m, target).  So the
counts of all lower orders are a roll-up of the window counts, and the windows
of a shorter model are the suffixes of those of a longer one.  Windows are
therefore counted once, for the largest n, and the rest is derived from the
distinct windows, one length after the other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.functions.grams import (
    END,
    START,
    gram_key,
    joinable,
    key_prefix,
    key_suffix,
    pad_tokens,
)
from gramloom.operators.corpus import FIRST_METHOD, place_methods
from gramloom.plans.scratch import SPLIT, bucket_count, drop_tables, in_buckets, small_splits, write_table

DEFAULT_SMOOTHING = 0.01
DEFAULT_LAMBDA = 0.4

# First-seen keys are bigints; counts come first in a rank, above this range.
_RANGE = 2**63


@dataclass(frozen=True)
class NGramModel:
    """One trained model per n, as long tables keyed by n.

    `ngrams(n, m, ctx, target, c, first_seen, gram)`, `contexts(n, m, ctx, cc, best)`
    and `vocabulary(token)` read `tables`, which lie in `buckets` by `gram`, the key of context and target, and
    by `ctx`, so lookups by these take no exchange of the model.  `best` is the first-seen key of a
    context's best target, which identifies the target within the context.
    `vocab_size` and `positions`, the total count of each order, are the same
    for every n.
    """

    ngrams: DataFrame
    contexts: DataFrame
    vocabulary: DataFrame
    n_values: tuple[int, ...]
    smoothing_k: float
    lambda_factor: float
    vocab_size: int
    positions: int
    tables: tuple[DataFrame, ...] = ()
    buckets: int = 0

    @property
    def max_n(self) -> int:
        return max(self.n_values)

    def drop(self) -> None:
        """Delete the tables of a model that nothing reads any more."""
        drop_tables(*self.tables)


def check_parameters(n_values: Sequence[int], smoothing_k: float) -> None:
    if not n_values or min(n_values) < 1:
        raise ValueError("n must be at least 1")
    if smoothing_k < 0:
        raise ValueError("smoothing_k must not be negative")


def windows(methods: DataFrame, n: int) -> DataFrame:
    """Every window of n tokens: `method_id, pos, gram`, T + 1 of them per method.

    Other columns of `methods` than `tokens` and `split` stay beside them.
    """
    kept = [c for c in methods.columns if c not in ("tokens", "split")]
    padded = methods.select(*kept, pad_tokens(joinable(F.col("tokens")), n).alias("padded"))
    return padded.select(
        *kept, "padded", F.explode(F.sequence(F.lit(0), F.size("padded") - n)).alias("pos")
    ).select(*kept, "pos", gram_key(F.slice("padded", F.col("pos") + 1, n)).alias("gram"))


def window_counts(methods: DataFrame, n: int) -> DataFrame:
    """Distinct windows of placed methods: `gram, c, first_seen`, the last of them the lowest place plus position.

    Methods that have `first_method` give that of their lowest place too.
    """
    origin = [c for c in methods.columns if c == FIRST_METHOD]
    counted = windows(methods.select("tokens", "place", *origin), n).groupBy("gram")
    seen = F.col("place") + F.col("pos")
    return counted.agg(
        F.count(F.lit(1)).alias("c"), F.min(seen).alias("first_seen"), *[F.min_by(c, seen).alias(c) for c in origin]
    )


@dataclass(frozen=True)
class Levels:
    """Grams by their length, `order` at most: `n, order, gram, c, first_seen`; the shorter ones are contexts and have `best`."""

    longest: DataFrame
    shorter: DataFrame

    order: int
    tables: tuple[DataFrame, ...] = ()

    def ngrams(self) -> DataFrame:
        """The grams as (context, target): `n, m, ctx, target, c, first_seen, gram`.

        A length is a branch of its own with a literal `m`, so one that is not asked for is not read.
        """
        values = [c for c in self.longest.columns if c not in ("n", "order", "gram")]
        branches = [self.longest, *[self.shorter.filter(F.col("order") == k) for k in range(1, self.order)]]
        return reduce(
            DataFrame.unionByName,
            [
                rows.select(
                    "n",
                    F.lit(k - 1).alias("m"),
                    key_prefix(F.col("gram"), F.lit(k - 1)).alias("ctx"),
                    key_suffix(F.col("gram"), F.lit(1)).alias("target"),
                    *values,
                    "gram",
                )
                for k, rows in zip((self.order, *range(1, self.order)), branches, strict=True)
            ],
        )

    def contexts(self) -> DataFrame:
        """The grams as contexts: `n, m, ctx, cc, best`; a model's longest grams are none."""
        return self.shorter.filter(F.col("n") > F.col("order")).select(
            "n", F.col("order").alias("m"), F.col("gram").alias("ctx"), F.col("c").alias("cc"), "best"
        )


def write_counts(counted: DataFrame, name: str) -> DataFrame:
    """Write counts down in the buckets of their grams, where counting leaves them.

    Their map-side partial counts save little and must not spill, so tasks read small splits.
    """
    with small_splits(counted.sparkSession), in_buckets("gram"):
        return write_table(counted, name, SPLIT)


def gram_levels(
    methods: DataFrame,
    n_values: Sequence[int],
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    with_best: bool = True,
) -> Levels:
    """Grams of every length from the longest down to none.

    A level is rolled up from the one above it with map-side partial counts, so an occurrence is dealt once as a
    window and after that only distinct grams are.  As counting is anchored on the left, the grams of a level
    are the contexts of the one above: `best` is the first-seen key of their best target.
    `keep` may write the longest grams and the shorter ones down; without it columns that nobody asks for are not counted,
    nor is `best` unless `with_best`.
    """
    longest = max(n_values)
    keys = ["gram"] if len(n_values) == 1 else ["n", "gram"]
    grams = window_counts(place_methods(methods), longest)
    if keep:
        grams = keep(grams, "ngrams")
    origin = [c for c in grams.columns if c == FIRST_METHOD]
    top = grams.select(F.lit(longest).alias("n"), F.lit(longest).alias("order"), *grams.columns)
    levels, above = [], top
    for order in range(longest - 1, -1, -1):
        rows = above.select(
            "n", key_prefix(F.col("gram"), F.lit(order)).alias("gram"), "c", "first_seen", *origin, F.col("c").alias("of_target")
        )
        if order in n_values:
            own = grams.withColumns({"n": F.lit(order), "gram": key_suffix(F.col("gram"), F.lit(order))})
            rows = rows.unionByName(own, allowMissingColumns=True)
        level = rows.groupBy(*keys).agg(
            F.sum("c").alias("c"),
            F.min("first_seen").alias("first_seen"),
            *[F.min_by(c, "first_seen").alias(c) for c in origin],
            *([best_first_seen(F.col("of_target"), F.col("first_seen")).alias("best")] if with_best else []),
        )
        if len(keys) == 1:
            level = level.withColumn("n", F.lit(longest))
        levels.append(level.withColumn("order", F.lit(order)))
        # Always true: a level that is written asks for all its columns here too, so its exchange serves both uses.
        above = level.filter(F.col("best").isNotNull() | (F.col("n") == order)) if keep and with_best else level
    shorter = reduce(DataFrame.unionByName, levels)
    if not keep:
        return Levels(top, shorter, longest)
    if len(keys) > 1:
        shorter = shorter.repartition(bucket_count(shorter.sparkSession), "gram")
    shorter = keep(shorter, "contexts")
    return Levels(top, shorter, longest, (grams, shorter))


def ngram_counts(
    methods: DataFrame, n_values: Sequence[int], keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Counts of every (context, target) of every order: `n, m, ctx, target, c, first_seen`.

    The longest order needs no second aggregation; every other one is rolled up from the next longer one.
    Methods that have `first_method` give that of the first place too.  With `keep=write_counts` the longest grams and the
    shorter ones are written one after the other, which bounds the disk taken.
    """
    return gram_levels(methods, n_values, keep, with_best=False).ngrams().drop("gram")


def context_counts(ngrams: DataFrame | Levels) -> DataFrame:
    """Occurrences and best target per context: `n, m, ctx, cc, best`.

    The best target has the highest count; of equals, the one seen first.  Levels have both already.
    """
    if isinstance(ngrams, Levels):
        return ngrams.contexts()
    best = best_first_seen(F.col("c"), F.col("first_seen"))
    return ngrams.groupBy("n", "m", "ctx").agg(F.sum("c").alias("cc"), best.alias("best"))


def best_first_seen(c: Column, first_seen: Column) -> Column:
    """Aggregate: the first-seen key of the highest count, of equal counts the lowest.  Nulls are ignored.

    Count and earliness are ranked as one decimal, which holds any two bigints and keeps this in hash aggregation.
    """
    step = F.lit(str(_RANGE)).cast("decimal(19,0)")
    earliness = (F.lit(_RANGE - 1) - first_seen).cast("decimal(19,0)")
    rank = (c.cast("decimal(19,0)") * step + earliness).cast("decimal(38,0)")
    return F.lit(_RANGE - 1) - F.pmod(F.max(rank), step).cast("bigint")


def best_targets(ngrams: DataFrame, contexts: DataFrame) -> DataFrame:
    """Add `pred`, the token behind `best`, to distinct contexts `n, m, ctx, best, ...`.

    A first-seen key is a place in the methods, where one gram of each length starts, so it names a target without
    its context.  The join keys are unique in `ngrams` and as rare in `contexts` as these, however frequent a context is.
    """
    targets = ngrams.select("n", "m", F.col("first_seen").alias("best"), F.col("target").alias("pred"))
    return contexts.join(targets, ["n", "m", "best"]).select(*contexts.columns, "pred")


def vocabulary(methods: DataFrame) -> DataFrame:
    """Distinct tokens and the two markers."""
    spark = methods.sparkSession
    markers = spark.range(1).select(F.explode(F.array(F.lit(START), F.lit(END))).alias("token"))
    tokens = methods.select(F.explode(joinable(F.col("tokens"))).alias("token"))
    return tokens.unionByName(markers).distinct()


def vocabulary_of(ngrams: DataFrame, n: int) -> DataFrame:
    """The vocabulary read off the counts of one model: the targets of full windows and the start marker."""
    start = ngrams.sparkSession.range(1).select(F.lit(START).alias("token"))
    targets = ngrams.filter((F.col("n") == n) & (F.col("m") == n - 1)).select(F.col("target").alias("token"))
    return targets.unionByName(start).distinct()


def fit(
    methods: DataFrame,
    n_values: int | Sequence[int],
    smoothing_k: float = DEFAULT_SMOOTHING,
    lambda_factor: float = DEFAULT_LAMBDA,
) -> NGramModel:
    """Count all orders of all requested n in one job and keep the tables on shared storage."""
    orders = (n_values,) if isinstance(n_values, int) else tuple(sorted(set(n_values)))
    check_parameters(orders, smoothing_k)
    levels = gram_levels(methods, orders, write_counts)
    ngrams = levels.ngrams()
    total = levels.shorter.filter((F.col("n") == orders[0]) & (F.col("order") == 0)).select("c").head()
    if total is None:
        raise ValueError("no methods to train on")
    words = vocabulary_of(ngrams, orders[0])
    return NGramModel(
        ngrams=ngrams,
        contexts=context_counts(levels),
        vocabulary=words,
        n_values=orders,
        smoothing_k=smoothing_k,
        lambda_factor=lambda_factor,
        vocab_size=words.count(),
        positions=total[0],
        tables=levels.tables,
        buckets=bucket_count(methods.sparkSession),
    )
