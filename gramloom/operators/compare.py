"""Training and scoring many orders at once.

Models of different n count almost the same n-grams.  A window of a padded
method that ends at position i gives each model n the gram of k tokens that
ends there, unless the method ends fewer than n - k positions later; only
grams that consist of start markers alone come on top.  So a gram is one row
with one count per n, and a comparison of n = 2..7 costs 7 rows per distinct
window instead of 27, in counting and in scoring alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.functions.grams import (
    SEPARATOR,
    START,
    extended_key,
    gram_key,
    joinable,
    key_prefix,
    key_suffix,
    pad_tokens,
)
from gramloom.operators.corpus import place_methods
from gramloom.operators.fit import DEFAULT_LAMBDA, DEFAULT_SMOOTHING, best_first_seen, check_parameters, windows
from gramloom.operators.score import counts_per_suffix, interpolate, is_punctuation, metrics_per_order
from gramloom.plans.lookup import frequent_keys, kept, lookup_join
from gramloom.plans.scratch import drop_tables, in_buckets, write_table


@dataclass(frozen=True)
class OrderModels:
    """Models of all `n_values` in shared tables.

    `ngrams(m, ctx, target, c_<n>.., first_seen, gram)` and
    `contexts(m, ctx, cc_<n>.., best)`, in buckets by `gram` and `ctx`; a null count means never seen.
    First-seen keys and best targets are those of the model with n = m + 1,
    the only one for which a context of m tokens is the full one.
    """

    ngrams: DataFrame
    contexts: DataFrame
    n_values: tuple[int, ...]
    smoothing_k: float
    lambda_factor: float
    vocab_size: int
    positions: int

    @property
    def max_n(self) -> int:
        return max(self.n_values)


def _each(name: str, n_values: Sequence[int]) -> list[str]:
    return [f"{name}_{n}" for n in n_values]


def _placed_windows(methods: DataFrame, longest: int) -> DataFrame:
    """Distinct windows with their distance from either end: `gram, head, tail, c, first_seen`.

    Distances of `longest - 1` and more are all the same.
    """
    padded = methods.select(
        "place",
        pad_tokens(joinable(F.col("tokens")), longest).alias("padded"),
    ).select("place", "padded", (F.size("padded") - longest).alias("last"))
    placed = padded.select(
        "place", "padded", "last", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("pos")
    ).select(
        gram_key(F.slice("padded", F.col("pos") + 1, longest)).alias("gram"),
        F.least(F.col("pos"), F.lit(longest - 1)).alias("head"),
        F.least(F.col("last") - F.col("pos"), F.lit(longest - 1)).alias("tail"),
        (F.col("place") + F.col("pos")).alias("first_seen"),
    )
    return placed.groupBy("gram", "head", "tail").agg(
        F.count(F.lit(1)).alias("c"), F.min("first_seen").alias("first_seen")
    )


def order_counts(methods: DataFrame, n_values: Sequence[int]) -> DataFrame:
    """Counts of every n-gram in every model: `m, gram, c_<n>.., first_seen`."""
    longest = max(n_values)
    return _counts_of(_placed_windows(place_methods(methods), longest), n_values, range(1, longest + 1))


def _parts(longest: int) -> list[list[int]]:
    """Orders that are counted together.  The tokens in a window's suffixes are dealt out for one part after the other."""
    parts = [[1]]
    for k in range(2, longest + 1):
        if len(parts) > 1 and sum(parts[-1]) + k <= longest + 2:
            parts[-1].append(k)
        else:
            parts.append([k])
    return parts


def _counts_of(windows: DataFrame, n_values: Sequence[int], orders: Sequence[int]) -> DataFrame:
    """Counts of the n-grams of some orders from distinct windows.  The separators in a gram tell its order."""
    longest = max(n_values)
    grams = [F.struct(F.lit(k).alias("k"), F.lit(None).cast("string").alias("markers")) for k in orders]
    markers = [
        F.struct(F.lit(k).alias("k"), F.lit(SEPARATOR.join([START] * k)).alias("markers"))
        for k in orders
        if k < longest
    ]
    k, is_marker = F.col("part.k"), F.col("part.markers").isNotNull()
    rows = windows.select("*", F.explode(F.array(*grams, *markers)).alias("part")).filter(
        ~is_marker | (F.col("head") + k < longest)
    )

    def counted_by(n: int) -> Column:
        """Of the windows near a start, those before position n - k stand for one gram of k markers each."""
        ends = (F.lit(n) >= k) & (F.lit(n) <= F.col("tail") + k)
        return F.when(is_marker, F.lit(n) > F.col("head") + k).otherwise(ends)

    gram = F.coalesce(F.col("part.markers"), key_suffix(F.col("gram"), k))
    counts = rows.groupBy(gram.alias("gram")).agg(
        (F.max(k) - 1).alias("m"),
        *[F.sum(F.when(counted_by(n), F.col("c"))).alias(f"c_{n}") for n in n_values],
        F.min(F.when(~is_marker, F.col("first_seen"))).alias("first_seen"),
    )
    return counts.filter(F.coalesce(*_each("c", n_values)).isNotNull())


def _named(counts: DataFrame) -> DataFrame:
    """Add `ctx, target` to grams."""
    return counts.withColumns(
        {"ctx": key_prefix(F.col("gram"), F.col("m")), "target": key_suffix(F.col("gram"), F.lit(1))}
    )


def _order_contexts(ngrams: DataFrame, n_values: Sequence[int]) -> DataFrame:
    """The contexts of grams, which either all have some or all have none: an empty token alone has the key of no context."""
    own = F.coalesce(*[F.when(F.col("m") == n - 1, F.col(f"c_{n}")) for n in n_values])
    best = best_first_seen(own, F.col("first_seen"))
    return ngrams.groupBy("ctx").agg(
        F.max("m").alias("m"), *[F.sum(f"c_{n}").alias(f"cc_{n}") for n in n_values], best.alias("best")
    )


def fit_orders(
    methods: DataFrame,
    n_values: Sequence[int],
    smoothing_k: float = DEFAULT_SMOOTHING,
    lambda_factor: float = DEFAULT_LAMBDA,
) -> OrderModels:
    """Train one model per n over shared counts, kept on shared storage in the buckets of their keys.

    Windows are counted once.  Their grams are counted part by part, so the disk holds the shuffle files of a part.
    """
    n_values = tuple(sorted(set(n_values)))
    check_parameters(n_values, smoothing_k)
    longest = n_values[-1]
    windows = write_table(_placed_windows(place_methods(methods), longest), "order-windows")
    with in_buckets("gram"):
        parts = [_named(write_table(_counts_of(windows, n_values, orders), "order-ngrams")) for orders in _parts(longest)]
    drop_tables(windows)
    ngrams = reduce(DataFrame.unionByName, parts)
    positions = ngrams.filter(F.col("m") == 0).agg(F.sum(f"c_{longest}")).head()[0]
    if positions is None:
        raise ValueError("no methods to train on")
    with in_buckets("ctx"):
        contexts = [write_table(_order_contexts(part, n_values), "order-contexts") for part in parts]
    start = methods.sparkSession.range(1).select(F.lit(START).alias("target"))
    words = ngrams.filter(F.col("m") == longest - 1).select("target").unionByName(start).distinct()
    return OrderModels(
        ngrams=ngrams,
        contexts=reduce(DataFrame.unionByName, contexts),
        n_values=n_values,
        smoothing_k=smoothing_k,
        lambda_factor=lambda_factor,
        vocab_size=words.count(),
        positions=positions,
    )


def _mean(name: str, n_values: Sequence[int]) -> Column:
    """The mean count over the models: it sums to a model's positions at most, as each model's own counts do."""
    counts = [F.coalesce(F.col(column), F.lit(0)) for column in _each(name, n_values)]
    return reduce(Column.__add__, counts) / len(counts)


def evaluate_orders(models: OrderModels, methods: DataFrame) -> DataFrame:
    """Metrics of every model: `n` and the four metrics, by n in no order.

    Each distinct window is looked up once per suffix for all models together.
    """
    n_values, longest = models.n_values, models.max_n
    counted = windows(methods.select("method_id", "tokens"), longest).groupBy("gram").agg(F.count(F.lit(1)).alias("cnt"))
    target = key_suffix(F.col("gram"), F.lit(1))
    pairs = write_table(
        counted.select(
            F.monotonically_increasing_id().alias("gid"),
            key_prefix(F.col("gram"), F.lit(longest - 1)).alias("ctx"),
            target.alias("target"),
            is_punctuation(target).alias("is_punct"),
            "cnt",
        ),
        "order-pairs",
    )
    asked = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("m")).withColumn(
        "ctx", key_suffix(F.col("ctx"), F.col("m"))
    )
    asked = asked.withColumn("gram", extended_key(F.col("ctx"), F.col("m"), F.col("target")))
    often, often_counted = frequent_keys(asked, ["ctx", "m"], ["gram", "m"])
    known = lookup_join(
        asked.drop("gram"),
        models.contexts,
        ["ctx", "m"],
        [*_each("cc", n_values), "best"],
        _mean("cc", n_values),
        models.positions,
        ["gid"],
        often,
        "ctx",
    ).filter(F.coalesce(*_each("cc", n_values)).isNotNull() | (F.col("m") == 0))
    known = kept(
        known.withColumn("gram", extended_key(F.col("ctx"), F.col("m"), F.col("target"))).drop("ctx", "target"), "known-suffixes"
    )
    answers = lookup_join(
        known,
        models.ngrams,
        ["gram", "m"],
        [*_each("c", n_values), "first_seen"],
        _mean("c", n_values),
        models.positions,
        ["gid"],
        often_counted,
        "gram",
    ).drop("gram")
    answers = kept(answers, "counted-suffixes")
    drop_tables(pairs, known)
    counts = [F.struct(F.lit(n).alias("n"), F.col(f"c_{n}").alias("c"), F.col(f"cc_{n}").alias("cc")) for n in n_values]
    # A pair's rows meet before they are widened to one per model, so the grouping needs no exchange of its own.
    per_model = (
        answers.repartition("gid")
        .withColumn("hit", F.col("best") == F.col("first_seen"))
        .select("gid", "cnt", "is_punct", "m", "hit", F.inline(F.array(*counts)))
        .filter((F.col("n") > F.col("m")) & (F.col("cc").isNotNull() | (F.col("m") == 0)))
    )
    full = F.col("m") == F.col("n") - 1
    per_pair = per_model.groupBy("gid", "n", "cnt", "is_punct").agg(
        *counts_per_suffix(models), F.max(F.when(full, F.col("hit"))).alias("hit")
    )
    scored = per_pair.select(
        "n", "cnt", "is_punct", interpolate(models).alias("p"), F.coalesce("hit", F.lit(False)).alias("correct")
    )
    return metrics_per_order(models, scored)
