"""From methods to tokenised, split methods.

A methods table has `method_id bigint` and a code column; a tokenised one has
`method_id bigint, tokens array<string>`.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.functions.lexer import tokenize_code
from gramloom.functions.sampling import sample_bucket, sample_key
from gramloom.plans.numbers import numbered

TRAIN = "train"
VALIDATION = "val"
TEST = "test"

DEFAULT_SEED = 42
DEFAULT_TEST_SIZE = 0.2
QUICK_SAMPLE_SIZE = 1000

#: The column that carries a method's id to where its place is the first.
FIRST_METHOD = "first_method"

_HEX_DIGITS = 32
_PREFIX_STEP = 4


def tokenize_methods(methods: DataFrame, code: str = "code") -> DataFrame:
    """Tokens per method, methods without tokens dropped.

    The array goes through `explode(array(...))` so that the emptiness filter
    stays above it; pushed below, it would lex every text a second time.
    """
    tokens = F.explode(F.array(tokenize_code(F.col(code))))
    return methods.select("method_id", tokens.alias("tokens")).filter(F.size("tokens") > 0)


def tokenize_placed(texts: DataFrame, code: str = "code") -> DataFrame:
    """Tokenised methods with their `place`, on shared storage; the texts are lexed once, where ranges of ids put them."""
    return _placed(numbered(texts, ["method_id"], "place", lambda rows: tokenize_methods(rows, code)))


def place_methods(methods: DataFrame) -> DataFrame:
    """Add `place` to tokenised methods that lack it; `methods` should be a table, as it is read twice.

    The place of a method is its number in the order of ids, times the positions of the longest method.  Place
    plus position is one bigint, whatever the ids, that orders all positions by method and position.
    """
    if "place" in methods.columns:
        return methods
    return _placed(numbered(methods, ["method_id"], "place"))


def _placed(methods: DataFrame) -> DataFrame:
    count, room = methods.agg(F.max("place") + 1, _room()).head()
    if (count or 0) * (room or 0) >= 2**63:
        raise ValueError("methods times the longest method's positions exceed a bigint")
    return methods.withColumn("place", F.col("place") * F.lit(room or 0).cast("bigint"))


def _room() -> Column:
    """Positions of the longest method: its tokens and the end marker."""
    return (F.max(F.size("tokens")) + 1).cast("bigint")


def first_positions(rows: DataFrame, first_seen: str, methods: DataFrame) -> DataFrame:
    """Add `first_method, first_pos` for places and positions; `methods` are all that were placed together.

    Rows that carry `first_method` already need no join with the methods.
    """
    room = methods.agg(_room()).head()[0] or 1
    position = F.pmod(F.col(first_seen), F.lit(room)).cast("int").alias("first_pos")
    if FIRST_METHOD in rows.columns:
        return rows.select(*[c for c in rows.columns if c != FIRST_METHOD], position, FIRST_METHOD)
    ids = methods.select("place", F.col("method_id").alias(FIRST_METHOD))
    return rows.select("*", position).withColumn("place", F.col(first_seen) - F.col("first_pos")).join(ids, "place").drop("place")


def split_methods(
    methods: DataFrame, seed: int = DEFAULT_SEED, test_size: float = DEFAULT_TEST_SIZE
) -> DataFrame:
    """Add `split`, fixed by id and seed, without a shuffle.

    About `test_size` of the ids are held out, to a thousandth: half of them for
    validation, half for test.  The default is 80 / 10 / 10.
    """
    held_out = Fraction(_checked(test_size)).limit_denominator(1000)
    buckets = 2 * held_out.denominator
    first_test = buckets - held_out.numerator
    bucket = sample_bucket(F.col("method_id"), seed, buckets)
    split = (
        F.when(bucket < first_test - held_out.numerator, TRAIN)
        .when(bucket < first_test, VALIDATION)
        .otherwise(TEST)
    )
    return methods.withColumn("split", split)


def _checked(test_size: float) -> float:
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    return test_size


def training_and_validation(methods: DataFrame) -> DataFrame:
    """The methods a final model is trained on."""
    return methods.filter(F.col("split").isin(TRAIN, VALIDATION))


def quick_sample(
    methods: DataFrame,
    size: int = QUICK_SAMPLE_SIZE,
    seed: int = DEFAULT_SEED,
    include_test: bool = False,
) -> DataFrame:
    """Seeded sample of at most `size` methods, split anew 80 / 10 / 10.

    Drawn without the test split unless `include_test`, so that selection
    never sees test methods.  The sample is what sorts below the sampling key
    of rank `size`, so drawing it filters and never gathers rows in one task.
    """
    eligible = split_methods(methods, seed) if "split" not in methods.columns else methods
    if not include_test:
        eligible = eligible.filter(F.col("split") != TEST)
    keyed = eligible.withColumn("_key", sample_key(F.col("method_id"), seed))
    sample = keyed.filter(_place() < F.lit(_key_at_rank(keyed, size))).drop("_key", "split")
    return split_methods(sample, seed + 1)


def exact_split_sizes(rows: int, held_out: float = DEFAULT_TEST_SIZE) -> tuple[int, int, int]:
    """Train, validation and test sizes; what is held out rounds up each time."""
    remaining = -int(-rows * held_out // 1)
    test = -int(-remaining * 0.5 // 1)
    return rows - remaining, remaining - test, test


def exact_split_methods(
    methods: DataFrame, held_out: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Add `split` with exactly the sizes of `exact_split_sizes`.

    Methods are ranked by sampling key.  The two ranks where the split changes
    are located by counting key prefixes, so no rows are gathered to be ranked.
    Ids are taken to be unique; repeated ones make the sizes inexact.
    """
    _checked(held_out)
    keyed = methods.withColumn("_key", sample_key(F.col("method_id"), seed))
    rows = keyed.count()
    if rows == 0:
        return split_methods(methods, seed)
    train, validation, _ = exact_split_sizes(rows, held_out)
    first_val = _key_at_rank(keyed, train)
    first_test = _key_at_rank(keyed, train + validation)
    split = (
        F.when(_place() < F.lit(first_val), TRAIN)
        .when(_place() < F.lit(first_test), VALIDATION)
        .otherwise(TEST)
    )
    return keyed.withColumn("split", split).drop("_key")


def _place() -> Column:
    """`key:id` as text, in the order of (key, id)."""
    return F.concat("_key", F.format_string(":%020d", F.col("method_id")))


def _key_at_rank(keyed: DataFrame, rank: int) -> str:
    """`key:id` of the row with this zero-based rank; past the end, a key above all others.

    Each round counts the next four digits of the keys within the prefix that
    holds the rank, until that is one row or one key: at most 65,536 small rows
    reach the driver.
    """
    prefix, before = "", 0
    candidates = keyed.select("_key", "method_id")
    remaining = None
    while remaining != 1 and len(prefix) < _HEX_DIGITS:
        length = len(prefix) + _PREFIX_STEP
        counts = (
            candidates.filter(F.col("_key").startswith(prefix))
            .groupBy(F.substring("_key", 1, length).alias("prefix"))
            .count()
            .orderBy("prefix")
            .collect()
        )
        for bucket in counts:
            if before + bucket["count"] > rank:
                prefix, remaining = bucket["prefix"], bucket["count"]
                break
            before += bucket["count"]
        else:
            return "g"
    boundary = (
        candidates.filter(F.col("_key").startswith(prefix))
        .orderBy("_key", "method_id")
        .offset(rank - before)
        .limit(1)
        .select(_place())
    )
    return boundary.head()[0]
