"""Cleaning: from raw methods to distinct, plain, unremarkable ones.

Order: comments out, white space normalised, empty texts out, duplicates out,
ASCII only, length outliers out, boilerplate out.  The length bounds are taken
after de-duplication and the ASCII filter and before the boilerplate filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.functions.lexer import clean_code
from gramloom.plans.scratch import write_table

# A method is boilerplate when any of these is found in it.
BOILERPLATE_PATTERNS = (
    r"\bset[A-Z][a-zA-Z0-9_]*\([^\n]*\)\s*\{",
    r"\bget[A-Z][a-zA-Z0-9_]*\([^\n]*\)\s*\{",
    r"\bto(String|Array)\(\)\s*\{",
    r"\bhash(Code|)\(\)\s*\{",
    r"\bequals\(Object\s+\w+\)\s*\{",
    r"\bclone\(\)\s*\{",
    r"^\s*@Override\s*\n",
)

LOWER_PERCENTILE = 5
UPPER_PERCENTILE = 95
_BOUND_DECIMALS = 6


def with_clean_code(methods: DataFrame, code: str = "code") -> DataFrame:
    """`method_id, code` with comments removed and white space normalised.

    `explode(array(...))` keeps later filters on the result from being pushed
    below it, which would clean every text once per filter.
    """
    return methods.select("method_id", F.explode(F.array(clean_code(F.col(code)))).alias("code"))


def is_ascii(code: Column) -> Column:
    return ~code.rlike(r"[^\x00-\x7F]")


def is_boilerplate(code: Column) -> Column:
    return code.rlike("|".join(BOILERPLATE_PATTERNS))


def drop_empty(methods: DataFrame) -> DataFrame:
    return methods.filter(F.length("code") > 0)


def remove_duplicates(methods: DataFrame) -> DataFrame:
    """The first method of each distinct text; copies are merged before the shuffle."""
    others = [c for c in methods.columns if c not in ("method_id", "code")]
    if not others:
        return methods.groupBy("code").agg(F.min("method_id").alias("method_id")).select("method_id", "code")
    first = F.min_by(F.struct(*others), F.col("method_id")).alias("first")
    return (
        methods.groupBy("code")
        .agg(F.min("method_id").alias("method_id"), first)
        .select("method_id", "code", "first.*")
        .select(*methods.columns)
    )


def keep_ascii(methods: DataFrame) -> DataFrame:
    return methods.filter(is_ascii(F.col("code")))


def length_bounds(
    methods: DataFrame, lower: float = LOWER_PERCENTILE, upper: float = UPPER_PERCENTILE
) -> DataFrame:
    """One row `lower_bound, upper_bound`: exact, interpolated percentiles of the text length.

    Lengths are counted first, so the percentile sees one row per distinct
    length however many methods there are.
    """
    lengths = methods.groupBy(F.char_length("code").alias("length")).agg(F.count(F.lit(1)).alias("methods"))
    shares = F.array(F.lit(lower / 100), F.lit(upper / 100))
    return lengths.agg(F.percentile("length", shares, F.col("methods")).alias("bounds")).select(
        F.round(F.col("bounds")[0], _BOUND_DECIMALS).alias("lower_bound"),
        F.round(F.col("bounds")[1], _BOUND_DECIMALS).alias("upper_bound"),
    )


def _within(bounds: DataFrame) -> Column:
    """Both bounds as scalar subqueries: no join, no round trip through the driver's code."""
    length = F.char_length("code")
    low = bounds.select("lower_bound").scalar()
    high = bounds.select("upper_bound").scalar()
    return (length >= low) & (length <= high)


def trim_lengths(
    methods: DataFrame, lower: float = LOWER_PERCENTILE, upper: float = UPPER_PERCENTILE
) -> DataFrame:
    """Keep methods whose length lies between the two percentiles, both included."""
    return methods.filter(_within(length_bounds(methods, lower, upper)))


def drop_boilerplate(methods: DataFrame) -> DataFrame:
    return methods.filter(~is_boilerplate(F.col("code")))


def clean_methods(methods: DataFrame, code: str = "code") -> DataFrame:
    """The whole chain: `method_id, code`.

    The ASCII filter depends on the text alone, so it runs before the shuffle
    of the de-duplication.  The distinct texts are kept on shared storage, as
    the bounds and the filters both read them.
    """
    candidates = keep_ascii(drop_empty(with_clean_code(methods, code)))
    distinct = write_table(remove_duplicates(candidates), "distinct-methods")
    return drop_empty(drop_boilerplate(trim_lengths(distinct)))


def cleaning_funnel(methods: DataFrame, code: str = "code") -> DataFrame:
    """One row per stage: `step, stage, rows_in, rows_out, removed, lower_bound, upper_bound`."""
    texts = write_table(
        with_clean_code(methods, code).groupBy("code").agg(F.count(F.lit(1)).alias("copies")),
        "text-copies",
    )
    text = F.col("code")
    non_empty = F.length(text) > 0
    plain = non_empty & is_ascii(text)
    bounds = length_bounds(texts.filter(plain))
    trimmed = plain & _within(bounds)
    kept = trimmed & ~is_boilerplate(text)

    def rows(condition: Column, weight: Column | int = 1) -> Column:
        return F.coalesce(F.sum(F.when(condition, weight).otherwise(0)), F.lit(0)).cast("bigint")

    counts = texts.agg(
        rows(F.lit(True), F.col("copies")).alias("raw"),
        rows(non_empty, F.col("copies")).alias("non_empty"),
        rows(non_empty).alias("distinct"),
        rows(plain).alias("ascii"),
        rows(trimmed).alias("trimmed"),
        rows(kept).alias("kept"),
    ).select("*", bounds.select("lower_bound").scalar().alias("low"), bounds.select("upper_bound").scalar().alias("high"))
    none = F.lit(None).cast("double")
    stages = [
        ("comment_only", "raw", "non_empty", none, none),
        ("duplicates", "non_empty", "distinct", none, none),
        ("non_ascii", "distinct", "ascii", none, none),
        ("length", "ascii", "trimmed", F.col("low"), F.col("high")),
        ("boilerplate", "trimmed", "kept", none, none),
    ]
    rows_of_stages = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(stage).alias("stage"),
            F.col(before).alias("rows_in"),
            F.col(after).alias("rows_out"),
            (F.col(before) - F.col(after)).alias("removed"),
            low.alias("lower_bound"),
            high.alias("upper_bound"),
        )
        for step, (stage, before, after, low, high) in enumerate(stages, start=1)
    ]
    return counts.select(F.inline(F.array(*rows_of_stages)))
