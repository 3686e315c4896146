"""Mixing sources to target weights by systematic sampling.

Within a source the expected copies of its documents are prefix-summed in the
order of size, one random offset is added, and a document is taken once for
each integer that its stretch of the sum crosses.  As neighbours in that order
are nearly equal in size, the words taken stray from the target by a few of the
largest documents at most.  Built-in expressions only.

Null text: size 0.  Null source: a source of its own, last in order.  Repeated
rows are sampled one by one.  Empty tables and sources without words: targets
and copies are 0.  Columns of the input stay out of `mix_plan` except the id;
`mixed` returns the columns of the input, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.llm import ranks
from gramloom.llm.common import size_words, stage

#: Copies are counted in units of 2**-UNIT_BITS.
UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2


def _fraction(text: F.Column) -> F.Column:
    """A number from 0 to UNIT - 1 by the md5 of a text."""
    return F.conv(F.substring(F.md5(text), 1, UNIT_BITS // 4), 16, 10).cast("bigint")


def _targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """Shares by weight; what exceeds a source's limit goes to the others by weight.

    The level is the words per unit of weight.  Each round is one aggregation
    of the source table, and sources only ever become full, so rounds end.
    """
    limit = F.col("source_size") * most
    level = 0.0
    while True:
        full = F.lit(level) * F.col("weight") > limit
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open"),
        ).head()
        if not row["open"]:
            level = math.inf
            break
        now = (share * row["all"] - row["held"]) / row["open"]
        if now == level:
            break
        level = now
    if level == math.inf:
        return sources.withColumn("target", limit.cast("double"))
    return sources.withColumn("target", F.least(F.lit(level) * F.col("weight"), limit.cast("double")))


def _plan(sized: DataFrame, seed: int, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Copies of rows (doc_id, source, size)."""
    sized = stage(sized, "sized")
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    named = sources.select(
        F.lit(0).alias("all"), F.col("source").isNull().alias("last"), F.coalesce("source", F.lit("")).alias("name"),
        "source", "source_size",
    )
    turn = F.array(*[F.lit(w) for w in weights])
    named = ranks.numbered(named, "all", ["last", "name"], "sid")
    named = named.withColumn("weight", F.element_at(turn, (F.col("sid") % len(weights)).cast("int") + 1))
    named = stage(named, "weights")
    seeded = F.concat_ws(":", F.lit(str(seed)), F.lit("source"), F.col("sid").cast("string"))
    expected = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0)
    targets = _targets(named, share, most).select(
        F.col("source").alias("of"), "sid", "source_size", "target",
        expected.cast("bigint").alias("expected"), _fraction(seeded).alias("offset"),
    )
    targets = stage(targets, "targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("of")), "inner").drop("of")
    joined = joined.withColumn("tie", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))))
    summed = ranks.running_sum(joined, "sid", ["size", "tie", "doc_id"], F.col("expected"), "before")
    copies = F.expr(f"(before + offset + expected) div {UNIT} - (before + offset) div {UNIT}")
    return summed.select(
        "doc_id", "size", "source", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), size_words(F.col("text")).alias("size")
    )


def mix_plan(
    docs: DataFrame,
    seed: int = 42,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken), one row per input row.

    Sources in code-point order take `weights` in turn.  Together they get
    `share` times all words, none more than `most` times its own.
    """
    return _plan(_sized(docs), seed, weights, share, most)


def mixed(
    docs: DataFrame,
    seed: int = 42,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken, with its own columns.

    Rows of one source that repeat an id are taken together, as one document of
    their joint size.
    """
    units = _sized(docs).groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    plan = _plan(units, seed, weights, share, most).filter("copies > 0")
    plan = plan.select(F.col("doc_id").alias("id"), F.col("source").alias("of"), F.col("copies").cast("int").alias("n"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("row_id"), docs["source"].cast("string").alias("row_source"),
    )
    taken = rows.join(plan, F.col("row_id").eqNullSafe(F.col("id")) & F.col("row_source").eqNullSafe(F.col("of")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("row.*")
