"""Left lookup joins that stay balanced when a few keys are very frequent."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramloom.plans.scratch import write_table

# A key is hot when it carries more than this fraction of its group's weight,
# so a group has fewer than 1 / HOT_FRACTION hot keys.
HOT_FRACTION = 1e-3

# Longer keys are never hot, which bounds the bytes of a broadcast as the weights bound its rows.
KEY_BYTES = 4096

# Items that a sketch tracks for each key that it may report.
_TRACKED_PER_KEY = 16

#: In a table that is bucketed for lookups by its keys, the column that holds their hash.
STORED_HASH = "hash"

# Between the keys of a row; numbers end at it, and tokens do not hold it unescaped.
_BETWEEN = "\x1f"

#: Ends what deals out a row that is to find nothing.
_NOWHERE = "\x1e"

_HOT = "_hot"
_HASH = "_hash"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Questions or answers written down between lookups, so that no two lookups have their shuffle files on disk together."""
    return write_table(frame, name)


def key_hash(keys: Collection[str]) -> Column:
    return F.xxhash64(*keys)


def frequent_keys(probe: DataFrame, *keys: list[str]) -> list[list[int]]:
    """For each list of keys, the hashes of those that ask for more rows than an even share of a shuffle partition.

    There are fewer of them than partitions.  One pass over `probe` fills sketches of bounded size; a
    key that one counts too high is looked up by broadcast without need.
    """
    partitions = int(probe.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(_TRACKED_PER_KEY * partitions, 1_000_000)
    tops = [
        F.call_function("approx_top_k", key_hash(names), F.lit(min(partitions, tracked)), F.lit(tracked)).alias(f"top_{i}")
        for i, names in enumerate(keys)
    ]
    found = probe.agg(F.count(F.lit(1)).alias("rows"), *tops).head()
    return [
        [item["item"] for item in found[f"top_{i}"] or [] if item["count"] * partitions > found["rows"]]
        for i in range(len(keys))
    ]


def lookup_join(
    probe: DataFrame,
    table: DataFrame,
    keys: list[str],
    values: list[str],
    weight: Column,
    total: int,
    spread_by: list[str],
    frequent: Collection[int] = (),
    placed_by: str | None = None,
) -> DataFrame:
    """`probe` left join `table` on `keys`, adding `values`.

    `table` holds each key once, with a positive `weight` that sums to at most
    `total` within each group.  Hot keys, of which the weights allow fewer than
    1,000 per group, are looked up by broadcast, and so are the keys with a hash in
    `frequent`.  In the shuffled join that serves all other keys, rows with a hot
    or frequent key are placed by a hash of `spread_by` and so dealt out over the
    partitions.  A key that is frequent in `probe` only and is not named is left to adaptive
    skew joins, which cannot split a table that is bucketed.

    A table with a column STORED_HASH, the hash of `keys`, is bucketed by it and read without an exchange.  So is one that
    is bucketed by the text `placed_by`, one of the keys, which few rows have in common; it takes the place of the hash then.
    """
    short = F.octet_length(F.concat_ws("", *keys)) <= KEY_BYTES
    own = F.col(STORED_HASH) if STORED_HASH in table.columns else key_hash(keys)
    heavy = weight > int(HOT_FRACTION * total)
    is_hot = (heavy | own.isin(*frequent) if frequent else heavy) & short
    hot = table.filter(is_hot).select(
        *keys, *[F.col(v).alias(f"{_HOT}_{v}") for v in values], F.lit(True).alias(_HOT)
    )
    # The keys travel as one string.
    whole = F.concat(*[part for k in keys for part in (F.col(k).cast("string"), F.lit(_BETWEEN))])
    at = F.col(placed_by) if placed_by else own
    kept = [F.col(k).alias(f"_cold_{k}") for k in keys if k != placed_by] if placed_by else [whole.alias("_cold_keys")]
    cold = table.filter(~is_hot).select(at.alias(_HASH), *kept, *[F.col(v).alias(f"_cold_{v}") for v in values])
    # All of the table's rows with a frequent hash are hot, so a question of that hash is answered
    # by the broadcast or by nothing.
    asked = key_hash(keys).isin(*frequent) & short if frequent else F.lit(False)
    spread, found_at = F.xxhash64(*spread_by), key_hash(keys)
    if placed_by:
        # No key ends in this character, see `functions.grams.joinable`.
        spread, found_at = F.concat(spread.cast("string"), F.lit(_NOWHERE)), F.col(placed_by)
        found_at = F.coalesce(found_at, spread)
    tagged = probe.join(F.broadcast(hot), keys, "left").withColumn(
        _HASH, F.when(F.col(_HOT) | asked, spread).otherwise(found_at)
    )
    # The hash decides where a row goes and what it is compared with, the keys whether that matches; a
    # hot key is not in `cold`, so a hot row finds nothing wherever it lands.  Bounds in place of
    # equalities keep the join, its sorts and its exchanges on the one number.
    if placed_by:
        pairs = [(F.col(k), F.col(f"_cold_{k}")) for k in keys if k != placed_by]
    else:
        pairs = [(whole, F.col("_cold_keys"))]
    same_keys = reduce(Column.__and__, [(a >= b) & (a <= b) for a, b in pairs])
    return tagged.join(cold, (tagged[_HASH] == cold[_HASH]) & same_keys, "left").select(
        *probe.columns,
        *[F.coalesce(F.col(f"{_HOT}_{v}"), F.col(f"_cold_{v}")).alias(v) for v in values],
    )
