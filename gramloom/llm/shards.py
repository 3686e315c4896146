"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Items are groups of equal texts.  A group goes to the shard where the dot
product of its sizes with the residual capacities is highest, sizes being
measured as parts of a shard's capacity.  Groups too large for a shard are cut
first.  The few groups that weigh a noticeable part of a shard are placed
one after another, largest first; the many light ones are placed by each
partition on its own, against its own share of what the heavy ones left, so
that no list of all groups comes together anywhere.

The law is `bytes`: shards are near equal in bytes.  Null text: no bytes, size
1; all null texts are one group, apart from empty ones.  Repeated rows are
members of their group like any other, and rows of a group that is cut are dealt in turn, so null
and repeated ids do not unbalance the shards.  Shards that tie are taken in their order.  A text of
any length is one item of its size; the longest bounds how near to equal shards can be.  Empty table: no rows.  Only doc_id
and text are read, so other columns cannot clash.  Texts are read once and
never shuffled: a group is known by the SHA-256 of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramloom.llm import ranks
from gramloom.llm.common import size_words, stage

SHARDS = 8
#: A group is heavy from this part of a shard's capacity on, in any dimension:
#: of three dimensions fewer than 3 * SHARDS / HEAVY groups can be.
HEAVY = 1 / 512
#: A group larger than this part of a capacity is cut into pieces that are not, as many for
#: each shard; so is a group whose rows or tokens exceed its bytes by the second part.
PIECE = 1 / 2
LOPSIDED = 1 / 8

DIMENSIONS = ("bytes", "tokens", "rows")
#: Bytes, which the law is about, weigh most in the dot product.
WEIGHTS = np.array([1.0, 0.5, 0.5])


def best_shard(item: np.ndarray, residual: np.ndarray) -> int:
    """The shard of highest dot product; the lowest number wins a tie."""
    return int(np.argmax(residual @ (item * WEIGHTS)))


def place(items: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Shard of each item in turn; rows of `capacity` are shards, and are used up.

    Sizes and capacities are in parts of a mean shard's capacity.
    """
    out = np.empty(len(items), np.int32)
    for i, item in enumerate(items):
        out[i] = s = best_shard(item, capacity)
        capacity[s] -= item
    return out


def _sizes(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        "doc_id",
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("group"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("bytes"),
        size_words(text).alias("tokens"),
        F.lit(1).cast("bigint").alias("rows"),
        F.crc32(F.coalesce(F.encode(text, "utf-8"), F.lit(b""))).alias("text_crc32"),
    )


def _place_light(batches: Iterator[pa.RecordBatch], mean: np.ndarray, residual: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Place the groups of one partition; its capacities add up to what it holds."""
    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or not table.num_rows:
        return
    sizes = np.stack([table[d].to_numpy() for d in DIMENSIONS], 1) / mean
    order = np.argsort(-sizes.max(1), kind="stable")
    left = np.maximum(residual, 0)
    whole = np.maximum(left.sum(0), 1e-12)
    shards = np.empty(len(order), np.int32)
    shards[order] = place(sizes[order], left / whole * sizes.sum(0))
    yield pa.RecordBatch.from_arrays(
        [table["group"].combine_chunks(), table["piece"].combine_chunks(), pa.array(shards)], ["group", "piece", "shard"]
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    What comes to the driver is the heavy groups: by their definition fewer
    than 3 * shards / HEAVY, whatever the table's size.
    """
    rows = stage(_sizes(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    groups = rows.groupBy("group").agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    totals = rows.agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMENSIONS]).head()
    mean = np.array([max(totals[d], 1) for d in DIMENSIONS], float) / shards
    parts = [F.col(d) / F.lit(float(m)) for d, m in zip(DIMENSIONS, mean, strict=True)]
    part = F.greatest(*parts)
    split = (part > PIECE) | (part - parts[0] > LOPSIDED)
    groups = stage(groups.withColumns({"part": part, "split": split}), "groups")
    cut = groups.filter("split").select("group", (F.ceil(F.col("part") / (PIECE * shards)) * shards).cast("int").alias("pieces"))
    # Rows of a cut group are numbered and dealt to its pieces in turn, whatever their ids; at most
    # 3 * shards / LOPSIDED groups are cut.
    hot = ranks.numbered(rows.join(F.broadcast(cut), "group"), "group", ["row"], "number")
    hot = stage(hot.withColumn("piece", F.pmod("number", "pieces").cast("int")).drop("number", "pieces"), "cut-rows")
    cold = rows.join(F.broadcast(cut), "group", "left_anti").withColumn("piece", F.lit(0))
    cut_items = hot.groupBy("group", "piece").agg(*[F.sum(d).alias(d) for d in DIMENSIONS])
    whole = groups.filter((F.col("part") >= HEAVY) & ~F.col("split")).select(
        "group", F.lit(0).alias("piece"), *DIMENSIONS
    )
    heavy = cut_items.unionByName(whole).orderBy(*[F.desc(d) for d in DIMENSIONS], "group", "piece").collect()
    capacity = np.ones((shards, len(DIMENSIONS)))
    sizes = np.array([[r[d] for d in DIMENSIONS] for r in heavy], float).reshape(-1, len(DIMENSIONS)) / mean
    order = np.argsort(-sizes.max(1, initial=0), kind="stable")
    chosen = place(sizes[order], capacity)
    spark = docs.sparkSession
    schema = "group string, piece int, shard int"
    placed = spark.createDataFrame(
        [(heavy[i]["group"], heavy[i]["piece"], int(s)) for i, s in zip(order, chosen, strict=True)], schema
    )
    light = groups.filter((F.col("part") < HEAVY) & ~F.col("split")).select("group", F.lit(0).alias("piece"), *DIMENSIONS)
    light = light.mapInArrow(lambda batches: _place_light(batches, mean, capacity), schema)
    placed = stage(placed.unionByName(light), "placed")
    dealt = hot.unionByName(cold).join(placed, ["group", "piece"])
    numbered = ranks.numbered(dealt, "shard", ["doc_id", "group", "row"], "slot")
    return numbered.select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )
