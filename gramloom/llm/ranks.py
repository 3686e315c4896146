"""Running sums and numbers over a total order, without one task per group.

Rows are dealt by ranges of (group, order), so that a group with a third of all
rows lies in as many partitions as its share asks for.  Totals of the parts,
one row per part and group, give each part its offset; the rest is a window
inside the part.  Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramloom.llm.common import shuffle_partitions, stage

_PART, _BEFORE, _OFFSET, _VALUE = "__part", "__before", "__offset", "__value"


def running_sum(frame: DataFrame, group: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Add `out`, the sum of `value` over the rows before this one in its group.

    `group` is a column without nulls.  `order` should order the rows of a group
    totally; rows equal in all of it change places freely.  `value` is a bigint
    without nulls.
    """
    parts = shuffle_partitions(frame.sparkSession)
    dealt = frame.withColumn(_VALUE, value).repartitionByRange(parts, group, *order)
    dealt = stage(dealt.withColumn(_PART, F.spark_partition_id()), "ranked")
    earlier = Window.partitionBy(group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(group, _PART)
        .agg(F.sum(_VALUE).alias(_VALUE))
        .select(group, _PART, F.coalesce(F.sum(_VALUE).over(earlier), F.lit(0)).alias(_OFFSET))
    )
    inside = Window.partitionBy(group, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn(_BEFORE, F.coalesce(F.sum(_VALUE).over(inside), F.lit(0)))
        .join(offsets, [group, _PART])
        .withColumn(out, F.col(_BEFORE) + F.col(_OFFSET))
        .drop(_PART, _BEFORE, _OFFSET, _VALUE)
    )


def numbered(frame: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Add `out`, the row's number from 0 within its group."""
    return running_sum(frame, group, order, F.lit(1).cast("bigint"), out)
