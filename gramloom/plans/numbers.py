"""Dense row numbers over a total order, without one task for all rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramloom.plans.scratch import SPLIT, write_table

_ROW, _PART = "_row", "_part"
#: Row ids count from 0 within a partition, whose number stands in the bits above these.
_PART_BITS = 33


def numbered(
    frame: DataFrame, order: list[str], name: str, through: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Add `name`, the row's number from 0 in the order of `order`, as a table on shared storage.

    Rows are dealt by ranges and sorted there, so a number is the rows of all parts before its own, one
    count per part, and the row's place in its part.  `through` maps and filters the dealt rows before
    they are numbered, so costly expressions run once, in as many tasks as there are parts.  Rows equal in
    all of `order` are in no stated order; nulls come first.
    """
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    table = write_table(through(dealt).withColumn(_ROW, F.monotonically_increasing_id()), "numbered", SPLIT)
    part = F.shiftright(_ROW, _PART_BITS)
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, of which a job has as many as it has tasks.
    parts = table.groupBy(part.alias(_PART)).count()
    parts = parts.select(_PART, F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col(_ROW).bitwiseAND(F.lit(2**_PART_BITS - 1))
    rows = table.withColumn(_PART, part).join(F.broadcast(parts), _PART)
    return rows.withColumn(name, number).drop(_ROW, _PART, "_before")
