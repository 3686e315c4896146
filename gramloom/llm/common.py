"""Words, shapes of inputs and settings that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.plans.scratch import write_table

#: A word is a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]+"

#: Rows of a narrow table that go to one file.
FILE_ROWS = 1 << 17


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(frame: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write an intermediate table to shared storage; its shuffle files go once it is written.

    Given about how many rows it has, it is written in no more files than these ask for, however many partitions there are.
    """
    if rows is not None:
        frame = frame.coalesce(1 + rows // FILE_ROWS)
    return write_table(frame, name)


def size_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unsigned(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64, copy=False).view(np.uint64)


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """First index of each run of equal keys, and the length at the end."""
    n = len(keys[0])
    if n == 0:
        return np.zeros(1, np.int64)
    new = np.zeros(n, bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.append(np.flatnonzero(new), n)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 17) -> Iterator[pa.Table]:
    """Tables of about `rows` rows out of sorted batches, never cut inside a run of equal keys."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        last = run_starts(*[table[k].to_numpy() for k in keys])[-2]
        if last:
            yield table.slice(0, last)
        held = table.slice(last).to_batches()
        count = table.num_rows - last
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Connected components of numbered rows, from links that come in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        root = self.root
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                return
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                above = root[root]
                if (above == root).all():
                    break
                root[:] = above
