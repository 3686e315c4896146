"""Reproducible sampling keys: a row's place depends on its id and the seed only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(method_id: Column, seed: int) -> Column:
    """32 hexadecimal digits, uniform over ids."""
    return F.md5(F.concat(F.lit(f"{seed}:"), method_id.cast("string")))


def sample_bucket(method_id: Column, seed: int, buckets: int) -> Column:
    digits = F.substring(sample_key(method_id, seed), 1, 8)
    return (F.conv(digits, 16, 10).cast("bigint") % buckets).cast("int")
