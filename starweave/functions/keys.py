"""Deterministic surrogate keys (never monotonically_increasing_id, which is
not stable when a task is retried)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def surrogate_key(df: DataFrame, natural_key: str) -> Column:
    """Integral natural keys pass through; other keys are hashed with
    xxhash64 (audit Q1 on the key catches a collision)."""
    dtype = df.schema[natural_key].dataType
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.col(natural_key).cast("long")
    return F.xxhash64(F.col(natural_key))
