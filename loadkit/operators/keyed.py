"""Joins to a frame that has at most one row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegralType


def _hashed(left: DataFrame, right: DataFrame, key: str) -> Column | None:
    """What to hash of a key: equal keys must hash alike on both sides, so mixed types and floats are left out."""
    a, b = left.schema[key].dataType, right.schema[key].dataType
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return F.col(key).cast("bigint")
    return F.col(key) if a == b and not isinstance(a, (FloatType, DoubleType)) else None


def join_per_key(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join ``left`` to ``right``, grouped by ``keys`` beforehand, so that a hot left key is split.

    AQE splits a skewed left partition over tasks only if both inputs come
    straight from a shuffle made for the join. ``right`` is already partitioned
    by its keys, which would be reused and turn the splitting off; the extra
    hash column asks for its own shuffle of the (one row per key) right side.
    """
    hashed = [part for key in keys if (part := _hashed(left, right, key)) is not None]
    if not hashed:
        return left.join(right, keys, how)
    key_hash = F.xxhash64(*hashed)
    joined = left.withColumn("_key_hash", key_hash).join(
        right.withColumn("_key_hash", key_hash), [*keys, "_key_hash"], how
    )
    return joined.drop("_key_hash")
