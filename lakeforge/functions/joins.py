"""Joins on keys that may be null, safe against self-joins and clashing names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins on ``keys``, null meeting null; the keys come once, the other columns must not clash."""
    right = right.select(*(F.col(k).alias("_r_" + k) for k in keys), *(c for c in right.columns if c not in keys))
    on = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col("_r_" + k)) for k in keys))
    joined = left.join(right, on, how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how in ("full", "right"):
        # a key is null on one side only where that side is missing
        joined = joined.withColumns({k: F.coalesce(k, "_r_" + k) for k in keys})
    return joined.drop(*("_r_" + k for k in keys))


#: Buckets of ``possible``; they bound what it broadcasts: so many numbers at most, whatever the size of the tables.
BUCKETS = 1 << 20


def possible(df: DataFrame, keys: DataFrame, key: list[str], buckets: int = BUCKETS, others: bool = False) -> DataFrame:
    """The rows whose key may be one of ``keys``, and some others: those whose hash falls into a bucket of one of them.
    others: the rows that are surely none instead.

    For use before the shuffle of an exact step, which then moves few rows where the keys are few."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("_bucket")
    hit = keys.select(bucket).distinct()
    return df.select("*", bucket).join(F.broadcast(hit), "_bucket", "left_anti" if others else "left_semi").drop("_bucket")
