"""The best row of a group by a fixed order, field by field.

Defined results: null keys form groups like others; a field without any value in a group has no row; exact repeats change
nothing; unknown sources rank last; null versions and fetch times rank lowest; remaining ties go to the greatest source
name.  One aggregation with partial maxima before the shuffle, so a hot group costs no more than its rows' scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.columns import version_number

WORST_RANK = 1 << 30
NEVER = -(1 << 62)


def with_trust(rows: DataFrame, trust: DataFrame) -> DataFrame:
    """Adds ``_trust``: the source's least rank, or the worst."""
    ranks = trust.where("source is not null").groupBy("source").agg(F.min("trust_rank").alias("_known"))
    return rows.join(ranks, "source", "left").withColumn("_trust", F.coalesce(F.col("_known").cast("bigint"), F.lit(WORST_RANK).cast("bigint"))).drop("_known")


def fetch_order() -> Column:
    return F.coalesce(F.unix_micros("fetched_at"), F.lit(NEVER))


def ranked(rows: DataFrame, trust: DataFrame) -> DataFrame:
    """Adds ``_rank``, greatest for the best row: highest version, smallest trust rank, latest fetch."""
    order = F.struct(
        F.coalesce(version_number("data_version"), F.lit(-1)).alias("n"), F.coalesce("data_version", F.lit("")).alias("v"), (-F.col("_trust")).alias("t"), fetch_order().alias("f"), F.coalesce("source", F.lit("")).alias("s")
    )
    return with_trust(rows, trust).withColumn("_rank", order).drop("_trust")


def best_values(rows: DataFrame, key: list[str], field: str, trust: DataFrame) -> DataFrame:
    """Key and the field's value in the best row that has it; groups without one are left out."""
    best = ranked(rows, trust).where(F.col(field).isNotNull()).groupBy(*key).agg(F.max(F.struct("_rank", F.col(field).alias("_value"))).alias("_b"))
    return best.select(*key, F.col("_b._value").alias(field))
