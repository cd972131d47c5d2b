"""As-of matching and other order-dependent steps that stay bounded for hot keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.functions.joins import null_safe_join


def last_known(events: DataFrame, history: DataFrame, by: list[str], on: str, known_on: str, value: Column, name: str = "known") -> DataFrame:
    """For each distinct (by, on) of the events: the greatest ``value`` of the history rows with ``known_on`` <= ``on``.

    Both sides are first reduced to one row for each key and day (map-side), so a key's group holds at most one row
    a calendar day from each side, however many rows the tables hold for it.  Rows with a null key or day match
    nothing: as events they come back with a null, in the history they are never known."""
    days = events.select(*by, F.col(on).alias("_day")).distinct().withColumn("_event", F.lit(True)).withColumn("_value", F.lit(None))
    known = history.where(F.col(known_on).isNotNull()).groupBy(*by, F.col(known_on).alias("_day")).agg(F.max(value).alias("_value")).withColumn("_event", F.lit(False))
    days = days.withColumn("_value", days["_value"].cast(known.schema["_value"].dataType))
    both = known.unionByName(days)
    frame = W.partitionBy(*by).orderBy(F.col("_day").asc_nulls_first()).rangeBetween(W.unboundedPreceding, W.currentRow)
    best = F.max("_value").over(frame)
    return both.withColumn(name, F.when(F.col("_day").isNotNull(), best)).where("_event").select(*by, F.col("_day").alias(on), name)


def forward_fill(events: DataFrame, history: DataFrame, by: list[str], on: str, known_on: str, columns: list[str], prefix: str = "") -> DataFrame:
    """As-of backward join that keeps every event row: the latest history row with ``known_on`` <= ``on`` (ties: the greatest).

    Only distinct days enter the window; the matched values are joined back by (by, on)."""
    matched = last_known(events, history, by, on, known_on, F.struct(F.col(known_on).alias("_since"), *columns), "_match")
    matched = matched.select(*by, on, F.col("_match._since").alias("known_since"), *(F.col("_match")[c].alias(prefix + c) for c in columns))
    return null_safe_join(events, matched, [*by, on], "left")


def lag_in_blocks(df: DataFrame, by: list[str], block: Column, order: list[str], column: str, name: str) -> DataFrame:
    """``lag(column)`` over (by, order) where a key may hold most of the rows: blocks of the order are lagged apart,
    and the first row of a block takes the last value of the block before it."""
    d = df.withColumn("_block", block)
    w = W.partitionBy(*by, "_block").orderBy(*order)
    d = d.withColumn("_lag", F.lag(F.struct(column)).over(w))
    last = d.groupBy(*by, "_block").agg(F.max(F.struct(*order, F.col(column).alias("_last"))).alias("_m"))
    carry = last.select(*by, "_block", F.lag("_m._last").over(W.partitionBy(*by).orderBy("_block")).alias("_carry"))
    value = F.when(F.col("_lag").isNotNull(), F.col("_lag")[column]).otherwise(F.col("_carry"))
    return null_safe_join(d, carry, [*by, "_block"], "left").select(*df.columns, value.alias(name))


def running_in_blocks(df: DataFrame, by: list[str], block: Column, order: list[str], value: Column, fold: Callable[[Column | str], Column], name: str) -> DataFrame:
    """``fold`` (a running aggregate such as max or bit_or) of ``value`` from the first row of ``by`` to each row, where a
    key may hold most of the rows: blocks are folded apart and combined with the fold of the blocks before them."""
    d = df.withColumns({"_block": block, "_value": value})
    inside = W.partitionBy(*by, "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    d = d.withColumn("_in", fold("_value").over(inside))
    whole = d.groupBy(*by, "_block").agg(fold("_value").alias("_all"))
    carry = whole.select(*by, "_block", fold("_all").over(W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)).alias("_carry"))
    joined = null_safe_join(d, carry, [*by, "_block"], "left")
    return joined.withColumn(name, F.when(F.col("_carry").isNull(), F.col("_in")).when(F.col("_in").isNull(), F.col("_carry")).otherwise(_combined(fold, F.col("_in"), F.col("_carry")))).select(*df.columns, name)


def _combined(fold: Callable, a: Column, b: Column) -> Column:
    if fold is F.max:
        return F.greatest(a, b)
    if fold is F.bit_or:
        return a.bitwiseOR(b)
    if fold is F.sum:
        return a + b
    raise ValueError("a fold is max, bit_or or sum")
