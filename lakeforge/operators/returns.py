"""Returns and other series over session-ordered bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

def by_symbol() -> WindowSpec:
    return W.partitionBy("symbol").orderBy("trade_date")


def session_pairs(calendar: DataFrame) -> DataFrame:
    """trade_date and the session before it.  One row a calendar day: a table bounded by the calendar, not by the data."""
    return calendar.select("trade_date").distinct().select("trade_date", F.lag("trade_date").over(W.orderBy("trade_date")).alias("session_before"))


def returns(bars: DataFrame, price: str = "close", adjacent: DataFrame | None = None) -> DataFrame:
    """Adds prev_trade_date and ret.  adjacent: a calendar; returns across a missed session are then null."""
    out = bars.withColumn("prev_trade_date", F.lag("trade_date").over(by_symbol())).withColumn("ret", F.try_divide(price, F.lag(price).over(by_symbol())) - 1)
    if adjacent is None:
        return out
    out = out.join(F.broadcast(session_pairs(adjacent)), "trade_date", "left")
    return out.withColumn("ret", F.when(F.col("prev_trade_date") == F.col("session_before"), F.col("ret"))).drop("session_before")


def cumulative_return(bars: DataFrame, price: str = "close") -> DataFrame:
    """Return since the symbol's first bar with a price."""
    first = F.first(price, ignorenulls=True).over(by_symbol().rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return bars.withColumn("cumulative_return", F.try_divide(price, first) - 1)


def percentile_of_history(bars: DataFrame, value: str) -> DataFrame:
    """Share of the symbol's other readings below this one; nulls rank nowhere."""
    given = bars.where(F.col(value).isNotNull())
    return given.withColumn("percentile", F.percent_rank().over(W.partitionBy("symbol").orderBy(value)))


def step_ratios(factors: DataFrame, factor: float = 20.0) -> DataFrame:
    """The worst step of each symbol and type whose ratio is beyond ``factor`` either way."""
    before = F.lag("factor").over(W.partitionBy("symbol", "adjust_type").orderBy("trade_date"))
    steps = factors.where("factor > 0").withColumn("ratio", F.col("factor") / before)
    steps = steps.withColumn("size", F.greatest("ratio", F.try_divide(F.lit(1.0), "ratio"))).where(F.col("size") > factor)
    return steps.groupBy("symbol", "adjust_type").agg(F.max(F.struct("size", "trade_date", "ratio")).alias("w")).select("symbol", "adjust_type", "w.trade_date", "w.ratio")


def resample(minutes: DataFrame, size: int, sessions: tuple[tuple[int, int], ...] = ((570, 690), (780, 900))) -> DataFrame:
    """OHLCV bars of ``size`` minutes from closing-minute bars, counted along the session, so that breaks never split or
    join a bar.  sessions: minutes of the day, (opening, closing].  Rows outside every session are left out."""
    minute = F.hour("bar_time") * 60 + F.minute("bar_time")
    ordinal, offset = None, 0
    for lo, hi in sessions:
        hit = (minute > lo) & (minute <= hi)
        ordinal = F.when(hit, minute - lo + offset) if ordinal is None else ordinal.when(hit, minute - lo + offset)
        offset += hi - lo
    rows = minutes.withColumn("bucket", F.ceil(ordinal / F.lit(size)).cast("int")).where("bucket is not null")
    return rows.groupBy("symbol", "trade_date", "bucket").agg(
        F.min_by("open", "bar_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_time").alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount"), F.max("bar_time").alias("bar_time")
    )


def minute_bars(ticks: DataFrame) -> DataFrame:
    """Closing-minute bars of ticks: a tick in minute m belongs to the bar that closes at m + 1."""
    close = F.date_trunc("minute", "trade_time") + F.expr("interval 1 minute")
    order = F.col("tick_seq")
    return ticks.where("price is not null and trade_time is not null").groupBy("symbol", "trade_date", close.cast("timestamp_ntz").alias("bar_time")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"), F.coalesce(F.sum(F.col("price") * F.col("volume")), F.lit(0.0)).alias("amount"),
    )
