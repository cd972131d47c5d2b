"""Guards on a delivery before it is staged.  Each runs one aggregate and raises on the first fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.operators.groups import BREADTH


class CaptureError(ValueError):
    """A delivery that does not hold what was asked for."""


def covers_symbols(rows: DataFrame, asked: list[str], least: float = 1.0) -> DataFrame:
    have = {r.symbol for r in rows.where(F.col("symbol").isin(asked)).select("symbol").distinct().toLocalIterator()}  # at most the asked ones
    lacking = sorted(set(asked) - have)
    if len(have) < least * len(asked):
        raise CaptureError(f"{len(lacking)} of {len(asked)} symbols are missing, {lacking[0]} first")
    return rows


def within(rows: DataFrame, start: str, end: str, column: str = "trade_date") -> DataFrame:
    n = rows.agg(F.count_if(F.col(column).isNull() | ~F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("n")).first().n
    if n:
        raise CaptureError(f"{n} rows lie outside {start} to {end}")
    return rows


def of_day(rows: DataFrame, day: str, column: str = "trade_date") -> DataFrame:
    return within(rows, day, day, column)


def in_scope(rows: DataFrame, symbols: list[str], start: str, end: str, frequency: str | None = None) -> DataFrame:
    """Only asked symbols, days and frequency (minute and tick batches)."""
    within(rows, start, end)
    odd = ~F.col("symbol").isin(symbols)
    if frequency:
        odd = odd | (F.col("frequency") != frequency)
    n = rows.agg(F.count_if(F.coalesce(odd, F.lit(True))).alias("n")).first().n
    if n:
        raise CaptureError(f"{n} rows are of other symbols or frequencies")
    return rows


def sessions_complete(rows: DataFrame, calendar: DataFrame, start: str, end: str) -> DataFrame:
    """Every symbol has every session of the window."""
    n = calendar.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("trade_date").distinct().count()
    short = rows.groupBy("symbol").agg(F.countDistinct("trade_date").alias("n")).where(F.col("n") < n).orderBy("symbol").first()
    if short:
        raise CaptureError(f"{short.symbol} has {short.n} of {n} sessions")
    return rows


def breadth_complete(rows: DataFrame) -> DataFrame:
    bad = rows.groupBy("trade_date").agg(F.countDistinct("metric_id").alias("n")).where(F.col("n") < len(BREADTH)).first()
    if bad:
        raise CaptureError(f"{bad.trade_date} has {bad.n} of {len(BREADTH)} metrics")
    return rows


def slices_full(rows: DataFrame, by: list[str], column: str, least: int) -> DataFrame:
    """Slices of a snapshot with fewer than ``least`` distinct values were cut short; they are left out."""
    thin = rows.groupBy(*by).agg(F.countDistinct(column).alias("n")).where(F.col("n") < least).select(*by)
    return rows.join(thin, by, "left_anti")


def session_over(end: str, now: str, sessions: DataFrame) -> None:
    """Refuses a window whose last day is the exchange's own today, a session, and not settled yet.  now: an instant in UTC."""
    from pyspark.sql.types import DateType

    from lakeforge.functions.columns import session_final

    day = F.lit(end).cast(DateType())
    open_ = sessions.where(F.col("trade_date") == day).where(~session_final(day, F.lit(now).cast("timestamp"))).first()
    if open_:
        raise CaptureError(f"the session of {end} is not final at {now}")
