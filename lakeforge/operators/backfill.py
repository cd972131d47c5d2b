"""What a backfill still has to do, as frames: days, symbols, routes, and the merges that keep what was not computed anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def due_days(calendar: DataFrame, have: DataFrame, start: str, end: str, flush: int = 60) -> DataFrame:
    """trade_date and batch (from 0): the sessions of the window without rows, in batches of ``flush`` that are staged at once."""
    day = F.col("trade_date")
    todo = calendar.where(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))).select("trade_date").distinct().join(have.select("trade_date").distinct(), "trade_date", "left_anti")
    return todo.withColumn("batch", F.floor((F.row_number().over(W.orderBy("trade_date")) - 1) / flush).cast("int"))  # one row a session


def expected_ends(universe: DataFrame, instruments: DataFrame, start: str, end: str) -> DataFrame:
    """symbol and expected_end: the last day its history should reach in the window; symbols outside it are left out."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    spans = universe.select("symbol").distinct().join(instruments.select("symbol", "list_date", "delist_date"), "symbol", "left")
    inside = ~F.coalesce((F.col("list_date") > e) | (F.col("delist_date") < s), F.lit(False))
    return spans.where(inside).select("symbol", F.least(F.coalesce("delist_date", e), e).alias("expected_end"))


def symbols_to_backfill(universe: DataFrame, instruments: DataFrame, rows: DataFrame, fields: list[str], start: str, end: str, dense: float = 0.9) -> DataFrame:
    """Symbols whose rows are missing, sparse in one of ``fields``, or end before they should."""
    filled = [F.count(f) / F.count(F.lit(1)) >= dense for f in fields]
    stats = rows.groupBy("symbol").agg(F.max("trade_date").alias("latest"), F.array(*filled).alias("filled"))
    due = expected_ends(universe, instruments, start, end).join(stats, "symbol", "left")
    done = F.col("latest").isNotNull() & F.forall("filled", lambda x: x) & (F.col("latest") >= F.col("expected_end"))
    return due.where(~F.coalesce(done, F.lit(False))).select("symbol", "expected_end", F.col("latest").alias("latest_date"))


def ownership(symbols: DataFrame, instruments: DataFrame, start: str, end: str) -> DataFrame:
    """symbol and who fetches it for the window: no one (no data), the route of delisted names, or the general one."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    spans = symbols.select("symbol").distinct().join(instruments.select("symbol", "list_date", "delist_date"), "symbol", "left")
    route = F.when((F.col("list_date") > e) | (F.col("delist_date") < s), "expected_no_data").when(F.col("delist_date") <= e, "delegated_delisted").otherwise("generic")
    return spans.select("symbol", route.alias("route"))


def repaired_instruments(instruments: DataFrame, bars: DataFrame, retired: DataFrame) -> DataFrame:
    """Instruments with the listing spans that the bars of retired symbols show, where they are unknown; retired symbols that
    are not catalogued yet are added."""
    spans = bars.join(retired.select("symbol").distinct(), "symbol", "left_semi").groupBy("symbol").agg(F.min("trade_date").alias("_first"), F.max("trade_date").alias("_last"))
    both = instruments.join(spans, "symbol", "full")
    return both.select(
        "symbol", *(c for c in instruments.columns if c not in ("symbol", "list_date", "delist_date")), F.coalesce("list_date", "_first").alias("list_date"),
        F.coalesce("delist_date", F.date_add("_last", 1)).alias("delist_date"),
    )


def latest_slice(rows: DataFrame, on: str, keep: list[str], where: Column | None = None) -> DataFrame:
    """Distinct ``keep`` of the rows of the latest day (the latest constituents of an index, boards of the last snapshot)."""
    r = rows if where is None else rows.where(where)
    last = r.agg(F.max(on).alias(on))
    return r.join(F.broadcast(last), on).select(*keep).distinct()  # one row is sent


def complete_snapshots(rows: DataFrame, on: str, group: str, member: str, groups: int, least: int) -> DataFrame:
    """Snapshot days that hold ``groups`` groups of at least ``least`` members each."""
    each = rows.groupBy(on, group).agg(F.countDistinct(member).alias("members"))
    days = each.groupBy(on).agg(F.count(F.lit(1)).alias("groups"), F.min("members").alias("fewest"))
    return days.where((F.col("groups") >= groups) & (F.col("fewest") >= least))


def dates_replaced(existing: DataFrame, computed: DataFrame, on: str) -> DataFrame:
    """The computed rows, and the existing ones of the days that were not computed."""
    return existing.join(computed.select(on).distinct(), on, "left_anti").unionByName(computed, allowMissingColumns=True)
