"""Canonical rows, price adjustment, universe and point-in-time reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.joins import null_safe_join
from lakeforge.operators.asof import last_known
from lakeforge.partitions import parse

PRICE_COLUMNS = ("open", "high", "low", "close", "price")

#: Code prefixes by exchange of the broad common-stock universe, and of what is kept out of it.
STOCK_PREFIXES = {"SH": ("60", "68"), "SZ": ("00", "30"), "BJ": ("92", "43", "83", "87")}
RESERVED_PREFIXES = {"SH": tuple(map(str, range(81, 90))), "SZ": tuple(map(str, range(81, 90)))}
RECEIPT_PREFIXES = {"SH": ("689",)}
FUND_PREFIXES = {"SH": ("51", "52", "56", "58"), "SZ": ("15", "16")}
#: Statuses that keep a symbol out of the tradable universe.
UNTRADABLE = ("st", "*st", "suspended")


class ReaderError(ValueError):
    """A read that cannot be answered as asked."""


class UniverseCoverageError(ValueError):
    """A strict universe lacks the rows it needs."""


def canonical(df: DataFrame, key: list[str]) -> DataFrame:
    """One row for each key: latest fetch, then greatest version, then greatest row.  Without a key column: unchanged.

    Aggregated, not ranked, so repeats are folded before the shuffle."""
    if any(k not in df.columns for k in key):
        return df
    rest = [c for c in df.columns if c not in key]
    first = [c for c in ("fetched_at", "data_version") if c in rest]
    order = [*first, *(c for c in rest if c not in first)]
    if not order:
        return df.distinct()
    return df.groupBy(*key).agg(F.max(F.struct(*order)).alias("_row")).select(*key, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def traded(df: DataFrame) -> DataFrame:
    """Rows with volume; a null volume (files without the column) counts as traded."""
    return df.where("volume > 0 or volume is null")


def date_range(df: DataFrame, column: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive window; string columns hold quarter labels and are compared by the quarter of the bounds."""
    if column not in df.columns:
        return df
    text = dict(df.dtypes)[column] == "string"
    bound = lambda d: F.concat(F.year(F.lit(d).cast("date")), F.lit("Q"), F.quarter(F.lit(d).cast("date"))) if text else F.lit(d).cast("date")
    if start:
        df = df.where(F.col(column) >= bound(start))
    return df.where(F.col(column) <= bound(end)) if end else df


def symbols_in(df: DataFrame, symbols: list[str] | None) -> DataFrame:
    """An empty list is no filter."""
    return df.where(F.col("symbol").isin(symbols)) if symbols and "symbol" in df.columns else df


def adjusted(bars: DataFrame, factors: DataFrame, how: str = "hfq", anchor: str = "window", strict: bool = False) -> DataFrame:
    """Adds adj_<price> and adj_is_exact.  qfq divides by the anchor: the symbol's factor last known on its last bar in
    the window, or (anchor="global") its last factor at all.  A bar without a factor takes 1 and is inexact."""
    f = factors.where("adjust_type = 'hfq'").select("symbol", "trade_date", "factor")
    exact = bars.join(f, ["symbol", "trade_date"], "left")
    ratio = F.col("factor")
    if how == "qfq":
        if anchor == "global":
            anchors = f.groupBy("symbol").agg(F.max_by("factor", "trade_date").alias("anchor"))
        else:
            ends = bars.groupBy("symbol").agg(F.max("trade_date").alias("last"))
            anchors = f.join(ends, "symbol").where("trade_date <= last").groupBy("symbol").agg(F.max_by("factor", "trade_date").alias("anchor"))
        exact = exact.join(anchors, "symbol", "left")
        ratio = F.try_divide("factor", "anchor")
    elif how != "hfq":
        raise ReaderError(f"no adjustment is named {how}")
    if strict and (gap := exact.where("factor is null").select("symbol", "trade_date").first()):
        raise ReaderError(f"no factor for {gap.symbol} on {gap.trade_date}")
    out = exact.withColumn("adj_is_exact", ratio.isNotNull()).withColumn("_ratio", F.coalesce(ratio, F.lit(1.0)))
    out = out.withColumns({"adj_" + c: F.col(c) * F.col("_ratio") for c in PRICE_COLUMNS if c in bars.columns})
    return out.drop("_ratio", "factor", "anchor")


def both_adjusted(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Adds hfq_<price>, qfq_<price> (by the symbol's last factor) and adj_is_exact in one pass.  A bar without a factor takes 1."""
    f = factors.where("adjust_type = 'hfq'").select("symbol", "trade_date", "factor")
    anchors = f.groupBy("symbol").agg(F.max_by("factor", "trade_date").alias("_anchor"))
    out = bars.join(f, ["symbol", "trade_date"], "left").join(anchors, "symbol", "left")
    ratio = F.try_divide("factor", "_anchor")
    prices = [c for c in PRICE_COLUMNS if c in bars.columns]
    out = out.withColumns({"hfq_" + c: F.col(c) * F.coalesce("factor", F.lit(1.0)) for c in prices} | {"qfq_" + c: F.col(c) * F.coalesce(ratio, F.lit(1.0)) for c in prices} | {"adj_is_exact": ratio.isNotNull()})
    return out.drop("factor", "_anchor")


def period_window(df: DataFrame, column: str, period: str) -> DataFrame:
    """Rows of one period by its label (day, month, quarter or year); columns that hold labels are compared as text."""
    if dict(df.dtypes)[column] == "string":
        return df.where(F.col(column) == period)
    p = parse(period)
    if p is None:
        raise ReaderError(f"{period} is no period")
    return date_range(df, column, p.start.isoformat(), p.end.isoformat())


def _starts(code: Column, exchange: Column, prefixes: dict[str, tuple[str, ...]]) -> Column:
    out = F.lit(False)
    for ex, ps in prefixes.items():
        out = out | ((exchange == ex) & code.rlike("^(" + "|".join(ps) + ")"))
    return out


def in_stock_universe(symbol: Column | str, prefixes: dict[str, tuple[str, ...]] = STOCK_PREFIXES) -> Column:
    """Symbols by code prefix of their exchange; reserved codes, depositary receipts and funds are out."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    code, ex = F.split_part(s, F.lit("."), F.lit(1)), F.split_part(s, F.lit("."), F.lit(-1))
    out = _starts(code, ex, RESERVED_PREFIXES) | _starts(code, ex, RECEIPT_PREFIXES) | _starts(code, ex, FUND_PREFIXES)
    return ~out & _starts(code, ex, prefixes)


def listed_on(day: Column | str) -> Column:
    """Listing day to delisting day, both inclusive; an unknown bound does not exclude."""
    d = F.col(day) if isinstance(day, str) else day
    return (F.col("list_date").isNull() | (F.col("list_date") <= d)) & (F.col("delist_date").isNull() | (F.col("delist_date") >= d))


def bad_status() -> Column:
    return ~F.coalesce("is_trading", F.lit(True)) | F.coalesce(F.lower(F.trim("status")).isin(*UNTRADABLE), F.lit(False))


def in_universe(bars: DataFrame, instruments: DataFrame, status: DataFrame | None, strict: bool = False, prefixes: dict[str, tuple[str, ...]] = STOCK_PREFIXES) -> DataFrame:
    """Bars of listed common stocks that are not kept out by their status of the day, with usable prices."""
    valid = instruments.where(in_stock_universe("symbol", prefixes)).select("symbol", "list_date", "delist_date")
    kept = bars.join(valid, "symbol").where(listed_on("trade_date")).drop("list_date", "delist_date")
    if status is None:
        if strict:
            raise UniverseCoverageError("a strict universe needs trading_status")
    else:
        if strict and (gap := uncovered_pairs(kept, status).first()):
            raise UniverseCoverageError(f"no status for {gap.symbol} on {gap.trade_date}")
        kept = kept.join(status.where(bad_status()).select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti")
    prices = [c for c in ("open", "high", "low", "close") if c in bars.columns]
    return kept.where(F.coalesce(F.least(*(F.col(c) for c in prices)) > 0, F.lit(True))) if len(prices) > 1 else kept


def uncovered_pairs(bars: DataFrame, status: DataFrame) -> DataFrame:
    """The (symbol, trade_date) of bars that no status row covers."""
    return bars.select("symbol", "trade_date").distinct().join(status.select("symbol", "trade_date"), ["symbol", "trade_date"], "left_anti")


def as_known(facts: DataFrame, key: list[str], as_of: str, items: list[str] | None = None, all_vintages: bool = False, start: str | None = None, end: str | None = None, date_column: str | None = None) -> DataFrame:
    """Point-in-time read: announced by ``as_of``; per fact the latest announcement unless all vintages are asked for; the
    window of the fact's own date applies after that."""
    known = facts.where(F.col("announce_date") <= F.lit(as_of).cast("date"))
    if items:
        known = known.where(F.col("item_code").isin(items))
    if not all_vintages:
        fact = [k for k in key if k != "announce_date"]
        rest = [c for c in facts.columns if c not in fact]
        order = ["announce_date", *(c for c in ("fetched_at", "data_version") if c in rest), *(c for c in rest if c not in ("announce_date", "fetched_at", "data_version"))]
        known = known.groupBy(*fact).agg(F.max(F.struct(*order)).alias("_row")).select(*fact, *(F.col("_row")[c].alias(c) for c in rest)).select(*facts.columns)
    return date_range(known, date_column, start, end) if date_column else known


def factor_on_bars(bars: DataFrame, steps: DataFrame) -> DataFrame:
    """As-of backward: each distinct bar day takes the latest step of its symbol, 1 before the first."""
    value = F.struct(F.col("trade_date").alias("since"), F.col("factor"))
    found = last_known(bars, steps, ["symbol"], "trade_date", "trade_date", value)
    return found.select("symbol", "trade_date", F.coalesce("known.factor", F.lit(1.0)).alias("factor"))


def gap_fill(incoming: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Only the incoming rows whose key the lake lacks."""
    return null_safe_join(incoming, existing.select(*key).distinct(), key, "left_anti")
