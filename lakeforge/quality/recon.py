"""Reconciliation of derived data and history against what is known elsewhere.  Each check returns rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.quality import checks as Q

#: Fixed value: words of a change of share structure that moves prices without a dividend.
STRUCTURAL = "缩股|减资|合股|并股|拆股"
#: The weightings of an industry index, and how far medians of intraday to daily totals may stray.
WEIGHTINGS = ("amount", "equal")
BANDS = {"minute": (0.95, 1.05), "tick_volume": (0.998, 1.002), "tick_amount": (0.995, 1.005)}


def structural_changes(structure: DataFrame) -> DataFrame:
    return structure.where(F.coalesce(F.col("change_reason").rlike(STRUCTURAL), F.lit(False))).select("symbol", "change_date").distinct()


def unexplained(divergences: DataFrame, structure: DataFrame, instruments: DataFrame) -> DataFrame:
    """Divergences without an event and why: a change of share structure on the day, a delisted symbol (whose events no
    source delivers any more), or none."""
    known = structural_changes(structure).withColumn("_known", F.lit(True)).withColumnRenamed("change_date", "trade_date")
    gone = instruments.where("delist_date is not null").select("symbol", F.lit(True).alias("_gone"))
    both = divergences.join(known, ["symbol", "trade_date"], "left").join(gone, "symbol", "left")
    return both.withColumn("bucket", F.when(F.col("_known"), "share_structure").when(F.col("_gone"), "delisted").otherwise("active")).drop("_known", "_gone")


def st_by_name(instruments: DataFrame) -> DataFrame:
    """Stocks whose short name says special treatment."""
    name = F.upper(F.replace("name", F.lit(" "), F.lit("")))
    return instruments.where((F.col("asset_type") == "stock") & name.contains("ST")).select("symbol").distinct()


def calendar_horizon(calendar: DataFrame, table_end: Column) -> DataFrame:
    """One row where sessions are marked beyond the end of the table of holidays."""
    last = calendar.where("is_trading").agg(F.max("trade_date").alias("last_date"))
    return last.withColumn("table_end", table_end).where("last_date > table_end").withColumn("days_beyond", F.datediff("last_date", "table_end"))


def index_findings(index: DataFrame) -> DataFrame:
    """check and n: rows of unknown weighting, groups without both weightings, repeated keys, rows whose counts do not add up."""
    group = ["trade_date", "industry_code", "level"]
    count = lambda df, name: df.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("n"))
    v = [F.col(c) for c in ("n_members", "n_priced", "n_excluded")]
    broken = (v[0] < 0) | (v[1] < 0) | (v[2] < 0) | (v[1] > v[0]) | (v[2] != v[0] - v[1]) | F.isnan("ret") | (F.abs("ret") == float("inf"))
    for c in (*group, "weighting", "n_members", "n_priced", "n_excluded"):
        broken = F.col(c).isNull() | F.coalesce(broken, F.lit(False))
    parts = [
        count(index.where(~F.col("weighting").isin(*WEIGHTINGS)), "industry_index_unknown_weighting"),
        count(index.groupBy(*group).agg(F.countDistinct("weighting").alias("w")).where(F.col("w") != len(WEIGHTINGS)), "industry_index_incomplete_weightings"),
        count(Q.duplicate_keys(index, [*group, "weighting"]), "industry_index_duplicate_key"),
        count(index.where(broken), "industry_index_invalid_accounting"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("n > 0")


def intraday_ratios(inner: DataFrame, daily: DataFrame, low: float = BANDS["minute"][0], high: float = BANDS["minute"][1], least: int = 20) -> DataFrame:
    """metric, symbol_days, median and verdict (ok, high, low or too_few) of intraday to daily volume and amount.

    inner: symbol, trade_date, volume, amount.  Daily rows count in shares only (data_version v2)."""
    i = inner.groupBy("symbol", "trade_date").agg(F.sum("volume").alias("iv"), F.sum("amount").alias("ia")).where("iv > 0")
    d = daily.where("volume > 0 and data_version = 'v2'").select("symbol", "trade_date", F.col("volume").alias("dv"), F.col("amount").alias("da"))
    both = i.join(d, ["symbol", "trade_date"])
    each = F.array(F.struct(F.lit("volume").alias("metric"), (F.col("iv") / F.col("dv")).alias("r")), F.struct(F.lit("amount").alias("metric"), F.when(F.col("da") > 0, F.col("ia") / F.col("da")).alias("r")))
    m = both.select(F.explode(each).alias("x")).where("x.r is not null").groupBy("x.metric").agg(F.count(F.lit(1)).alias("symbol_days"), F.median("x.r").alias("median"))
    return m.withColumn("verdict", F.when(F.col("symbol_days") < least, "too_few").when(F.col("median") > high, "high").when(F.col("median") < low, "low").otherwise("ok"))


def misdated(rows: DataFrame, time: str = "trade_time") -> DataFrame:
    """Per trade_date: rows whose time lies on another day."""
    return rows.where(F.to_date(time) != F.col("trade_date")).groupBy("trade_date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("symbols"))


def sampled_differences(primary: DataFrame, backup: DataFrame, key: list[str], fields: list[str], n: int = 500) -> DataFrame:
    """Field differences of the same ``n`` shared keys each time."""
    shared = primary.select(*key).distinct().join(backup.select(*key).distinct(), key, "left_semi")
    asked = Q.spread_sample(shared, key, n)
    return Q.field_drift(primary.join(F.broadcast(asked), key, "left_semi"), backup.join(F.broadcast(asked), key, "left_semi"), key, fields)  # n keys are sent


def validity(bars: DataFrame, calendar: DataFrame, receipts: DataFrame, universe: DataFrame, delisted: DataFrame, start: str, end: str) -> DataFrame:
    """check, passed and n (what is missing): whether a window of history can carry research on all names.

    The bars hold the window; no session in it lacks bars; a receipt proves the labels of all names of the universe over the
    window; every terminated symbol (``delisted``: symbol, state) is verified."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    span = bars.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    window = span.select(F.lit("daily_bars_window").alias("check"), F.coalesce((s <= e) & (F.col("lo") <= s) & (F.col("hi") >= e), F.lit(False)).alias("passed"), F.lit(0).cast("bigint").alias("n"))
    sessions = calendar.where(F.col("trade_date").between(s, e)).select("trade_date").distinct()
    holes = sessions.join(bars.select("trade_date").distinct(), "trade_date", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    proofs = Q.receipt_coverage(receipts, universe, s, e).agg(F.count(F.lit(1)).alias("n"))
    ends = delisted.where("state <> 'verified'").agg(F.count(F.lit(1)).alias("n"))
    row = lambda df, name, ok: df.select(F.lit(name).alias("check"), ok.alias("passed"), F.col("n"))
    n = F.col("n")
    return window.unionByName(row(holes, "daily_bars_interior_coverage", n == 0)).unionByName(row(proofs, "historical_st_labels", n > 0)).unionByName(row(ends, "delisted_universe", n == 0))
