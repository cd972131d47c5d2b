"""Derived datasets over groups of symbols: industry indices, market breadth, suspensions, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators.asof import last_known
from lakeforge.operators.returns import returns, session_pairs

#: Classification levels and the length of their code prefix.
LEVELS = {"L1": 2, "L2": 4, "L3": 6}


def members_on(days: DataFrame, members: DataFrame) -> DataFrame:
    """symbol, trade_date and the industry code of the latest snapshot on or before it; days before the first are left out."""
    value = F.struct(F.col("as_of_date").alias("as_of_date"), "industry_code")
    found = last_known(days, members, ["symbol"], "trade_date", "as_of_date", value).where("known is not null")
    return found.select("symbol", "trade_date", "known.as_of_date", "known.industry_code")


def industry_index(priced: DataFrame, known: DataFrame, levels: dict[str, int] = LEVELS) -> DataFrame:
    """Equal- and amount-weighted returns by level.  priced: symbol, trade_date, ret, amount; known: ``members_on``.

    All levels come from one pass: each member row is expanded to its code prefixes and joined to its return."""
    long = known.select("symbol", "trade_date", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.substring("industry_code", 1, n).alias("industry_code")) for k, n in levels.items()))).alias("g"))
    amount = F.when(F.col("amount") >= 1, F.col("amount"))
    both = long.join(priced.where("ret is not null and not isnan(ret) and abs(ret) < double('infinity')").withColumn("amount", amount), ["symbol", "trade_date"], "left")
    weighted = F.when(F.col("ret").isNotNull() & F.col("amount").isNotNull(), F.col("ret") * F.col("amount"))
    weight = F.when(F.col("ret").isNotNull(), F.col("amount"))
    g = both.groupBy("trade_date", F.col("g.level").alias("level"), F.col("g.industry_code").alias("industry_code")).agg(
        F.countDistinct("symbol").alias("n_members"), F.count("ret").alias("n_priced"), F.avg("ret").alias("equal"), F.try_divide(F.sum(weighted), F.sum(weight)).alias("amount_ret"), F.coalesce(F.sum(weight), F.lit(0.0)).alias("amount")
    )
    g = g.withColumn("n_excluded", F.col("n_members") - F.col("n_priced"))
    out = F.array(F.struct(F.lit("equal").alias("weighting"), F.col("equal").alias("ret")), F.struct(F.lit("amount").alias("weighting"), F.col("amount_ret").alias("ret")))
    return g.withColumn("w", F.explode(out)).select("trade_date", "industry_code", "level", "w.weighting", "w.ret", "n_members", "n_priced", "n_excluded", "amount")


#: Names of the breadth metrics.
BREADTH = ("advance_count", "decline_count", "flat_count", "limit_up_count", "limit_down_count", "advance_ratio", "total_count")


def breadth(bars: DataFrame, calendar: DataFrame, limit: Column | float = 0.095) -> DataFrame:
    """trade_date, metric_id, value: counts over symbols traded that day with a bar on the session before.

    limit: the move that counts as a limit, a column where it depends on the symbol."""
    pairs = session_pairs(calendar).where("session_before is not null")
    before = bars.where("close > 0").select("symbol", F.col("trade_date").alias("session_before"), F.col("close").alias("prev_close"))
    today = bars.where("(volume > 0 or volume is null) and close is not null").join(F.broadcast(pairs), "trade_date").join(before, ["symbol", "session_before"])
    pct = (F.col("close") - F.col("prev_close")) / F.col("prev_close")
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    r = today.withColumn("pct", pct).withColumn("limit", limit).groupBy("trade_date").agg(
        F.count_if(F.col("pct") > 0).alias("advance_count"), F.count_if(F.col("pct") < 0).alias("decline_count"), F.count_if(F.col("pct") == 0).alias("flat_count"),
        F.count_if(F.col("pct") >= F.col("limit")).alias("limit_up_count"), F.count_if(F.col("pct") <= -F.col("limit")).alias("limit_down_count"), F.count(F.lit(1)).alias("total_count"),
    )
    r = r.withColumn("advance_ratio", F.coalesce(F.try_divide("advance_count", "total_count"), F.lit(0.0)))
    return r.unpivot("trade_date", [F.col(m).cast("double").alias(m) for m in BREADTH], "metric_id", "value")


def suspension_gaps(bars: DataFrame, instruments: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions in a symbol's active span without a traded bar.

    The span is cut into calendar positions and exploded by a sequence, so no pairs outside the span are ever formed."""
    traded = bars.where("volume > 0 or volume is null").select("symbol", "trade_date").distinct()
    names = traded.select("symbol").distinct()
    spans = bars.join(names, "symbol", "left_semi").groupBy("symbol").agg(F.min("trade_date").alias("bmin"), F.max("trade_date").alias("bmax"))
    active = spans.join(instruments.select("symbol", "list_date", "delist_date"), "symbol").select(
        "symbol", F.greatest(F.coalesce("list_date", "bmin"), "bmin").alias("astart"), F.least(F.coalesce("delist_date", "bmax"), "bmax").alias("aend")
    )
    days = active.where("astart <= aend").select("symbol", F.explode(F.sequence("astart", "aend")).alias("trade_date"))
    expected = days.join(F.broadcast(calendar.select("trade_date").distinct()), "trade_date", "left_semi")
    return expected.join(traded, ["symbol", "trade_date"], "left_anti").select("symbol", "trade_date", F.lit(False).alias("is_trading"), F.lit("suspended").alias("status"), F.lit("derived_bar_gap").alias("source"))


def evidence_rank(final_hour: int = 15, zone: str = "Asia/Shanghai") -> Column:
    """0: evidence of the session; 1: derived from gaps; 2: a later snapshot stamped onto the day."""
    local = F.from_utc_timestamp("fetched_at", zone)
    same = (F.to_date(local) == F.col("trade_date")) & (F.hour(local) >= final_hour)
    return F.when(F.col("source") == "eastmoney", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(2)).when(F.col("source") == "derived_bar_gap", 1).otherwise(0)


def merge_by_rank(rows: DataFrame, key: list[str], rank: Column) -> DataFrame:
    """The row of least rank for each key; ties by the latest fetch, then the greatest row."""
    rest = [c for c in rows.columns if c not in key]
    order = F.struct((-rank).alias("_r"), *(["fetched_at"] if "fetched_at" in rest else []), *(c for c in rest if c != "fetched_at"))
    return rows.groupBy(*key).agg(F.max(order).alias("_b")).select(*key, F.col("_b._r").alias("_neg"), *(F.col("_b")[c].alias(c) for c in rest)).withColumn("rank", -F.col("_neg")).drop("_neg")


def divergences(bars: DataFrame, factors: DataFrame, calendar: DataFrame) -> DataFrame:
    """Raw and adjusted returns of adjacent sessions and how far they part."""
    f = factors.where("adjust_type = 'hfq' and factor > 0").select("symbol", "trade_date", "factor")
    b = bars.where("(volume > 0 or volume is null) and close > 0").select("symbol", "trade_date", "close").join(f, ["symbol", "trade_date"])
    raw = returns(b.withColumn("adj", F.col("close") * F.col("factor")), "close").withColumnRenamed("ret", "raw_ret")
    adj = returns(raw, "adj", calendar).withColumnRenamed("ret", "adj_ret").where("adj_ret is not null")
    return adj.select("symbol", "trade_date", "prev_trade_date", "raw_ret", "adj_ret", F.abs(F.col("adj_ret") - F.col("raw_ret")).alias("divergence"))


def capped_findings(findings: DataFrame, by: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` findings of each check as rows, and one row that counts the rest."""
    n = F.row_number().over(W.partitionBy(by).orderBy(*order))
    ranked = findings.withColumn("rn", n)
    rest = ranked.where(F.col("rn") > cap).groupBy(by).agg(F.count(F.lit(1)).alias("hidden"))
    return ranked.where(F.col("rn") <= cap).drop("rn").withColumn("hidden", F.lit(0).cast("bigint")).unionByName(rest, allowMissingColumns=True)


def _stabbed(spans: DataFrame, as_of: DataFrame) -> DataFrame:
    """spans (with start_date and end_date, null for an open end) for each as_of date in [start_date, end_date).

    Dates are numbered, a span is turned into the numbers it holds and exploded, so no span meets a date outside it.  All
    tables of dates are bounded by the calendar."""
    dates = as_of.select("as_of_date").where("as_of_date is not null").distinct()
    number = dates.select("as_of_date", F.row_number().over(W.orderBy("as_of_date")).alias("_no"))
    days = spans.select(F.col("start_date").alias("_day")).unionByName(spans.select(F.col("end_date").alias("_day"))).where("_day is not null").distinct()
    marks = days.withColumn("_is", F.lit(0)).unionByName(dates.select(F.col("as_of_date").alias("_day"), F.lit(1).alias("_is")))
    # how many dates lie before a day: a date counts for the days after it
    before = marks.groupBy("_day").agg(F.max("_is").alias("_is")).select("_day", (F.sum("_is").over(W.orderBy("_day")) - F.col("_is")).alias("_before"))
    total = dates.agg(F.count(F.lit(1)).alias("_total"))
    lo, hi = (F.broadcast(before.select(F.col("_day").alias(c), F.col("_before").alias(n))) for c, n in (("start_date", "_lo"), ("end_date", "_hi")))
    placed = spans.where("start_date is not null").join(lo, "start_date").join(hi, "end_date", "left").join(F.broadcast(total)).withColumn("_hi", F.when(F.col("end_date").isNull(), F.col("_total")).otherwise(F.col("_hi")))
    held = placed.where("_lo < _hi").select(*spans.columns, F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))).alias("_no"))
    return held.join(F.broadcast(number), "_no").drop("_no")


def latest_intervals(starts: DataFrame, as_of: DataFrame) -> DataFrame:
    """For each as_of and symbol the latest row that starts on or before it (open-ended intervals)."""
    rest = [c for c in starts.columns if c not in ("symbol", "start_date")]
    one = starts.where("start_date is not null").groupBy("symbol", "start_date").agg(F.max(F.struct(*rest)).alias("r"))
    spans = one.withColumn("end_date", F.lead("start_date").over(W.partitionBy("symbol").orderBy("start_date")))
    return _stabbed(spans, as_of).select("symbol", "as_of_date", "start_date", *(F.col("r")[c].alias(c) for c in rest))


def stabbed_intervals(intervals: DataFrame, as_of: DataFrame) -> DataFrame:
    """Half-open intervals [start_date, end_date) that hold each as_of; an open end holds for good."""
    return _stabbed(intervals.select("*"), as_of).distinct()


def month_ends(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy(F.trunc("trade_date", "month").alias("month_date")).agg(F.max("trade_date").alias("last_date"))


def unions(parts: list[DataFrame]) -> DataFrame:
    """By name, missing columns null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
