"""Queries of the derived datasets on the test lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators import groups as G
from lakeforge.operators import readpath as R
from lakeforge.operators import returns as S
from lakeforge.operators.asof import forward_fill
from lakeforge.plans.problems import table
from lakeforge.plans.read_path import _ALL_A, TEST_PREFIXES, bars, calendar, factor_steps, factors, instruments, status
from lakeforge.plans.sqlparts import BARS, CALENDAR, FACTORS, INSTRUMENTS, MEMBERS, STATUS, STEPS, TICKS, with_parts


def members(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "industry_members"), ["symbol", "classification_system", "as_of_date"]).where("classification_system = 'sw'")


def ticks(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "trade_ticks").drop("file_id"), ["symbol", "trade_date", "tick_seq"])


def usable(spark: SparkSession, d: str) -> DataFrame:
    return R.traded(bars(spark, d)).where("close > 0 and close < 50000")


def factor_continuity(spark: SparkSession, d: str) -> DataFrame:
    return S.step_ratios(factors(spark, d).where("factor is not null"), 1.05).withColumn("ratio", F.round("ratio", 6))


def uncovered_symbols(spark: SparkSession, d: str) -> DataFrame:
    """Common stocks (no receipts, no funds) whose factors are missing or begin after their bars."""
    b = bars(spark, d).where(R.in_stock_universe("symbol", TEST_PREFIXES)).groupBy("symbol").agg(F.min("trade_date").alias("bar_date"))
    f = factors(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("factor_date"))
    return b.join(f, "symbol", "left").where("factor_date is null or factor_date > bar_date")


def retry_refresh_union(spark: SparkSession, d: str) -> DataFrame:
    """Symbols whose factors must be computed again: a step on their latest bars, or not covered."""
    last = R.traded(bars(spark, d)).groupBy("symbol").agg(F.max("trade_date").alias("last_date"))
    stepped = factor_steps(spark, d).join(last, "symbol").where(F.datediff("last_date", "trade_date") <= 90).select("symbol", F.lit("step").alias("why"))
    missing = uncovered_symbols(spark, d).where("factor_date is null").select("symbol", F.lit("uncovered").alias("why"))
    new = bars(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("f"), F.max("trade_date").alias("l")).where(F.datediff("l", "f") < 300).select("symbol", F.lit("new").alias("why"))
    return G.unions([stepped, missing, new]).distinct()


def returns_adjacent_sessions(spark: SparkSession, d: str) -> DataFrame:
    return S.returns(usable(spark, d), "close", calendar(spark, d)).where("ret is not null").select("symbol", "trade_date", "prev_trade_date", F.round("ret", 8).alias("ret"))


def cumulative_return(spark: SparkSession, d: str) -> DataFrame:
    return S.cumulative_return(usable(spark, d)).select("symbol", "trade_date", F.round("cumulative_return", 8).alias("cumulative_return"))


def percentile_history(spark: SparkSession, d: str) -> DataFrame:
    return S.percentile_of_history(usable(spark, d), "close").select("symbol", "trade_date", "close", F.round("percentile", 8).alias("percentile"))


def industry_members_asof(spark: SparkSession, d: str) -> DataFrame:
    return G.members_on(bars(spark, d), members(spark, d))


def industry_index_levels(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).where("weighting = 'equal'").select("trade_date", "level", "industry_code", F.round("ret", 8).alias("ret"), "n_members", "n_priced", "n_excluded")


def industry_index_weighted(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d).where("weighting = 'amount'").select("trade_date", "level", "industry_code", F.round("ret", 8).alias("ret"), F.round("amount", 1).alias("amount"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    priced = S.returns(usable(spark, d), "close", calendar(spark, d)).select("symbol", "trade_date", "ret", "amount")
    return G.industry_index(priced, industry_members_asof(spark, d).select("symbol", "trade_date", "industry_code"))


def industry_group_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Groups with members of which none has a return."""
    return _index(spark, d).where("weighting = 'equal' and n_priced = 0").select("trade_date", "level", "industry_code", "n_members")


def breadth_daily(spark: SparkSession, d: str) -> DataFrame:
    limit = F.when(F.col("symbol").endswith(".BJ"), 0.295).otherwise(0.095)
    return G.breadth(bars(spark, d), calendar(spark, d), limit).withColumn("value", F.round("value", 8))


def breadth_completeness(spark: SparkSession, d: str) -> DataFrame:
    from lakeforge.quality.checks import breadth_findings

    b = G.breadth(bars(spark, d), calendar(spark, d))
    holed = b.where(~((F.dayofmonth("trade_date") == 1) & (F.col("metric_id") == "flat_count")))
    return breadth_findings(holed).select("trade_date", "check")


def suspension_gaps(spark: SparkSession, d: str) -> DataFrame:
    return G.suspension_gaps(bars(spark, d), instruments(spark, d), calendar(spark, d)).select("symbol", "trade_date", "status", "source")


def suspension_merge_rank(spark: SparkSession, d: str) -> DataFrame:
    merged = G.merge_by_rank(table(spark, d, "trading_status"), ["symbol", "trade_date"], G.evidence_rank())
    return merged.select("symbol", "trade_date", "rank", "source", F.unix_seconds("fetched_at").alias("fetched_epoch"))


def traded_symbol_semi(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "trading_status").select("symbol", "trade_date").distinct()
    return s.join(R.traded(table(spark, d, "daily_bars")).select("symbol", "trade_date"), ["symbol", "trade_date"], "left_semi")


def recon_discontinuity(spark: SparkSession, d: str) -> DataFrame:
    v = G.divergences(usable(spark, d), factors(spark, d), calendar(spark, d)).where("abs(adj_ret) > 0.2 and divergence > 0.02")
    worst = v.groupBy("symbol").agg(F.max(F.struct("divergence", "trade_date", "adj_ret")).alias("w"))
    return worst.select("symbol", "w.trade_date", F.round("w.adj_ret", 6).alias("adj_ret"), F.round("w.divergence", 6).alias("divergence"))


def recon_missing_event(spark: SparkSession, d: str) -> DataFrame:
    """Divergences without a factor step between the two sessions."""
    return _explained(spark, d).where("not explained").select("symbol", "trade_date", F.round("divergence", 6).alias("divergence"))


def recon_explained(spark: SparkSession, d: str) -> DataFrame:
    return _explained(spark, d).where("explained").select("symbol", "trade_date", "step_date", F.round("divergence", 6).alias("divergence"))


def _explained(spark: SparkSession, d: str) -> DataFrame:
    v = G.divergences(usable(spark, d), factors(spark, d), calendar(spark, d)).where("divergence > 0.005")
    steps = factor_steps(spark, d).select("symbol", F.col("trade_date").alias("step_on"), "factor")
    found = forward_fill(v, steps, ["symbol"], "trade_date", "step_on", ["factor"]).withColumnRenamed("known_since", "step_date")
    return found.withColumn("explained", F.coalesce((F.col("step_date") > F.col("prev_trade_date")) & (F.col("step_date") <= F.col("trade_date")), F.lit(False)))


def recon_capped(spark: SparkSession, d: str) -> DataFrame:
    v = G.divergences(usable(spark, d), factors(spark, d), calendar(spark, d)).where("divergence > 0.001").withColumn("exchange", F.split_part("symbol", F.lit("."), F.lit(2)))
    v = v.withColumn("divergence", F.round("divergence", 8))
    return G.capped_findings(v.select("exchange", "symbol", "trade_date", "divergence"), "exchange", [F.col("divergence").desc(), F.col("symbol"), F.col("trade_date")], 5)


def minute_resample_15m(spark: SparkSession, d: str) -> DataFrame:
    r = S.resample(S.minute_bars(ticks(spark, d)), 15)
    return r.select("symbol", "trade_date", "bucket", "open", "high", "low", "close", "volume")


def minute_resample_60m(spark: SparkSession, d: str) -> DataFrame:
    r = S.resample(S.minute_bars(ticks(spark, d)), 60)
    return r.select("symbol", "trade_date", "bucket", "open", "high", "low", "close", "volume")


def survivorship_returns(spark: SparkSession, d: str) -> DataFrame:
    """Mean return of all symbols against that of symbols still listed, by exchange."""
    u = usable(spark, d).withColumn("exchange", F.split_part("symbol", F.lit("."), F.lit(2)))
    r = u.groupBy("symbol", "exchange").agg(F.min_by("close", "trade_date").alias("entry"), F.max_by("close", "trade_date").alias("exit")).join(instruments(spark, d).select("symbol", "delist_date"), "symbol")
    r = r.withColumn("ret", F.col("exit") / F.col("entry") - 1)
    out = r.groupBy("exchange").agg(F.count(F.lit(1)).alias("n"), F.avg("ret").alias("complete"), F.avg(F.when(F.col("delist_date").isNull(), F.col("ret"))).alias("survivors"))
    return out.select("exchange", "n", F.round("complete", 8).alias("complete"), F.round("survivors", 8).alias("survivors"), F.round(100 * (F.col("survivors") - F.col("complete")), 6).alias("gap_pp"))


def delisting_endings(spark: SparkSession, d: str) -> DataFrame:
    from lakeforge.quality.checks import ending_patterns

    return ending_patterns(usable(spark, d)).select("symbol", "last_trade_date", "bars", "halt_gap_days", F.round("worst_final_return", 8).alias("worst_final_return"), F.round("window_return", 8).alias("window_return"), "ending_pattern")


def interval_expand_latest(spark: SparkSession, d: str) -> DataFrame:
    starts = table(spark, d, "industry_members").where("classification_system = 'sw'").groupBy("symbol", F.col("as_of_date").alias("start_date")).agg(F.max("industry_code").alias("industry_code"))
    return G.latest_intervals(starts, month_end_sessions(spark, d).select(F.col("last_date").alias("as_of_date")))


def interval_expand_halfopen(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "industry_members").where("classification_system = 'sw'").groupBy("symbol", F.col("as_of_date").alias("start_date")).agg(F.max("industry_code").alias("industry_code"))
    spans = rows.withColumn("end_date", F.lead("start_date").over(W.partitionBy("symbol").orderBy("start_date")))
    return G.stabbed_intervals(spans, month_end_sessions(spark, d).select(F.col("last_date").alias("as_of_date"))).select("symbol", "industry_code", "as_of_date")


def month_end_sessions(spark: SparkSession, d: str) -> DataFrame:
    return G.month_ends(calendar(spark, d))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (
        factor_continuity, uncovered_symbols, retry_refresh_union, returns_adjacent_sessions, cumulative_return, percentile_history, industry_members_asof, industry_index_levels, industry_index_weighted,
        industry_group_gaps, breadth_daily, breadth_completeness, suspension_gaps, suspension_merge_rank, traded_symbol_semi, recon_discontinuity, recon_missing_event, recon_explained, recon_capped,
        minute_resample_15m, minute_resample_60m, survivorship_returns, delisting_endings, interval_expand_latest, interval_expand_halfopen, month_end_sessions,
    )
    return {f.__name__: f for f in fs}


_USABLE = f"select * from ({BARS}) where (volume > 0 or volume is null) and close > 0 and close < 50000"
_PAIRS = f"select trade_date, lag(trade_date) over (order by trade_date) as session_before from ({CALENDAR})"
_RETURNS = """select u.*, case when prev_trade_date = session_before then close / prev_close - 1 end as ret from
  (select *, lag(trade_date) over (partition by symbol order by trade_date) as prev_trade_date, lag(close) over (partition by symbol order by trade_date) as prev_close from usable) u left join pairs using (trade_date)"""
_MEMBERS_ON = f"""select b.symbol, b.trade_date, m.as_of_date, m.industry_code from (select distinct symbol, trade_date from daily_bars) b asof join
  (select * from ({MEMBERS}) where classification_system = 'sw' and as_of_date is not null) m on b.symbol = m.symbol and b.trade_date >= m.as_of_date"""
_INDEX = """select trade_date, level, industry_code, count(distinct symbol) as n_members, count(ret) as n_priced, avg(ret) as equal_ret,
  sum(case when amount >= 1 then ret * amount end) / nullif(sum(case when ret is not null and amount >= 1 then amount end), 0) as amount_ret, coalesce(sum(case when ret is not null and amount >= 1 then amount end), 0.0) as amount
  from (select k.symbol, k.trade_date, l.level, substr(k.industry_code, 1, l.n) as industry_code, ret, amount from known k cross join (values ('L1', 2), ('L2', 4), ('L3', 6)) l(level, n) left join returns using (symbol, trade_date)) group by all"""
_DIVERGENCES = f"""select symbol, trade_date, prev_trade_date, raw_ret, adj_ret, abs(adj_ret - raw_ret) as divergence from (
  select symbol, trade_date, prev_trade_date, close / prev_close - 1 as raw_ret, case when prev_trade_date = session_before then close * factor / (prev_close * prev_factor) - 1 end as adj_ret from (
  select symbol, trade_date, close, factor, lag(trade_date) over w as prev_trade_date, lag(close) over w as prev_close, lag(factor) over w as prev_factor from usable
  join (select symbol, trade_date, factor from ({FACTORS}) where adjust_type = 'hfq' and factor > 0) f using (symbol, trade_date) window w as (partition by symbol order by trade_date)) left join pairs using (trade_date)) where adj_ret is not null"""
_EXPLAINED = "select v.*, s.trade_date as step_date, coalesce(s.trade_date > v.prev_trade_date and s.trade_date <= v.trade_date, false) as explained from (select * from divergences where divergence > 0.005) v asof left join steps s on v.symbol = s.symbol and v.trade_date >= s.trade_date"
_UNCOVERED = f"select * from (select symbol, min(trade_date) as bar_date from daily_bars where {_ALL_A} group by 1) left join (select symbol, min(trade_date) as factor_date from adj_factors group by 1) using (symbol) where factor_date is null or factor_date > bar_date"
_MONTHS = f"select cast(date_trunc('month', trade_date) as date) as month_date, max(trade_date) as last_date from ({CALENDAR}) group by 1"
_SW = "select symbol, as_of_date as start_date, max(industry_code) as industry_code from industry_members where classification_system = 'sw' group by 1, 2"


def _breadth(limit: str) -> str:
    return f"""select trade_date, count(*) filter (pct > 0) as advance_count, count(*) filter (pct < 0) as decline_count, count(*) filter (pct = 0) as flat_count, count(*) filter (pct >= lim) as limit_up_count,
  count(*) filter (pct <= -lim) as limit_down_count, count(*) as total_count, count(*) filter (pct > 0) / count(*) as advance_ratio from (select t.trade_date, (t.close - p.close) / p.close as pct, {limit} as lim from ({BARS}) t join pairs on t.trade_date = pairs.trade_date
  join ({BARS}) p on p.symbol = t.symbol and p.trade_date = pairs.session_before where p.close > 0 and t.close is not null and (t.volume > 0 or t.volume is null)) group by 1"""


def _resample(size: int) -> str:
    return with_parts(
        f"""select symbol, trade_date, cast(ceil(ord / {size}.0) as int) as bucket, arg_min(open, bar_time) as open, max(high) as high, min(low) as low, arg_max(close, bar_time) as close, cast(sum(volume) as bigint) as volume from
  (select *, case when m > 570 and m <= 690 then m - 570 when m > 780 and m <= 900 then m - 780 + 120 end as ord from (select *, hour(bar_time) * 60 + minute(bar_time) as m from minutes)) where ord is not null group by all""".replace("group by all", "group by 1, 2, 3"),
        minutes=f"""select symbol, trade_date, date_trunc('minute', trade_time) + interval 1 minute as bar_time, arg_min(price, tick_seq) as open, max(price) as high, min(price) as low, arg_max(price, tick_seq) as close,
  coalesce(sum(volume), 0) as volume from ({TICKS}) where price is not null and trade_time is not null group by 1, 2, 3""",
    )


def oracle_sql() -> dict[str, str]:
    base = {"usable": _USABLE, "pairs": _PAIRS}
    index = base | {"returns": _RETURNS, "known": _MEMBERS_ON, "idx": _INDEX}
    div = base | {"divergences": _DIVERGENCES, "steps": STEPS}
    metrics = "advance_count, decline_count, flat_count, limit_up_count, limit_down_count, advance_ratio, total_count"
    return {
        "factor_continuity": with_parts(
            "select symbol, adjust_type, trade_date, round(ratio, 6) as ratio from r where greatest(ratio, 1 / ratio) > 1.05 qualify row_number() over (partition by symbol, adjust_type order by greatest(ratio, 1 / ratio) desc, trade_date desc) = 1",
            r=f"select symbol, adjust_type, trade_date, factor / lag(factor) over (partition by symbol, adjust_type order by trade_date) as ratio from ({FACTORS}) where factor > 0",
        ),
        "uncovered_symbols": _UNCOVERED,
        "retry_refresh_union": with_parts(
            f"""select s.symbol, 'step' as why from steps s join (select symbol, max(trade_date) as last_date from ({BARS}) where volume > 0 or volume is null group by 1) l using (symbol) where last_date - s.trade_date <= 90
  union select symbol, 'uncovered' from ({_UNCOVERED}) where factor_date is null union select symbol, 'new' from daily_bars group by symbol having max(trade_date) - min(trade_date) < 300""",
            steps=STEPS,
        ),
        "returns_adjacent_sessions": with_parts("select symbol, trade_date, prev_trade_date, round(ret, 8) as ret from returns where ret is not null", **base, returns=_RETURNS),
        "cumulative_return": with_parts("select symbol, trade_date, round(close / first_value(close) over (partition by symbol order by trade_date) - 1, 8) as cumulative_return from usable", usable=_USABLE),
        "percentile_history": with_parts("select symbol, trade_date, close, round(percent_rank() over (partition by symbol order by close), 8) as percentile from usable", usable=_USABLE),
        "industry_members_asof": _MEMBERS_ON,
        "industry_index_levels": with_parts("select trade_date, level, industry_code, round(equal_ret, 8) as ret, n_members, n_priced, n_members - n_priced as n_excluded from idx", **index),
        "industry_index_weighted": with_parts("select trade_date, level, industry_code, round(amount_ret, 8) as ret, round(amount, 1) as amount from idx", **index),
        "industry_group_gaps": with_parts("select trade_date, level, industry_code, n_members from idx where n_priced = 0", **index),
        "breadth_daily": with_parts(f"select trade_date, metric_id, round(cast(value as double), 8) as value from (select trade_date, {', '.join(f'cast({m} as double) as {m}' for m in metrics.split(', '))} from b) unpivot (value for metric_id in ({metrics}))", pairs=_PAIRS, b=_breadth("case when t.symbol like '%.BJ' then 0.295 else 0.095 end")),
        "breadth_completeness": with_parts("select trade_date, 'market_breadth_incomplete' as check from b where day(trade_date) = 1", pairs=_PAIRS, b=_breadth("0.095")).replace("as check", 'as "check"'),
        "suspension_gaps": with_parts(
            f"""select e.symbol, e.trade_date, 'suspended' as status, 'derived_bar_gap' as source from (select a.symbol, c.trade_date from a join ({CALENDAR}) c on c.trade_date between astart and aend) e
  where not exists (select 1 from traded t where t.symbol = e.symbol and t.trade_date = e.trade_date)""",
            traded=f"select symbol, trade_date from ({BARS}) where volume > 0 or volume is null",
            i=INSTRUMENTS,
            a=f"select symbol, greatest(coalesce(list_date, bmin), bmin) as astart, least(coalesce(delist_date, bmax), bmax) as aend from (select symbol, min(trade_date) as bmin, max(trade_date) as bmax from daily_bars where symbol in (select symbol from traded) group by 1) join i using (symbol)",
        ),
        "suspension_merge_rank": """select symbol, trade_date, rank, source, cast(floor(epoch(fetched_at)) as bigint) as fetched_epoch from (select *, case when source = 'eastmoney' then case when coalesce(cast(fetched_at at time zone 'Asia/Shanghai' as date) = trade_date and hour(fetched_at at time zone 'Asia/Shanghai') >= 15, false) then 0 else 2 end
  when source = 'derived_bar_gap' then 1 else 0 end as rank from trading_status) qualify row_number() over (partition by symbol, trade_date order by rank, fetched_at desc nulls last, is_trading desc nulls last, status desc nulls last, source desc nulls last) = 1""",
        "traded_symbol_semi": "select distinct symbol, trade_date from trading_status s where exists (select 1 from daily_bars b where b.symbol = s.symbol and b.trade_date = s.trade_date and (volume > 0 or volume is null))",
        "recon_discontinuity": with_parts("select symbol, trade_date, round(adj_ret, 6) as adj_ret, round(divergence, 6) as divergence from divergences where abs(adj_ret) > 0.2 and divergence > 0.02 qualify row_number() over (partition by symbol order by divergence desc, trade_date desc) = 1", **div),
        "recon_missing_event": with_parts("select symbol, trade_date, round(divergence, 6) as divergence from e where not explained", **div, e=_EXPLAINED),
        "recon_explained": with_parts("select symbol, trade_date, step_date, round(divergence, 6) as divergence from e where explained", **div, e=_EXPLAINED),
        "recon_capped": with_parts(
            "select exchange, symbol, trade_date, divergence, cast(0 as bigint) as hidden from v where rn <= 5 union all select exchange, null, null, null, count(*) from v where rn > 5 group by 1",
            **div, v="select *, row_number() over (partition by exchange order by divergence desc, symbol, trade_date) as rn from (select split_part(symbol, '.', 2) as exchange, symbol, trade_date, round(divergence, 8) as divergence from divergences where divergence > 0.001)",
        ),
        "minute_resample_15m": _resample(15),
        "minute_resample_60m": _resample(60),
        "survivorship_returns": with_parts(
            "select exchange, count(*) as n, round(avg(ret), 8) as complete, round(avg(ret) filter (delist_date is null), 8) as survivors, round(100 * (avg(ret) filter (delist_date is null) - avg(ret)), 6) as gap_pp from (select symbol, split_part(symbol, '.', 2) as exchange, arg_max(close, trade_date) / arg_min(close, trade_date) - 1 as ret from usable group by 1) join (select symbol, delist_date from i) using (symbol) group by 1",
            usable=_USABLE, i=INSTRUMENTS,
        ),
        "delisting_endings": with_parts(
            """select symbol, max(trade_date) as last_trade_date, max(n) as bars, max(case when rn < least(n, 60) then date_diff('day', before, trade_date) end) as halt_gap_days, round(min(case when rn < least(n, 60) then close / prev - 1 end), 8) as worst_final_return,
  round(arg_min(close, rn) / arg_max(close, rn) - 1, 8) as window_return, case when max(n) < 30 then 'insufficient' when max(case when rn < least(n, 60) then date_diff('day', before, trade_date) end) > 10 and min(case when rn < least(n, 60) then close / prev - 1 end) < -0.25 then 'consolidation'
  when arg_min(close, rn) / arg_max(close, rn) - 1 < -0.4 and arg_min(close, rn) < 2.0 then 'abrupt_decline' else 'abrupt_stable' end as ending_pattern from r where rn <= 60 group by 1""",
            usable=_USABLE,
            r="select *, count(*) over (partition by symbol) as n, row_number() over (partition by symbol order by trade_date desc) as rn, lag(close) over (partition by symbol order by trade_date) as prev, lag(trade_date) over (partition by symbol order by trade_date) as before from usable",
        ),
        "interval_expand_latest": with_parts("select s.symbol, m.last_date as as_of_date, s.start_date, s.industry_code from months m join sw s on s.start_date <= m.last_date qualify row_number() over (partition by s.symbol, m.last_date order by s.start_date desc) = 1", months=_MONTHS, sw=_SW),
        "interval_expand_halfopen": with_parts("select s.symbol, s.industry_code, m.last_date as as_of_date from months m join s on s.start_date <= m.last_date and (s.end_date is null or m.last_date < s.end_date)", months=_MONTHS, s=f"select *, lead(start_date) over (partition by symbol order by start_date) as end_date from ({_SW})"),
        "month_end_sessions": _MONTHS,
    }
