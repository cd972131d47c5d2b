"""Queries of the checks on the test lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.columns import canonical_symbol
from lakeforge.operators import readpath as R
from lakeforge.operators.compaction import partition_label
from lakeforge.operators.returns import minute_bars
from lakeforge.plans.derived import ticks
from lakeforge.plans.problems import table
from lakeforge.plans.read_path import bars, calendar, instruments, items
from lakeforge.plans.sqlparts import BARS, CALENDAR, INSTRUMENTS, ITEMS, TICKS, with_parts
from lakeforge.quality import checks as Q


def calendar_orphans(spark: SparkSession, d: str) -> DataFrame:
    return Q.calendar_orphans(table(spark, d, "dragon_tiger"), calendar(spark, d))


def calendar_missing(spark: SparkSession, d: str) -> DataFrame:
    return Q.missing_sessions(table(spark, d, "trade_ticks"), calendar(spark, d))


def index_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Q.symbol_session_holes(R.traded(bars(spark, d)), calendar(spark, d))


def contiguous_watermark(spark: SparkSession, d: str) -> DataFrame:
    return Q.last_contiguous(table(spark, d, "trading_status"), calendar(spark, d))


def interior_gaps(spark: SparkSession, d: str) -> DataFrame:
    gaps = Q.missing_sessions(table(spark, d, "adj_factors"), calendar(spark, d))
    return gaps.groupBy(F.year("trade_date").alias("year")).agg(F.count(F.lit(1)).alias("gaps"), F.min("trade_date").alias("first_date"))


def shallow_history(spark: SparkSession, d: str) -> DataFrame:
    """Symbols whose factors begin more than 30 days after their bars."""
    b = bars(spark, d).groupBy("symbol").agg(F.min("trade_date").alias("bar_date"))
    f = table(spark, d, "adj_factors").groupBy("symbol").agg(F.min("trade_date").alias("factor_date"))
    return b.join(f, "symbol").where(F.datediff("factor_date", "bar_date") > 30)


def session_coverage(spark: SparkSession, d: str) -> DataFrame:
    m = minute_bars(ticks(spark, d)).groupBy("symbol", "trade_date").agg(F.count(F.lit(1)).alias("n"))
    return m.groupBy("trade_date").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("n") < 0.9 * 240).alias("thin")).withColumn("share", F.round(F.col("thin") / F.col("sessions"), 8))


def off_session(spark: SparkSession, d: str) -> DataFrame:
    rows = Q.off_session(ticks(spark, d), "trade_time", (("09:30:00", "11:29:00"), ("13:00:00", "14:55:00")))
    return rows.select("symbol", "trade_date", "tick_seq", F.date_format("trade_time", "HH:mm:ss").alias("at"))


def minute_daily_recon(spark: SparkSession, d: str) -> DataFrame:
    r = Q.session_ratio(ticks(spark, d), bars(spark, d))
    return r.groupBy("symbol").agg(F.count(F.lit(1)).alias("sessions"), F.round(F.median("ratio"), 8).alias("ratio"))


def tick_seq_gaps(spark: SparkSession, d: str) -> DataFrame:
    return Q.sequence_gaps(ticks(spark, d))


def tick_truncation(spark: SparkSession, d: str) -> DataFrame:
    return Q.truncated_sessions(ticks(spark, d), "09:40:00")


def tick_direction(spark: SparkSession, d: str) -> DataFrame:
    return Q.direction_mix(ticks(spark, d))


def volume_unit_median(spark: SparkSession, d: str) -> DataFrame:
    return Q.unit_ratios(table(spark, d, "daily_bars")).withColumn("ratio", F.round("ratio", 6))


def amount_completeness(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_share(table(spark, d, "daily_bars"), "amount")


def pk_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return Q.duplicate_keys(table(spark, d, "daily_bars"), ["symbol", "trade_date"])


def required_nulls(spark: SparkSession, d: str) -> DataFrame:
    return Q.null_counts(table(spark, d, "trading_status"), ["symbol", "trade_date", "is_trading", "status", "source", "fetched_at"])


def nonfinite(spark: SparkSession, d: str) -> DataFrame:
    with_bad = table(spark, d, "daily_bars").withColumn("turnover", F.when(F.col("volume") == 0, F.lit(float("nan"))).otherwise(F.try_divide("amount", "volume")))
    return Q.nonfinite(with_bad, ["close", "turnover"]).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def ohlc_invariants(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "daily_bars")
    return t.where(Q.bar_violations()).select("symbol", "trade_date", "source", "open", "high", "low", "close", "volume")


def row_mutation_prorated(spark: SparkSession, d: str) -> DataFrame:
    """Months of statuses against the month before, as seen on the last day there is."""
    rows = table(spark, d, "trading_status").where("trade_date is not null")
    last = rows.agg(F.max("trade_date").alias("d")).first().d
    return Q.row_mutations(rows, F.date_format("trade_date", "yyyy-MM"), F.lit(last), 0.9, 5).withColumn("elapsed", F.round("elapsed", 8))


def fragmentation(spark: SparkSession, d: str) -> DataFrame:
    return Q.fragmentation(table(spark, d, "lake_files").select("dataset", partition_label().alias("partition"), "n_rows"), 500)


def mixed_granularity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lake_files").select("dataset", partition_label().alias("p")).groupBy("dataset", Q.granularity("p").alias("granularity")).agg(F.countDistinct("p").alias("partitions"), F.count(F.lit(1)).alias("files"))


def valuation_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Q.coverage_by_date(table(spark, d, "adj_factors"), R.traded(bars(spark, d))).withColumn("ratio", F.round("ratio", 8))


def last_dense_day(spark: SparkSession, d: str) -> DataFrame:
    c = Q.coverage_by_date(table(spark, d, "adj_factors"), R.traded(bars(spark, d)))
    return c.agg(F.max(F.when(F.col("ratio") >= 0.7, F.col("trade_date"))).alias("last_date"))


def macro_stale(spark: SparkSession, d: str) -> DataFrame:
    last = table(spark, d, "adj_factors").groupBy("source").agg(F.max("trade_date").alias("last_date"))
    return Q.staleness(last, F.lit("2025-12-31").cast("date"), 45)


def macro_revised(spark: SparkSession, d: str) -> DataFrame:
    """Statement values whose latest announcement differs by over 5 % from the first."""
    fact = ["symbol", "report_period", "statement_type", "item_code"]
    i = items(spark, d).where("announce_date >= date'2001-01-01' and item_value is not null")
    first, last = i.groupBy(*fact).agg(F.min_by("item_value", "announce_date").alias("item_value")), i.groupBy(*fact).agg(F.max_by("item_value", "announce_date").alias("item_value"))
    return Q.revised_values(last, first, fact, "item_value").select(*fact, "old_value", "new_value")


def pit_bad_announcements(spark: SparkSession, d: str) -> DataFrame:
    return Q.bad_announcements(items(spark, d)).select("symbol", "report_period", "item_code", "announce_date")


def survivorship_status(spark: SparkSession, d: str) -> DataFrame:
    return Q.retirement(R.traded(bars(spark, d)), instruments(spark, d))


def retired_unmarked(spark: SparkSession, d: str) -> DataFrame:
    return survivorship_status(spark, d).where("retired and not marked").select("symbol", "last_date")


def source_diff_fields(spark: SparkSession, d: str) -> DataFrame:
    return Q.field_drift(bars(spark, d), _mirror(spark, d), ["symbol", "trade_date"], ["open", "high", "low", "close", "volume", "amount"])


def source_diff_coverage(spark: SparkSession, d: str) -> DataFrame:
    return Q.key_coverage(bars(spark, d), _mirror(spark, d), ["symbol", "trade_date"])


def _mirror(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "daily_bars_mirror").withColumn("symbol", canonical_symbol("symbol")), ["symbol", "trade_date"])


def deterministic_sample(spark: SparkSession, d: str) -> DataFrame:
    return Q.spread_sample(bars(spark, d).select("symbol", "trade_date", "close"), ["symbol", "trade_date"], 500)


def partial_symbols(spark: SparkSession, d: str) -> DataFrame:
    return Q.partial_symbols(R.traded(bars(spark, d)), calendar(spark, d)).select("symbol", "expected", "present")


def placeholder_share(spark: SparkSession, d: str) -> DataFrame:
    return Q.placeholder_share(table(spark, d, "daily_bars"))


def fill_ratio(spark: SparkSession, d: str) -> DataFrame:
    return Q.fill_ratio(table(spark, d, "financial_statement_items"), "symbol", "item_value")


def close_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    return Q.close_crosscheck(R.traded(bars(spark, d)), _mirror(spark, d))


def label_differences(spark: SparkSession, d: str) -> DataFrame:
    """Days labelled suspended by a status against days without volume in the bars, where both tables have the day."""
    s = table(spark, d, "trading_status").where("symbol is not null and trade_date is not null")
    b = table(spark, d, "daily_bars").join(s.select("symbol", "trade_date").distinct(), ["symbol", "trade_date"], "left_semi")
    said = s.where(F.lower(F.trim("status")) == "suspended").join(table(spark, d, "daily_bars").select("symbol", "trade_date").distinct(), ["symbol", "trade_date"], "left_semi")
    return Q.label_differences(said, b.where("volume = 0"), ["symbol", "trade_date"])


def delisted_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Every symbol judged as if it had ended on its last bar, or (even codes) a month before; only those with statuses are catalogued."""
    code = F.substring("symbol", 1, 6).cast("int")
    terminal = table(spark, d, "daily_bars").groupBy("symbol").agg(F.max("trade_date").alias("t")).select("symbol", F.when(code % 2 == 0, F.date_sub("t", 31)).otherwise(F.col("t")).alias("terminal"))
    known = instruments(spark, d).join(table(spark, d, "trading_status").select("symbol"), "symbol", "left_semi")
    return Q.delisted_coverage(terminal, R.traded(bars(spark, d)), known, F.lit("2024-12-31").cast("date")).select("symbol", "state")


def receipt_coverage(spark: SparkSession, d: str) -> DataFrame:
    receipts = table(spark, d, "trading_status").where("symbol is not null").groupBy(F.col("source").alias("receipt_id"), "symbol").agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    wide = receipts.withColumn("start_date", F.lit("2015-01-01").cast("date"))
    return Q.receipt_coverage(wide, table(spark, d, "trading_status").where("source = 'baostock'"), F.lit("2016-01-01").cast("date"), F.lit("2016-12-31").cast("date"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (
        calendar_orphans, calendar_missing, index_coverage, contiguous_watermark, interior_gaps, shallow_history, session_coverage, off_session, minute_daily_recon, tick_seq_gaps, tick_truncation, tick_direction,
        volume_unit_median, amount_completeness, pk_duplicates, required_nulls, nonfinite, ohlc_invariants, row_mutation_prorated, fragmentation, mixed_granularity, valuation_coverage, last_dense_day,
        macro_stale, macro_revised, pit_bad_announcements, survivorship_status, retired_unmarked, source_diff_fields, source_diff_coverage, deterministic_sample, partial_symbols, placeholder_share, fill_ratio,
        close_crosscheck, label_differences, delisted_coverage, receipt_coverage,
    )
    return {f.__name__: f for f in fs}


_SPAN = "select c.trade_date from ({cal}) c where c.trade_date between (select min(trade_date) from {t}) and (select max(trade_date) from {t}) and c.trade_date not in (select trade_date from {t} where trade_date is not null)"
_COVER = f"""select u.trade_date, count(*) as n, count(c.symbol) as covered, count(c.symbol) / count(*) as ratio from (select distinct symbol, trade_date from ({BARS}) where volume > 0 or volume is null) u
  left join (select distinct symbol, trade_date from adj_factors) c on c.symbol = u.symbol and c.trade_date = u.trade_date group by 1"""
_HOLES = f"""select symbol, max(n) - min(n) + 1 as expected, count(*) as present from (select distinct symbol, trade_date from ({BARS}) where volume > 0 or volume is null) join (select trade_date, row_number() over (order by trade_date) as n from ({CALENDAR})) using (trade_date) group by 1"""
_RETIRED = f"""select symbol, first_date, last_date, (select max(trade_date) from ({BARS}) where volume > 0 or volume is null) - last_date > 180 as retired, delist_date is not null as marked from
  (select symbol, min(trade_date) as first_date, max(trade_date) as last_date from ({BARS}) where volume > 0 or volume is null group by 1) left join ({INSTRUMENTS}) using (symbol)"""
_M = "(select * replace (regexp_extract(symbol, '([0-9]{6})', 1) || '.' || regexp_extract(upper(symbol), '(SH|SZ|BJ)', 1) as symbol) from daily_bars_mirror)"
_MIRROR = BARS.replace("from daily_bars", f"from {_M}")
_FACT = "symbol, report_period, statement_type, item_code"


def oracle_sql() -> dict[str, str]:
    drift = lambda f: f"case when (p.{f} is null) <> (b.{f} is null) then 'field_null_mismatch' when (case when b.{f} = 0 then case when p.{f} <> 0 then 1e308 else 0 end else abs(p.{f} - b.{f}) / abs(b.{f}) * 1e4 end) > 10 then 'field_drift' end"
    minutes = f"select symbol, trade_date, date_trunc('minute', trade_time) as m from ({TICKS}) where price is not null and trade_time is not null group by 1, 2, 3"
    return {
        "calendar_orphans": f"select distinct trade_date from dragon_tiger where trade_date is not null and trade_date not in ({CALENDAR})",
        "calendar_missing": _SPAN.format(cal=CALENDAR, t="trade_ticks"),
        "index_coverage": f"select *, expected - present as missing from ({_HOLES})",
        "contiguous_watermark": f"select max(trade_date) as last_date from ({CALENDAR}) where trade_date between (select min(trade_date) from trading_status) and (select max(trade_date) from trading_status) and trade_date < coalesce((select min(trade_date) from ({_SPAN.format(cal=CALENDAR, t='trading_status')})), date '9999-01-01')",
        "interior_gaps": f"select cast(year(trade_date) as int) as year, count(*) as gaps, min(trade_date) as first_date from ({_SPAN.format(cal=CALENDAR, t='adj_factors')}) group by 1",
        "shallow_history": "select * from (select symbol, min(trade_date) as bar_date from daily_bars group by 1) join (select symbol, min(trade_date) as factor_date from adj_factors group by 1) using (symbol) where factor_date - bar_date > 30",
        "session_coverage": f"select trade_date, count(*) as sessions, count(*) filter (n < 216) as thin, round(count(*) filter (n < 216) / count(*), 8) as share from (select symbol, trade_date, count(*) as n from ({minutes}) group by 1, 2) group by 1",
        "off_session": f"select symbol, trade_date, tick_seq, strftime(trade_time, '%H:%M:%S') as at from ({TICKS}) where not (strftime(trade_time, '%H:%M:%S') between '09:30:00' and '11:29:00' or strftime(trade_time, '%H:%M:%S') between '13:00:00' and '14:55:00')",
        "minute_daily_recon": f"select symbol, count(*) as sessions, round(median(v / volume), 8) as ratio from (select symbol, trade_date, coalesce(sum(volume), 0) as v from ({TICKS}) group by 1, 2) join (select symbol, trade_date, volume from ({BARS}) where volume > 0) using (symbol, trade_date) group by 1",
        "tick_seq_gaps": f"select symbol, trade_date, count(*) as n, count(distinct tick_seq) as distinct_seq, min(tick_seq) as lo, max(tick_seq) as hi from ({TICKS}) group by 1, 2 having min(tick_seq) <> 0 or max(tick_seq) <> count(*) - 1 or count(distinct tick_seq) <> count(*)",
        "tick_truncation": f"select trade_date, count(*) as sessions, count(*) filter (strftime(first, '%H:%M:%S') > '09:40:00') as truncated from (select symbol, trade_date, min(trade_time) as first from ({TICKS}) group by 1, 2) group by 1",
        "tick_direction": f"""select *, round(unknown / n, 8) as unknown_share, round(buys / nullif(buys + sells, 0), 8) as buy_share from (select symbol, count(*) as n, count(*) filter (direction = 'buy') as buys, count(*) filter (direction = 'sell') as sells,
  count(*) filter (not coalesce(direction in ('buy', 'sell', 'neutral', 'after_hours'), false)) as unknown from ({TICKS}) group by 1)""",
        "volume_unit_median": "select source, data_version, count(*) as n, round(median(amount / (volume * close)), 6) as ratio from daily_bars where volume > 0 and close > 0 and amount > 0 group by 1, 2 having count(*) >= 20",
        "amount_completeness": "select source, count(*) as n, count(*) filter (amount is null) as nulls, round(count(*) filter (amount is null) / count(*), 8) as share from daily_bars group by 1",
        "pk_duplicates": "select symbol, trade_date, count(*) as n from daily_bars group by 1, 2 having count(*) > 1",
        "required_nulls": " union all ".join(f"select '{c}' as column_name, count(*) filter ({c} is null) as nulls, {b} as blanks from trading_status" for c, b in (("symbol", "count(*) filter (trim(symbol) = '')"), ("trade_date", "0"), ("is_trading", "0"), ("status", "count(*) filter (trim(status) = '')"), ("source", "count(*) filter (trim(source) = '')"), ("fetched_at", "0"))),
        "nonfinite": "select symbol, count(*) as n from daily_bars where volume = 0 or isnan(close) or isinf(close) group by 1",
        "ohlc_invariants": """select symbol, trade_date, source, open, high, low, close, volume from daily_bars where coalesce(open <= 0, false) or coalesce(high <= 0, false) or coalesce(low <= 0, false) or coalesce(close <= 0, false) or coalesce(volume < 0, false) or coalesce(amount < 0, false)
  or (coalesce(volume > 0, true) and (coalesce(high < greatest(open, close, low), false) or coalesce(low > least(open, close, high), false)))""",
        "row_mutation_prorated": """select period, n, prev_n, symbols, prev_symbols, round(elapsed, 8) as elapsed from (select *, case when last >= a and last < a + interval 1 month then (last - a + 1) / (cast(a + interval 1 month as date) - a) else 1.0 end as elapsed
  from (select *, lag(n) over (order by period) as prev_n, lag(symbols) over (order by period) as prev_symbols, cast(period || '-01' as date) as a from (select strftime(trade_date, '%Y-%m') as period, count(*) as n, count(distinct symbol) as symbols from trading_status where trade_date is not null group by 1)), (select max(trade_date) as last from trading_status))
  where prev_n >= 5 and (n < 0.9 * prev_n * elapsed or prev_symbols >= 5 and symbols < 0.9 * prev_symbols * elapsed)""",
        "fragmentation": "select dataset, count(distinct p) as partitions, cast(sum(n_rows) as bigint) as n_rows from (select dataset, n_rows, regexp_extract(file_path, 'trade_date=([^/]*)/', 1) as p from lake_files) group by 1 having count(distinct p) >= 30 and sum(n_rows) / count(distinct p) < 500",
        "mixed_granularity": "select dataset, case when regexp_full_match(p, '\\d{4}-\\d{2}-\\d{2}') then 'day' when regexp_full_match(p, '\\d{4}-\\d{2}') then 'month' when regexp_full_match(p, '\\d{4}Q[1-4]') then 'quarter' when regexp_full_match(p, '\\d{4}') then 'year' end as granularity, count(distinct p) as partitions, count(*) as files from (select dataset, regexp_extract(file_path, 'trade_date=([^/]*)/', 1) as p from lake_files) group by 1, 2",
        "valuation_coverage": f"select trade_date, n, covered, round(ratio, 8) as ratio from ({_COVER})",
        "last_dense_day": f"select max(trade_date) filter (ratio >= 0.7) as last_date from ({_COVER})",
        "macro_stale": "select source, max(trade_date) as last_date, cast(date '2025-12-31' - max(trade_date) as int) as days_behind, date '2025-12-31' - max(trade_date) > 45 as stale from adj_factors group by 1",
        "macro_revised": with_parts(f"select {_FACT}, a as old_value, b as new_value from (select {_FACT}, arg_min(item_value, announce_date) as a, arg_max(item_value, announce_date) as b from items where announce_date >= date '2001-01-01' and item_value is not null group by all) where abs(a - b) > 0.05 * greatest(abs(a), abs(b))", items=ITEMS),
        "pit_bad_announcements": f"select symbol, report_period, item_code, announce_date from ({ITEMS}) where announce_date is null or announce_date < date '2001-01-01'",
        "survivorship_status": _RETIRED,
        "retired_unmarked": f"select symbol, last_date from ({_RETIRED}) where retired and not marked",
        "source_diff_fields": with_parts(" union all ".join(f"select symbol, trade_date, '{f}' as field_name, {drift(f)} as kind from p join b using (symbol, trade_date) where {drift(f)} is not null" for f in ("open", "high", "low", "close", "volume", "amount")), p=BARS, b=_MIRROR),
        "source_diff_coverage": with_parts(
            """select *, case when primary_keys = 0 and backup_keys = 0 then 'no_comparable_rows' when primary_keys = 0 then 'primary_missing' when backup_keys = 0 then 'backup_missing' when overlap = 0 then 'no_overlap' when overlap < primary_keys then 'backup_gap'
  when overlap < backup_keys then 'primary_gap' else 'equal' end as state from (select count(p.symbol) as primary_keys, count(b.symbol) as backup_keys, count(*) filter (p.symbol is not null and b.symbol is not null) as overlap from p full join b on p.symbol = b.symbol and p.trade_date = b.trade_date)""",
            p=BARS, b=_MIRROR,
        ),
        "close_crosscheck": with_parts(
            "select trade_date, count(*) as compared, count(*) filter (abs(t.close - m.close) > 0.001 * abs(m.close)) as mismatched from t join m using (symbol, trade_date) group by 1",
            t=f"select * from ({BARS}) where volume > 0 or volume is null qualify row_number() over (partition by trade_date order by amount desc nulls last, volume desc nulls last, symbol) <= 12", m=_MIRROR,
        ),
        "label_differences": with_parts(
            "select coalesce(l.symbol, r.symbol) as symbol, coalesce(l.trade_date, r.trade_date) as trade_date, case when l.symbol is null then 'right_only' else 'left_only' end as side from l full join r on l.symbol = r.symbol and l.trade_date = r.trade_date where l.symbol is null or r.symbol is null",
            l="select distinct symbol, trade_date from trading_status s where lower(trim(status)) = 'suspended' and exists (select 1 from daily_bars b where b.symbol = s.symbol and b.trade_date = s.trade_date)",
            r="select distinct symbol, trade_date from daily_bars b where volume = 0 and exists (select 1 from trading_status s where s.symbol = b.symbol and s.trade_date = b.trade_date)",
        ),
        "delisted_coverage": with_parts(
            """select t.symbol, case when last is null then case when terminal <= date '2024-12-31' then 'missing_bars' else 'unknown_overlap' end
  when terminal <= date '2024-12-31' and last <> terminal and not coalesce(delist_date = terminal + 1 and terminal - last between 1 and 3, false) then 'terminal_mismatch'
  when known is null then 'missing_instrument' when delist_date is null or delist_date < terminal then 'invalid_delist_date' else 'verified' end as state
  from t left join (select symbol, max(trade_date) as last from bars where volume > 0 or volume is null group by 1) s using (symbol) left join (select *, 1 as known from i where symbol in (select symbol from trading_status)) k using (symbol)""",
            t="select symbol, case when cast(substr(symbol, 1, 6) as int) % 2 = 0 then max(trade_date) - 31 else max(trade_date) end as terminal from daily_bars group by symbol", bars=BARS, i=INSTRUMENTS,
        ),
        "receipt_coverage": "select source as receipt_id from trading_status r join (select distinct symbol from trading_status where source = 'baostock' and symbol is not null) u using (symbol) group by 1 having count(distinct symbol) = (select count(distinct symbol) from trading_status where source = 'baostock')",
        "deterministic_sample": f"select symbol, trade_date, close from ({BARS}) order by md5(symbol || '|' || cast(trade_date as varchar)), symbol, trade_date limit 500",
        "partial_symbols": f"select * from ({_HOLES}) where present < 0.97 * expected",
        "placeholder_share": "select source, count(*) as n, round(avg(case when open = high and high = low and low = close and volume = 0 then 1 else 0 end), 8) as share from daily_bars group by 1",
        "fill_ratio": "select symbol, count(*) as n, count(item_value) as filled, round(count(item_value) / count(*), 8) as ratio from financial_statement_items group by 1",
    }
