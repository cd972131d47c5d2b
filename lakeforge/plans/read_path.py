"""Queries of the read path on the test lake."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators import readpath as R
from lakeforge.plans.problems import table
from lakeforge.plans.sqlparts import BAR_COLUMNS, BARS, FACTORS, INSTRUMENTS, ITEMS, STATUS, STEPS, with_parts

#: Prefixes of the invented codes of the test lake.
TEST_PREFIXES = {"SH": ("6",), "SZ": ("0", "3"), "BJ": ("4", "9")}
ITEM_KEY = ["symbol", "report_period", "statement_type", "item_code", "announce_date"]


def bars(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "daily_bars"), ["symbol", "trade_date"])


def factors(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "adj_factors"), ["symbol", "trade_date", "adjust_type"])


def status(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "trading_status"), ["symbol", "trade_date"])


def items(spark: SparkSession, d: str) -> DataFrame:
    return R.canonical(table(spark, d, "financial_statement_items"), ITEM_KEY)


def instruments(spark: SparkSession, d: str) -> DataFrame:
    code = F.substring("symbol", 1, 6)
    spans = table(spark, d, "daily_bars").groupBy("symbol").agg(F.min("trade_date").alias("list_date"), F.max("trade_date").alias("last"))
    return spans.select(
        "symbol", F.concat(F.lit("NAME "), code).alias("name"), F.split_part("symbol", F.lit("."), F.lit(2)).alias("exchange"), "list_date", F.when(code.cast("int") % 5 == 0, F.date_sub("last", 30)).alias("delist_date")
    )


def factor_steps(spark: SparkSession, d: str) -> DataFrame:
    f = factors(spark, d).where("factor is not null and adjust_type = 'hfq'")
    f = f.withColumn("before", F.lag("factor").over(W.partitionBy("symbol").orderBy("trade_date")))
    return f.where("before is null or abs(factor - before) > 0.02 * abs(before)").select("symbol", "trade_date", "factor")


def calendar(spark: SparkSession, d: str) -> DataFrame:
    return R.traded(table(spark, d, "daily_bars")).select("trade_date").distinct()


def canonical_dedupe(spark: SparkSession, d: str) -> DataFrame:
    return bars(spark, d).select("symbol", "trade_date", F.round("close", 6).alias("close"), "volume", "source", "data_version", F.unix_seconds("fetched_at").alias("fetched_epoch"))


def schema_try_cast(spark: SparkSession, d: str) -> DataFrame:
    value = lambda n: F.get_json_object("payload", f"$.{n}")
    return table(spark, d, "vendor_records").select(
        "file_id", "row_no", value("symbol").alias("symbol"), value("trade_date").try_cast("date").alias("trade_date"), value("open").try_cast("double").alias("open"), value("symbol").try_cast("bigint").alias("not_a_number")
    )


def traded_only(spark: SparkSession, d: str) -> DataFrame:
    return R.traded(bars(spark, d)).groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))


def adjust_hfq(spark: SparkSession, d: str) -> DataFrame:
    a = R.adjusted(bars(spark, d), factors(spark, d))
    return a.select("symbol", "trade_date", "close", "adj_close", "adj_is_exact")


def adjust_qfq_window(spark: SparkSession, d: str) -> DataFrame:
    window = R.date_range(bars(spark, d), "trade_date", "2018-01-01", "2022-12-31")
    a = R.adjusted(window, R.date_range(factors(spark, d), "trade_date", "2018-01-01", "2022-12-31"), "qfq")
    return a.select("symbol", "trade_date", "adj_close", "adj_is_exact")


def adjust_view_global_anchor(spark: SparkSession, d: str) -> DataFrame:
    return R.both_adjusted(bars(spark, d), factors(spark, d)).select("symbol", "trade_date", "hfq_close", "qfq_close", "adj_is_exact")


def adjust_missing_exact_flag(spark: SparkSession, d: str) -> DataFrame:
    return R.adjusted(bars(spark, d), factors(spark, d)).groupBy("symbol").agg(F.count_if("adj_is_exact").alias("exact"), F.count_if(~F.col("adj_is_exact")).alias("inexact"))


def universe_all_a(spark: SparkSession, d: str) -> DataFrame:
    return R.in_universe(bars(spark, d), instruments(spark, d), status(spark, d), prefixes=TEST_PREFIXES).select("symbol", "trade_date", "close")


def universe_strict_missing(spark: SparkSession, d: str) -> DataFrame:
    kept = R.in_universe(bars(spark, d), instruments(spark, d), None, prefixes=TEST_PREFIXES)
    return R.uncovered_pairs(kept, status(spark, d)).groupBy("symbol").agg(F.count(F.lit(1)).alias("missing"))


def symbol_predicate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "daily_bars").select("symbol").distinct().select("symbol", R.in_stock_universe("symbol").alias("all_a"), R.in_stock_universe("symbol", TEST_PREFIXES).alias("in_test"))


def pit_as_of(spark: SparkSession, d: str) -> DataFrame:
    return R.as_known(items(spark, d), ITEM_KEY, "2021-06-30").select("symbol", "report_period", "statement_type", "item_code", "item_value", "announce_date")


def pit_all_vintages(spark: SparkSession, d: str) -> DataFrame:
    return R.as_known(items(spark, d), ITEM_KEY, "2021-06-30", all_vintages=True).select(*ITEM_KEY, "item_value")


def pit_quarter_range(spark: SparkSession, d: str) -> DataFrame:
    known = R.as_known(items(spark, d), ITEM_KEY, "2023-12-31", start="2018-04-01", end="2020-12-31", date_column="report_period")
    return known.select("symbol", "report_period", "item_code", "announce_date")


def pit_items(spark: SparkSession, d: str) -> DataFrame:
    return R.as_known(items(spark, d), ITEM_KEY, "2022-12-31", items=["revenue"]).select("symbol", "report_period", "item_code", "item_value")


def pit_revision_size(spark: SparkSession, d: str) -> DataFrame:
    fact = ITEM_KEY[:4]
    seen = items(spark, d).where("announce_date >= date'2001-01-01' and item_value is not null").groupBy(*fact).agg(
        F.count(F.lit(1)).alias("vintages"), F.min_by("item_value", "announce_date").alias("first_value"), F.max_by("item_value", "announce_date").alias("last_value")
    )
    return seen.where("vintages > 1").select(*fact, "vintages", (F.col("last_value") - F.col("first_value")).alias("revision"))


def asof_factor_steps(spark: SparkSession, d: str) -> DataFrame:
    return R.factor_on_bars(bars(spark, d), factor_steps(spark, d)).withColumn("factor", F.round("factor", 6))


def gap_fill_missing(spark: SparkSession, d: str) -> DataFrame:
    from lakeforge.functions.columns import canonical_symbol

    mirror = table(spark, d, "daily_bars_mirror").withColumn("symbol", canonical_symbol("symbol")).select("symbol", "trade_date").distinct()
    return R.gap_fill(mirror, table(spark, d, "daily_bars"), ["symbol", "trade_date"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (
        canonical_dedupe, schema_try_cast, traded_only, adjust_hfq, adjust_qfq_window, adjust_view_global_anchor, adjust_missing_exact_flag,
        universe_all_a, universe_strict_missing, symbol_predicate, pit_as_of, pit_all_vintages, pit_quarter_range, pit_items, pit_revision_size, asof_factor_steps, gap_fill_missing,
    )
    return {f.__name__: f for f in fs}


_OUT = "(regexp_matches(symbol, '^8[1-9].*(SH|SZ)$') or regexp_matches(symbol, '^(689|51|52|56|58).*SH$') or regexp_matches(symbol, '^1[56].*SZ$'))"
_STOCK = "regexp_matches(symbol, '^(6[08].*SH|[03]0.*SZ|(92|43|83|87).*BJ)$')"
_ALL_A = f"(not {_OUT} and regexp_matches(symbol, '^(6.*SH|[03].*SZ|[49].*BJ)$'))"
_LISTED = "(list_date is null or list_date <= trade_date) and (delist_date is null or delist_date >= trade_date)"
_BAD = "(not coalesce(is_trading, true) or coalesce(lower(trim(status)) in ('st', '*st', 'suspended'), false))"
_KNOWN = "select * from items where announce_date <= date '{0}' {1} qualify row_number() over (partition by symbol, report_period, statement_type, item_code order by announce_date desc, fetched_at desc, data_version desc, item_value desc nulls last, source desc) = 1"


REVENUE = "and item_code = 'revenue'"


def oracle_sql() -> dict[str, str]:
    hfq = f"bars left join (select symbol, trade_date, factor from ({FACTORS}) where adjust_type = 'hfq') f using (symbol, trade_date)"
    kept = f"select b.* from bars b join instruments i using (symbol) where {_ALL_A} and {_LISTED} and coalesce(least(open, high, low, close) > 0, true)"
    return {
        "canonical_dedupe": f"select symbol, trade_date, round(close, 6) as close, volume, source, data_version, cast(floor(epoch(fetched_at)) as bigint) as fetched_epoch from ({BARS})",
        "schema_try_cast": "select file_id, row_no, payload ->> '$.symbol' as symbol, try_cast(payload ->> '$.trade_date' as date) as trade_date, try_cast(payload ->> '$.open' as double) as open, case when regexp_matches(payload ->> '$.symbol', '^[0-9]+$') then try_cast(payload ->> '$.symbol' as bigint) end as not_a_number from vendor_records",
        "traded_only": f"select symbol, count(*) as n, min(trade_date) as first_date, max(trade_date) as last_date from ({BARS}) where volume > 0 or volume is null group by symbol",
        "adjust_hfq": with_parts(f"select symbol, trade_date, close, close * coalesce(factor, 1) as adj_close, factor is not null as adj_is_exact from {hfq}", bars=BARS),
        "adjust_qfq_window": with_parts(
            "select symbol, trade_date, close * coalesce(factor / nullif(anchor, 0), 1) as adj_close, factor / nullif(anchor, 0) is not null as adj_is_exact from bars left join f using (symbol, trade_date) left join anchors using (symbol)",
            bars=f"select * from ({BARS}) where trade_date between date '2018-01-01' and date '2022-12-31'",
            f=f"select symbol, trade_date, factor from ({FACTORS}) where adjust_type = 'hfq' and trade_date between date '2018-01-01' and date '2022-12-31'",
            anchors="select symbol, arg_max_null(factor, trade_date) as anchor from f join (select symbol, max(trade_date) as last from bars group by 1) using (symbol) where trade_date <= last group by 1",
        ),
        "adjust_view_global_anchor": with_parts(
            "select symbol, trade_date, close * coalesce(factor, 1) as hfq_close, close * coalesce(factor / nullif(anchor, 0), 1) as qfq_close, factor / nullif(anchor, 0) is not null as adj_is_exact from bars left join f using (symbol, trade_date) left join anchors using (symbol)",
            bars=BARS, f=f"select symbol, trade_date, factor from ({FACTORS}) where adjust_type = 'hfq'", anchors="select symbol, arg_max_null(factor, trade_date) as anchor from f group by 1",
        ),
        "adjust_missing_exact_flag": with_parts(f"select symbol, count(*) filter (factor is not null) as exact, count(*) filter (factor is null) as inexact from {hfq} group by 1", bars=BARS),
        "universe_all_a": with_parts(f"select symbol, trade_date, close from ({kept}) k where not exists (select 1 from ({STATUS}) s where s.symbol = k.symbol and s.trade_date = k.trade_date and {_BAD})", bars=BARS, instruments=INSTRUMENTS),
        "universe_strict_missing": with_parts(f"select symbol, count(*) as missing from ({kept}) k where not exists (select 1 from trading_status s where s.symbol = k.symbol and s.trade_date = k.trade_date) group by 1", bars=BARS, instruments=INSTRUMENTS),
        "symbol_predicate": f"select distinct symbol, not {_OUT} and {_STOCK} as all_a, {_ALL_A} as in_test from daily_bars",
        "pit_as_of": with_parts(f"select symbol, report_period, statement_type, item_code, item_value, announce_date from ({_KNOWN.format('2021-06-30', '')})", items=ITEMS),
        "pit_all_vintages": with_parts("select symbol, report_period, statement_type, item_code, announce_date, item_value from items where announce_date <= date '2021-06-30'", items=ITEMS),
        "pit_quarter_range": with_parts(f"select symbol, report_period, item_code, announce_date from ({_KNOWN.format('2023-12-31', '')}) where report_period between '2018Q2' and '2020Q4'", items=ITEMS),
        "pit_items": with_parts(f"select symbol, report_period, item_code, item_value from ({_KNOWN.format('2022-12-31', REVENUE)})", items=ITEMS),
        "pit_revision_size": with_parts(
            "select symbol, report_period, statement_type, item_code, count(*) as vintages, arg_max(item_value, announce_date) - arg_min(item_value, announce_date) as revision from items where announce_date >= date '2001-01-01' and item_value is not null group by all having count(*) > 1",
            items=ITEMS,
        ),
        "asof_factor_steps": with_parts("select b.symbol, b.trade_date, round(coalesce(s.factor, 1.0), 6) as factor from (select distinct symbol, trade_date from daily_bars) b asof left join steps s on b.symbol = s.symbol and b.trade_date >= s.trade_date", steps=STEPS),
        "gap_fill_missing": "select symbol, trade_date from (select distinct regexp_extract(symbol, '([0-9]{6})', 1) || '.' || regexp_extract(upper(symbol), '(SH|SZ|BJ)', 1) as symbol, trade_date from daily_bars_mirror) m where not exists (select 1 from daily_bars b where b.symbol = m.symbol and b.trade_date = m.trade_date)",
    }
