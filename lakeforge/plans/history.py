"""Queries of backfills, reconciliations and the lake's own reads on the test lake."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.functions.columns import canonical_symbol, factor_of, local_date, price_divisor, session_final, symbol_of
from lakeforge.functions.register import register
from lakeforge.lake import PERIOD, Lake, period_label
from lakeforge.operators import backfill as B
from lakeforge.operators import readpath as R
from lakeforge.operators.returns import minute_bars
from lakeforge.operators.storage import keyword_balance
from lakeforge.plans.derived import _DIVERGENCES, _EXPLAINED, _INDEX, _MEMBERS_ON, _PAIRS, _RETURNS, _USABLE, _index, recon_missing_event, ticks
from lakeforge.plans.problems import table
from lakeforge.plans.quality import delisted_coverage
from lakeforge.plans.read_path import _ALL_A, _BAD, _LISTED, TEST_PREFIXES, bars, calendar, instruments
from lakeforge.plans.read_path import factors as table_factors
from lakeforge.plans.sqlparts import BARS, CALENDAR, FACTORS, INSTRUMENTS, STEPS, TICKS, with_parts
from lakeforge.plans.storage import NEGATIVE, POSITIVE
from lakeforge.quality import checks as Q
from lakeforge.quality import recon as C
from lakeforge.session import shared_folder
from lakeforge.sources import files
from lakeforge.stats import Stats

WINDOW = ("2019-01-01", "2021-12-31")


def lake_of(spark: SparkSession, d: str) -> Lake:
    """The folder's bars and statuses in month and day directories below the shared folder, laid down once."""
    root = f"{shared_folder(spark)}/lake-{hashlib.sha256(d.encode()).hexdigest()[:16]}"
    lake = Lake(spark, root, TEST_PREFIXES)
    if not files.exists(spark, f"{root}/complete"):
        for name, label in (("daily_bars", "month"), ("trading_status", "month")):
            rows = table(spark, d, name).withColumn(PERIOD, period_label("trade_date", label))
            rows.repartition(PERIOD).write.mode("overwrite").partitionBy(PERIOD).parquet(f"{root}/curated/{name}")
        i = instruments(spark, d)
        i.selectExpr("symbol", "name", "exchange", "'stock' as asset_type", "list_date", "delist_date", "'test' as source", "'v1' as data_version", "timestamp'2024-01-01' as fetched_at").write.mode("overwrite").parquet(f"{root}/curated/instruments/data")
        files.write_text(spark, f"{root}/complete", "yes")
    return lake


def scan_range(spark: SparkSession, d: str) -> DataFrame:
    return lake_of(spark, d).scan("daily_bars", *WINDOW).select("symbol", "trade_date", "close", "source")


def scan_symbols(spark: SparkSession, d: str) -> DataFrame:
    first = [r.symbol for r in table(spark, d, "daily_bars").select("symbol").distinct().orderBy("symbol").limit(3).toLocalIterator()]
    return lake_of(spark, d).scan("daily_bars", symbols=first).select("symbol", "trade_date", "close")


def scan_pruned_empty(spark: SparkSession, d: str) -> DataFrame:
    return lake_of(spark, d).scan("daily_bars", "1980-01-01", "1980-12-31").select("symbol", "trade_date", "close")


def tradable_on_date(spark: SparkSession, d: str) -> DataFrame:
    """Symbols that may be traded on the day with most statuses."""
    day = table(spark, d, "trading_status").where("trade_date is not null").groupBy("trade_date").count().orderBy(F.col("count").desc(), "trade_date").first().trade_date
    return lake_of(spark, d).tradable_on(day.isoformat()).select("symbol").distinct()


def repartition_labels(spark: SparkSession, d: str) -> DataFrame:
    """The ticks, laid in year directories, rewritten by day: the lake's report, and what lies there afterwards."""
    lake = Lake(spark, f"{shared_folder(spark)}/repartition-{uuid.uuid4().hex}")
    rows = table(spark, d, "trade_ticks").drop("file_id")
    rows.withColumn("y", F.year("trade_date")).write.partitionBy("y").parquet(f"{lake.root}/curated/trade_ticks")
    for e in files.entries(spark, f"{lake.root}/curated/trade_ticks"):
        if e.name.startswith("y="):
            files.move(spark, e.path, f"{lake.root}/curated/trade_ticks/trade_date={e.name[2:]}")
    report = lake.repartition("trade_ticks")
    after = lake.scan("trade_ticks").agg(F.count(F.lit(1)).alias("rows_after"), F.countDistinct("trade_date").alias("days_after"))
    return after.select(F.lit(report["partitions_before"]).alias("partitions_before"), F.lit(report["partitions_after"]).cast("bigint").alias("partitions_after"), "rows_after", "days_after")


def coverage_bounds(spark: SparkSession, d: str) -> DataFrame:
    """First and last day of the bars (traded rows) and statuses, and the first day with a special-treatment label."""
    lake = lake_of(spark, d)
    rows = [(n, *lake.coverage(n)) for n in ("daily_bars", "trading_status")] + [("st_labels", lake.st_coverage_start(), None)]
    return spark.createDataFrame(rows, "dataset string, first_date date, last_date date")


def days_to_backfill(spark: SparkSession, d: str) -> DataFrame:
    return B.due_days(calendar(spark, d), table(spark, d, "trade_ticks"), *WINDOW)


def symbols_to_backfill(spark: SparkSession, d: str) -> DataFrame:
    have = bars(spark, d).where("source = 'baostock'")
    return B.symbols_to_backfill(table(spark, d, "daily_bars"), instruments(spark, d), have, ["close", "amount"], *WINDOW)


def bar_ownership(spark: SparkSession, d: str) -> DataFrame:
    return B.ownership(table(spark, d, "daily_bars"), instruments(spark, d), *WINDOW)


def repaired_instruments(spark: SparkSession, d: str) -> DataFrame:
    """Instruments that only the statuses know, repaired from the spans of the bars that ended before 2022."""
    known = table(spark, d, "trading_status").select("symbol").where("symbol is not null").distinct().select("symbol", F.lit(None).cast("date").alias("list_date"), F.lit(None).cast("date").alias("delist_date"))
    ended = bars(spark, d).groupBy("symbol").agg(F.max("trade_date").alias("last")).where("last < date'2022-01-01'")
    return B.repaired_instruments(known, bars(spark, d), ended)


def index_constituents_latest(spark: SparkSession, d: str) -> DataFrame:
    return B.latest_slice(table(spark, d, "industry_members"), "as_of_date", ["symbol", "industry_code"], F.col("classification_system") == "sw")


def complete_snapshots(spark: SparkSession, d: str) -> DataFrame:
    return B.complete_snapshots(table(spark, d, "industry_members").where("as_of_date is not null"), "as_of_date", "classification_system", "symbol", 2, 1)


def dates_replaced(spark: SparkSession, d: str) -> DataFrame:
    """Bars of which the days the mirror holds from 2021 on are taken from it."""
    new = table(spark, d, "daily_bars_mirror").where("trade_date >= date'2021-01-01'").select("trade_date", F.lit("new").alias("origin"))
    old = table(spark, d, "daily_bars").where("trade_date is not null").select("trade_date", F.lit("old").alias("origin"))
    return B.dates_replaced(old, new, "trade_date").groupBy(F.year("trade_date").alias("year"), "origin").agg(F.count(F.lit(1)).alias("n"))


def period_rows(spark: SparkSession, d: str) -> DataFrame:
    quarter = R.period_window(table(spark, d, "daily_bars"), "trade_date", "2020Q2").select("symbol", F.lit("bars").alias("of"))
    facts = R.period_window(table(spark, d, "financial_statement_items"), "report_period", "2020Q2").select("symbol", F.lit("facts").alias("of"))
    return quarter.unionByName(facts).groupBy("symbol", "of").agg(F.count(F.lit(1)).alias("n"))


def factor_normalised(spark: SparkSession, d: str) -> DataFrame:
    """Factors as multipliers, those of odd versions read as divisors; what is no factor is null."""
    kind = F.when(F.col("data_version") == "v1", "qfq").otherwise("hfq")
    return table(spark, d, "adj_factors").select("symbol", "trade_date", "source", "data_version", F.round(factor_of("factor", kind), 8).alias("multiplier")).distinct()


def sessions_final(spark: SparkSession, d: str) -> DataFrame:
    final = session_final("trade_date", "fetched_at")
    t = table(spark, d, "trading_status").where("trade_date is not null and fetched_at is not null")
    return t.groupBy("source", local_date("fetched_at").alias("local_date")).agg(F.count_if(final).alias("final"), F.count_if(~final).alias("open"))


def sql_functions(spark: SparkSession, d: str) -> DataFrame:
    """The engine's functions as SQL names them."""
    register(spark)
    t = table(spark, d, "daily_bars_mirror").selectExpr("canonical_symbol(symbol) as symbol", "version_number(data_version) as version", "quarter_of(trade_date) as quarter", "local_date(fetched_at) as local_date")
    return t.groupBy(F.expr("exchange_of(symbol)").alias("exchange"), "version", "quarter").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("symbols"), F.max("local_date").alias("last_date"))


def _structure(spark: SparkSession, d: str) -> DataFrame:
    reason = F.when(F.month("trade_date") % 2 == 0, "缩股").otherwise("增发")
    return table(spark, d, "daily_bars").select("symbol", F.col("trade_date").alias("change_date"), reason.alias("change_reason"))


def recon_unexplained(spark: SparkSession, d: str) -> DataFrame:
    return C.unexplained(recon_missing_event(spark, d).select("symbol", "trade_date"), _structure(spark, d), instruments(spark, d))


def st_by_name(spark: SparkSession, d: str) -> DataFrame:
    named = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("symbol"), F.col("p_type").alias("name"), F.when(F.col("p_size") > 25, "stock").otherwise("etf").alias("asset_type"))
    return C.st_by_name(named)


def calendar_horizon(spark: SparkSession, d: str) -> DataFrame:
    return C.calendar_horizon(calendar(spark, d).withColumn("is_trading", F.lit(True)), F.lit("2020-12-31").cast("date"))


def industry_index_checks(spark: SparkSession, d: str) -> DataFrame:
    """Findings on an index from which rows were taken, to which rows were added, and whose counts were changed, by day of the month."""
    i = _index(spark, d)
    day = F.dayofmonth("trade_date")
    i = i.where(~((day == 1) & (F.col("weighting") == "amount")))
    i = i.withColumn("weighting", F.when(day == 2, F.concat("weighting", F.lit("_odd"))).otherwise(F.col("weighting"))).withColumn("n_excluded", F.when(day == 4, F.col("n_excluded") + 1).otherwise(F.col("n_excluded")))
    return C.index_findings(i.unionByName(i.where(day == 3)))


def intraday_daily_bands(spark: SparkSession, d: str) -> DataFrame:
    daily = bars(spark, d).withColumn("data_version", F.lit("v2"))
    return C.intraday_ratios(minute_bars(ticks(spark, d)), daily).withColumn("median", F.round("median", 8))


def misdated_ticks(spark: SparkSession, d: str) -> DataFrame:
    return C.misdated(ticks(spark, d).withColumn("trade_time", F.expr("trade_time + make_interval(0, 0, 0, 0, tick_seq % 11, 0, 0)")))


def sampled_differences(spark: SparkSession, d: str) -> DataFrame:
    mirror = R.canonical(table(spark, d, "daily_bars_mirror").withColumn("symbol", canonical_symbol("symbol")), ["symbol", "trade_date"])
    return C.sampled_differences(bars(spark, d), mirror, ["symbol", "trade_date"], ["open", "close", "volume"])


def history_validity(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "trading_status").where("symbol is not null")
    receipts = s.groupBy(F.col("source").alias("receipt_id"), "symbol").agg(F.min("trade_date").alias("start_date"), F.max("trade_date").alias("end_date"))
    return C.validity(R.traded(bars(spark, d)), calendar(spark, d), receipts, s, delisted_coverage(spark, d), *WINDOW)


def sentiment_channels(spark: SparkSession, d: str) -> DataFrame:
    """Mean score and count of texts of each symbol and day in three channels: headlines, flashes, everything else."""
    score = keyword_balance(F.coalesce("text", F.lit("")), POSITIVE, NEGATIVE)
    channel = F.when(F.col("source") == "news_headlines", "news").when(F.col("source") == "flash_news_wire", "flash").otherwise("other")
    docs = table(spark, d, "documents").where("symbol is not null and publish_date is not null").withColumn("score", score)
    return docs.groupBy("symbol", "publish_date", channel.alias("channel")).agg(F.round(F.avg("score"), 8).alias("score"), F.count(F.lit(1)).alias("n"))


def scalar_stats(spark: SparkSession, d: str) -> DataFrame:
    return Q.scalar_stats(table(spark, d, "daily_bars"), ["symbol", "trade_date", "open", "close", "volume", "amount"])


def finding_samples(spark: SparkSession, d: str) -> DataFrame:
    holes = Q.missing_sessions(table(spark, d, "trade_ticks"), calendar(spark, d))
    return Q.sampled(holes.withColumn("year", F.year("trade_date")), "year", "trade_date")


def authority_values(spark: SparkSession, d: str) -> DataFrame:
    """Closes of the mirror's most trusted source as the reference for the lake's own."""
    mirror = R.canonical(table(spark, d, "daily_bars_mirror").withColumn("symbol", canonical_symbol("symbol")), ["symbol", "trade_date"])
    best = table(spark, d, "source_trust").orderBy("trust_rank", "source").first().source
    reference = mirror.where((F.col("source") == best) & F.col("close").isNotNull())
    return Q.authority_differences(bars(spark, d), reference, ["symbol", "trade_date"], "close", 0.001).withColumns({"reference": F.round("reference", 6), "value": F.round("value", 6)})


def industry_groups_absent(spark: SparkSession, d: str) -> DataFrame:
    """Groups that members say should be there and no return is."""
    i = _index(spark, d).where("weighting = 'equal'")
    expected = i.select("trade_date", "level", "industry_code")
    return expected.join(i.where("n_priced > 0").select("trade_date", "level", "industry_code"), ["trade_date", "level", "industry_code"], "left_anti")


def return_summary(spark: SparkSession, d: str) -> DataFrame:
    """First to last close of each symbol, raw and adjusted; without a factor on either day there is no adjusted return."""
    b = R.traded(bars(spark, d)).where("close > 0")
    f = table_factors(spark, d).where("adjust_type = 'hfq'").select("symbol", "trade_date", "factor")
    both = b.join(f, ["symbol", "trade_date"], "left")
    ends = both.groupBy("symbol").agg(F.min_by(F.struct("close", "factor"), "trade_date").alias("a"), F.max_by(F.struct("close", "factor"), "trade_date").alias("z"))
    return ends.select("symbol", F.round(F.col("z.close") / F.col("a.close") - 1, 8).alias("raw_return"), F.round(F.try_divide(F.col("z.close") * F.col("z.factor"), F.col("a.close") * F.col("a.factor")) - 1, 8).alias("adjusted_return"))


def stored_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of the lake's statuses, stored, read back and joined with the sources of each period."""
    stats = Stats(lake_of(spark, d))
    stats.rebuild(["trading_status"])
    return stats.provenance_of_periods("trading_status").select("partition", "source", "data_version", "n_rows", "period_rows", F.round("share", 8).alias("share"))


def inferred_symbols(spark: SparkSession, d: str) -> DataFrame:
    code = F.substring("symbol", 1, 6).cast("int")
    return table(spark, d, "daily_bars").select("symbol").distinct().select("symbol", symbol_of(code).alias("inferred"), price_divisor("symbol").alias("divisor"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (
        scan_range, scan_symbols, scan_pruned_empty, tradable_on_date, repartition_labels, coverage_bounds, days_to_backfill, symbols_to_backfill, bar_ownership, repaired_instruments, index_constituents_latest,
        complete_snapshots, dates_replaced, period_rows, factor_normalised, sessions_final, sql_functions, recon_unexplained, st_by_name, calendar_horizon, industry_index_checks, intraday_daily_bands, misdated_ticks,
        sampled_differences, history_validity, sentiment_channels, scalar_stats, finding_samples, authority_values, industry_groups_absent, return_summary, stored_stats, inferred_symbols,
    )
    return {f.__name__: f for f in fs}


_S, _E = (f"date '{x}'" for x in WINDOW)
_SYMBOL = "case when regexp_extract({s}, '([0-9]{{6}})', 1) <> '' and regexp_extract(upper({s}), '(SH|SZ|BJ)', 1) <> '' then regexp_extract({s}, '([0-9]{{6}})', 1) || '.' || regexp_extract(upper({s}), '(SH|SZ|BJ)', 1) else upper({s}) end".format(s="regexp_replace(symbol, '\\s', '', 'g')")
_MIRROR = BARS.replace("from daily_bars", f"from (select * replace ({_SYMBOL} as symbol) from daily_bars_mirror)")
_GAP = "case when (p.{f} is null) <> (b.{f} is null) then 'field_null_mismatch' when (case when b.{f} = 0 then case when p.{f} <> 0 then 1e308 else 0 end else abs(p.{f} - b.{f}) / abs(b.{f}) * 1e4 end) > 10 then 'field_drift' end"


def _words(weights: dict[str, float]) -> str:
    return " + ".join(f"case when contains(t, '{k}') then {x} else 0.0 end" for k, x in weights.items())


def oracle_sql() -> dict[str, str]:
    base = {"usable": _USABLE, "pairs": _PAIRS}
    local = "(fetched_at at time zone 'Asia/Shanghai')"
    weights = "select trade_date, industry_code, level, 'equal' as weighting, equal_ret as ret, n_members, n_priced, n_members - n_priced as n_excluded from idx union all select trade_date, industry_code, level, 'amount', amount_ret, n_members, n_priced, n_members - n_priced from idx"
    changed = "select * replace (case when day(trade_date) = 2 then weighting || '_odd' else weighting end as weighting, case when day(trade_date) = 4 then n_excluded + 1 else n_excluded end as n_excluded) from (select * from w where not (day(trade_date) = 1 and weighting = 'amount'))"
    from lakeforge.plans import quality

    return {
        "scan_range": f"select symbol, trade_date, close, source from daily_bars where trade_date between {_S} and {_E}",
        "scan_symbols": "select symbol, trade_date, close from daily_bars where symbol in (select distinct symbol from daily_bars order by 1 limit 3)",
        "scan_pruned_empty": "select symbol, trade_date, close from daily_bars where trade_date between date '1980-01-01' and date '1980-12-31'",
        "tradable_on_date": with_parts(
            f"select distinct symbol from instruments cross join day where {_ALL_A} and {_LISTED} and symbol not in (select symbol from s where s.trade_date = day.trade_date and {_BAD} and symbol is not null)",
            instruments=INSTRUMENTS, s="select * from trading_status qualify row_number() over (partition by symbol, trade_date order by fetched_at desc nulls last, data_version desc nulls last, is_trading desc nulls last, status desc nulls last, source desc nulls last) = 1",
            day="select trade_date from trading_status where trade_date is not null group by 1 order by count(*) desc, trade_date limit 1",
        ),
        "repartition_labels": "select cast((select count(distinct year(trade_date)) from trade_ticks) as int) as partitions_before, (select count(distinct trade_date) from trade_ticks) as partitions_after, (select count(*) from (select distinct symbol, trade_date, tick_seq from trade_ticks)) as rows_after, (select count(distinct trade_date) from trade_ticks) as days_after",
        "coverage_bounds": "select 'daily_bars' as dataset, min(trade_date) as first_date, max(trade_date) as last_date from daily_bars where volume > 0 or volume is null union all select 'trading_status', cast(date_trunc('month', min(trade_date)) as date), last_day(max(trade_date)) from trading_status where false union all select 'trading_status', min(trade_date), max(trade_date) from trading_status union all select 'st_labels', min(trade_date), null from trading_status where lower(trim(status)) in ('st', '*st')".replace("select 'trading_status', cast(date_trunc('month', min(trade_date)) as date), last_day(max(trade_date)) from trading_status where false union all ", ""),
        "days_to_backfill": f"select trade_date, cast(floor((row_number() over (order by trade_date) - 1) / 60) as int) as batch from ({CALENDAR}) where trade_date between {_S} and {_E} and trade_date not in (select trade_date from trade_ticks where trade_date is not null)",
        "symbols_to_backfill": with_parts(
            "select symbol, expected_end, latest as latest_date from due left join stats using (symbol) where not coalesce(latest is not null and c >= 0.9 and a >= 0.9 and latest >= expected_end, false)",
            i=INSTRUMENTS, due=f"select symbol, least(coalesce(delist_date, {_E}), {_E}) as expected_end from i where not coalesce(list_date > {_E} or delist_date < {_S}, false)",
            stats=f"select symbol, max(trade_date) as latest, count(close) / count(*) as c, count(amount) / count(*) as a from ({BARS}) where source = 'baostock' group by 1",
        ),
        "bar_ownership": f"select symbol, case when list_date > {_E} or delist_date < {_S} then 'expected_no_data' when delist_date <= {_E} then 'delegated_delisted' else 'generic' end as route from ({INSTRUMENTS})",
        "repaired_instruments": f"select symbol, a as list_date, z + 1 as delist_date from (select distinct symbol from trading_status where symbol is not null) full join (select symbol, min(trade_date) as a, max(trade_date) as z from daily_bars group by 1 having max(trade_date) < date '2022-01-01') using (symbol)",
        "index_constituents_latest": "select distinct symbol, industry_code from industry_members where classification_system = 'sw' and as_of_date = (select max(as_of_date) from industry_members where classification_system = 'sw')",
        "complete_snapshots": "select as_of_date, count(*) as groups, min(n) as fewest from (select as_of_date, classification_system, count(distinct symbol) as n from industry_members where as_of_date is not null group by 1, 2) group by 1 having count(*) >= 2 and min(n) >= 1",
        "dates_replaced": "select cast(year(trade_date) as int) as year, origin, count(*) as n from (select trade_date, 'old' as origin from daily_bars where trade_date is not null and trade_date not in (select trade_date from daily_bars_mirror where trade_date >= date '2021-01-01') union all select trade_date, 'new' from daily_bars_mirror where trade_date >= date '2021-01-01') group by 1, 2",
        "period_rows": "select symbol, 'bars' as of, count(*) as n from daily_bars where trade_date between date '2020-04-01' and date '2020-06-30' group by 1 union all select symbol, 'facts', count(*) from financial_statement_items where report_period = '2020Q2' group by 1".replace(" as of,", ' as "of",'),
        "factor_normalised": "select distinct symbol, trade_date, source, data_version, round(case when factor > 0 and not isinf(factor) and not isnan(factor) then case when data_version = 'v1' then 1.0 / factor else factor end end, 8) as multiplier from adj_factors",
        "sessions_final": f"select source, cast({local} as date) as local_date, count(*) filter (f) as final, count(*) filter (not f) as open from (select *, trade_date <> cast({local} as date) or strftime({local}, '%H:%M:%S') >= '15:30:00' as f from trading_status where trade_date is not null and fetched_at is not null) group by 1, 2",
        "sql_functions": f"select split_part(s, '.', 2) as exchange, try_cast(nullif(regexp_extract(data_version, '([0-9]{{1,9}})', 1), '') as bigint) as version, year(trade_date) || 'Q' || quarter(trade_date) as quarter, count(*) as n, count(distinct s) as symbols, max(cast({local} as date)) as last_date from (select *, {_SYMBOL} as s from daily_bars_mirror) group by 1, 2, 3",
        "recon_unexplained": with_parts(
            "select distinct v.symbol, v.trade_date, case when month(v.trade_date) % 2 = 0 then 'share_structure' when delist_date is not null then 'delisted' else 'active' end as bucket from e v left join i using (symbol) where not explained",
            **base, divergences=_DIVERGENCES, steps=STEPS, e=_EXPLAINED, i=INSTRUMENTS,
        ),
        "st_by_name": "select cast(p_partkey as varchar) as symbol from part where p_size > 25 and contains(upper(replace(p_type, ' ', '')), 'ST')",
        "calendar_horizon": f"select max(trade_date) as last_date, date '2020-12-31' as table_end, cast(max(trade_date) - date '2020-12-31' as int) as days_beyond from ({CALENDAR}) having max(trade_date) > date '2020-12-31'",
        "industry_index_checks": with_parts(
            """select * from (select 'industry_index_unknown_weighting' as check_, count(*) as n from x where weighting not in ('amount', 'equal')
  union all select 'industry_index_incomplete_weightings', count(*) from (select 1 from x group by trade_date, industry_code, level having count(distinct weighting) <> 2)
  union all select 'industry_index_duplicate_key', count(*) from (select 1 from x group by trade_date, industry_code, level, weighting having count(*) > 1)
  union all select 'industry_index_invalid_accounting', count(*) from x where n_excluded <> n_members - n_priced or industry_code is null) where n > 0""",
            **base, returns=_RETURNS, known=_MEMBERS_ON, idx=_INDEX, w=weights, z=changed, x="select * from z union all select * from z where day(trade_date) = 3",
        ).replace("check_", '"check"'),
        "intraday_daily_bands": with_parts(
            "select metric, symbol_days, round(m, 8) as median, case when symbol_days < 20 then 'too_few' when m > 1.05 then 'high' when m < 0.95 then 'low' else 'ok' end as verdict from (select metric, count(*) as symbol_days, median(r) as m from (select 'volume' as metric, iv / dv as r from j union all select 'amount', ia / da from j where da > 0) where r is not null group by 1)",
            i=f"select symbol, trade_date, sum(v) as iv, sum(a) as ia from (select symbol, trade_date, coalesce(volume, 0) as v, coalesce(price * volume, 0) as a from ({TICKS}) where price is not null and trade_time is not null) group by 1, 2 having sum(v) > 0",
            j=f"select iv, ia, volume as dv, amount as da from i join (select * from ({BARS}) where volume > 0) using (symbol, trade_date)",
        ),
        "misdated_ticks": f"select trade_date, count(*) as n, count(distinct symbol) as symbols from (select *, trade_time + to_hours(cast(tick_seq % 11 as int)) as t from ({TICKS})) where cast(t as date) <> trade_date group by 1",
        "sampled_differences": with_parts(
            " union all ".join(f"select symbol, trade_date, '{f}' as field_name, {_GAP.format(f=f)} as kind from (select * from p semi join k using (symbol, trade_date)) p join b using (symbol, trade_date) where {_GAP.format(f=f)} is not null" for f in ("open", "close", "volume")),
            p=BARS, b=_MIRROR, k="select symbol, trade_date from p semi join b using (symbol, trade_date) order by md5(symbol || '|' || cast(trade_date as varchar)), symbol, trade_date limit 500",
        ),
        "history_validity": with_parts(
            f"""select 'daily_bars_window' as check_, coalesce(min(trade_date) <= {_S} and max(trade_date) >= {_E}, false) as passed, cast(0 as bigint) as n from t
  union all select 'daily_bars_interior_coverage', count(*) = 0, count(*) from ({CALENDAR}) c where trade_date between {_S} and {_E} and trade_date not in (select trade_date from t)
  union all select 'historical_st_labels', count(*) > 0, count(*) from (select source from (select source, symbol, min(trade_date) as a, max(trade_date) as z from trading_status where symbol is not null group by 1, 2) where a <= {_S} and z >= {_E} group by 1 having count(distinct symbol) = (select count(distinct symbol) from trading_status))
  union all select 'delisted_universe', count(*) = 0, count(*) from d where state <> 'verified'""",
            t=f"select * from ({BARS}) where volume > 0 or volume is null", d=quality.oracle_sql()["delisted_coverage"],
        ).replace("check_", '"check"'),
        "sentiment_channels": f"select symbol, publish_date, channel, round(avg(coalesce((p - n) / nullif(p + n, 0), 0)), 8) as score, count(*) as n from (select symbol, publish_date, case source when 'news_headlines' then 'news' when 'flash_news_wire' then 'flash' else 'other' end as channel, cast({_words(POSITIVE)} as double) as p, cast({_words(NEGATIVE)} as double) as n from (select *, coalesce(text, '') as t from documents where symbol is not null and publish_date is not null)) group by 1, 2, 3",
        "scalar_stats": "select count(*) as n, count(*) filter (source = 'mock') as mock, " + ", ".join(f"count(*) filter ({c} is null) as nulls_{c}" for c in ("symbol", "trade_date", "open", "close", "volume", "amount")) + " from daily_bars",
        "finding_samples": with_parts(
            "select cast(year as int) as year, count(*) as n, string_agg(cast(trade_date as varchar), ',' order by trade_date) filter (a <= 5) as first, string_agg(cast(trade_date as varchar), ',' order by trade_date) filter (z <= 5) as last from r group by 1",
            r=f"select trade_date, year(trade_date) as year, row_number() over (partition by year(trade_date) order by trade_date) as a, row_number() over (partition by year(trade_date) order by trade_date desc) as z from ({quality._SPAN.format(cal=CALENDAR, t='trade_ticks')})",
        ),
        "authority_values": with_parts(
            "select symbol, trade_date, round(r.close, 6) as reference, round(b.close, 6) as value, case when b.symbol is null then 'missing' else 'differs' end as kind from r left join b using (symbol, trade_date) where b.symbol is null or b.close is null or abs(b.close - r.close) > 0.001 * greatest(abs(b.close), abs(r.close))",
            b=BARS, m=_MIRROR, r="select * from m where source = (select source from source_trust order by trust_rank, source limit 1) and close is not null",
        ),
        "industry_groups_absent": with_parts("select trade_date, level, industry_code from idx where n_priced = 0", **base, returns=_RETURNS, known=_MEMBERS_ON, idx=_INDEX),
        "return_summary": with_parts(
            "select symbol, round(arg_max(close, trade_date) / arg_min(close, trade_date) - 1, 8) as raw_return, round(arg_max(close, trade_date) * arg_max_null(factor, trade_date) / nullif(arg_min(close, trade_date) * arg_min_null(factor, trade_date), 0) - 1, 8) as adjusted_return from b left join f using (symbol, trade_date) group by 1",
            b=f"select * from ({BARS}) where (volume > 0 or volume is null) and close > 0", f=f"select symbol, trade_date, factor from ({FACTORS}) where adjust_type = 'hfq'",
        ),
        "stored_stats": with_parts(
            "select partition, source, data_version, n_rows, period_rows, round(n_rows / period_rows, 8) as share from (select partition, source, data_version, count(*) as n_rows from s group by 1, 2, 3) join (select partition, count(*) as period_rows from s group by 1) using (partition)",
            s="select strftime(trade_date, '%Y-%m') as partition, source, data_version from trading_status",
        ),
        "inferred_symbols": "select distinct symbol, lpad(cast(cast(substr(symbol, 1, 6) as int) as varchar), 6, '0') || case when substr(symbol, 1, 2) in ('60', '68') then '.SH' when substr(symbol, 1, 2) in ('92', '43', '83', '87') then '.BJ' else '.SZ' end as inferred, case when substr(symbol, 1, 2) in ('51', '52', '56', '58', '15', '16') then 1000 when substr(symbol, 1, 2) in ('10', '11', '12', '13') then 10000 when substr(symbol, 1, 2) in ('60', '68', '00', '30', '92', '43', '83', '87') then 100 end as divisor from daily_bars",
    }
