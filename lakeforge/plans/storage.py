"""Queries of the store, the catalogue and the tools on the test lake."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.lake import Lake, period_label
from lakeforge.operators import storage as T
from lakeforge.operators.readpath import traded
from lakeforge.plans.problems import table
from lakeforge.plans.read_path import bars, calendar, instruments
from lakeforge.plans.sqlparts import BARS, CALENDAR, INSTRUMENTS, STATUS, with_parts
from lakeforge.session import shared_folder

#: Weighted words of the headline score.
POSITIVE = {"增长": 1.0, "盈利": 1.2, "超预期": 1.3, "中标": 1.0, "回购": 1.1, "增持": 1.2, "突破": 0.9, "创新高": 1.2, "分红": 1.0, "利好": 1.1, "签约": 0.8, "获批": 1.0, "大涨": 1.0, "涨停": 0.8}
NEGATIVE = {"亏损": 1.2, "下降": 0.9, "减持": 1.1, "立案": 1.3, "处罚": 1.3, "警示": 1.0, "诉讼": 1.1, "违约": 1.2, "退市": 1.4, "风险": 0.7, "下滑": 1.0, "暴雷": 1.4, "调查": 1.1, "大跌": 1.0, "跌停": 0.8}


def compact_merge(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "daily_bars")
    late = F.col("fetched_at") >= F.lit("2021-01-01").cast("timestamp")
    merged = T.upserted(rows.where(~late), rows.where(late), ["symbol", "trade_date"])
    return merged.groupBy(period_label("trade_date", "month").alias("period")).agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"))


def instruments_merge(spark: SparkSession, d: str) -> DataFrame:
    """Instruments listed before 2021 meet a delivery of those whose last bar is no older than mid-2019; the others were absent once."""
    i = instruments(spark, d)
    seen = i.join(table(spark, d, "daily_bars").where("trade_date >= date'2019-06-28'").select("symbol"), "symbol", "left_semi")
    absences = i.join(seen.select("symbol"), "symbol", "left_anti").select("symbol", F.lit(1).alias("absences"))
    return T.merged_instruments(i.where("list_date < date'2021-01-01'"), seen, absences, "2019-06-28")


def stats_partitions(spark: SparkSession, d: str) -> DataFrame:
    return T.partition_stats(table(spark, d, "daily_bars"), period_label("trade_date", "month"))


def provenance_mix(spark: SparkSession, d: str) -> DataFrame:
    return T.provenance_mix(table(spark, d, "daily_bars"), period_label("trade_date", "year"))


def provenance_buckets(spark: SparkSession, d: str) -> DataFrame:
    return T.provenance_buckets(table(spark, d, "daily_bars").where("trade_date is not null"), "trade_date")


def heatmap_cells(spark: SparkSession, d: str) -> DataFrame:
    return T.heatmap(traded(bars(spark, d)), calendar(spark, d))


def sector_code_map(spark: SparkSession, d: str) -> DataFrame:
    """Parts as sectors, and those of the larger sizes as boards of the same number, some under another name."""
    part = table(spark, d, "part")
    sectors = part.select(T.board_label("p_partkey").alias("sector_code"), F.concat("p_name", F.lit(" board")).alias("sector_name"))
    boards = part.where("p_size > 20").select(F.col("p_partkey").alias("board_code"), F.when(F.col("p_size") > 40, F.upper("p_name")).otherwise(F.col("p_name")).alias("board_name"))
    return T.board_codes(sectors, boards, F.replace("sector_name", F.lit(" board"), F.lit("")), F.col("board_name"))


def sector_fuzzy_routing(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "industry_members").where("industry_name is not null").select(F.col("industry_name").alias("name")).distinct()
    words = names.select(F.explode(F.split("name", " ")).alias("name")).where("length(name) > 4")
    return T.routed_names(names, words)


def action_expand(spark: SparkSession, d: str) -> DataFrame:
    plans = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", F.col("l_discount").alias("cash"), F.when(F.col("l_tax") > 0.05, F.col("l_tax")).alias("bonus"), F.when(F.col("l_returnflag") == "R", F.lit(0.5)).alias("transfer"))
    e = T.expanded_actions(plans, {"cash_dividend": "cash", "bonus": "bonus", "transfer": "transfer"}, ["l_orderkey", "l_linenumber"])
    return e.groupBy("l_orderkey", "action_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("ratio"), 8).alias("most"))


def related_symbols_explode(spark: SparkSession, d: str) -> DataFrame:
    listed = F.concat_ws(";", F.lower("symbol"), F.lit(" 600000.SH,12"), F.replace("symbol", F.lit("."), F.lit("-")), F.col("symbol"))
    rows = table(spark, d, "dragon_tiger").select("symbol", "trade_date", listed.alias("listed"))
    return T.related_symbols(rows, "listed", ["symbol", "trade_date"]).groupBy("symbol", "related").agg(F.count(F.lit(1)).alias("n"))


def keyword_sentiment(spark: SparkSession, d: str) -> DataFrame:
    score = T.keyword_balance(F.coalesce("text", F.lit("")), POSITIVE, NEGATIVE)
    docs = table(spark, d, "documents").where("symbol is not null and publish_date is not null").withColumn("score", score)
    return docs.groupBy("symbol", "publish_date").agg(F.round(F.avg("score"), 8).alias("score"), F.count(F.lit(1)).alias("documents"))


def ordered_priority_topn(spark: SparkSession, d: str) -> DataFrame:
    hot = table(spark, d, "dragon_tiger").groupBy("symbol").agg(F.count(F.lit(1)).alias("score")).where("score >= 30")
    big = bars(spark, d).groupBy("symbol").agg(F.max("amount").alias("score"))
    return T.priority_top([hot, big], 25).withColumn("score", F.round("score", 4))


def resolve_symbol(spark: SparkSession, d: str) -> DataFrame:
    return T.resolved(instruments(spark, d), "3", 1000).select("symbol", "name", "live")


def page_payload(spark: SparkSession, d: str) -> DataFrame:
    return T.page(bars(spark, d).select("symbol", "trade_date", "close"), ["trade_date", "symbol"], 200, 200)


def top_liquid(spark: SparkSession, d: str) -> DataFrame:
    return traded(bars(spark, d)).groupBy("symbol").agg(F.max("amount").alias("amount"), F.max("volume").alias("volume")).orderBy(F.col("amount").desc_nulls_last(), F.col("volume").desc_nulls_last(), "symbol").limit(12)


def purge_orphans(spark: SparkSession, d: str) -> DataFrame:
    return T.without_orphans(table(spark, d, "documents").select("doc_id", "symbol"), table(spark, d, "daily_bars"))


def stream_compact_available_now(spark: SparkSession, d: str) -> DataFrame:
    """trading_status staged in three deliveries, streamed into a lake, read back canonical."""
    from lakeforge.streaming.compact import stream_compact

    at = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    rows = table(spark, d, "trading_status")
    for i in range(3):
        rows.where(F.pmod(F.xxhash64("symbol", "trade_date", "source"), F.lit(3)) == i).write.parquet(f"{at}/staging/{i}")
    lake = Lake(spark, f"{at}/lake")
    stream_compact(lake, "trading_status", f"{at}/staging", f"{at}/checkpoint", 1).awaitTermination()
    return lake.load("trading_status").select("symbol", "trade_date", "is_trading", "status", "source", F.unix_seconds("fetched_at").alias("fetched_epoch"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = (
        compact_merge, instruments_merge, stats_partitions, provenance_mix, provenance_buckets, heatmap_cells, sector_code_map, sector_fuzzy_routing, action_expand, related_symbols_explode,
        keyword_sentiment, ordered_priority_topn, resolve_symbol, page_payload, top_liquid, purge_orphans, stream_compact_available_now,
    )
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    words = lambda w: " + ".join(f"case when contains(t, '{k}') then {x} else 0.0 end" for k, x in w.items())
    epoch = lambda c: f"cast(floor(epoch({c})) as bigint)"
    return {
        "compact_merge": f"select strftime(trade_date, '%Y-%m') as period, count(*) as n, cast(sum(volume) as bigint) as volume from ({BARS}) group by 1",
        "instruments_merge": with_parts(
            """select symbol, coalesce(new_name, old_name) as name, coalesce(new_list, old_list) as list_date, case when gone then date '2019-06-28' else coalesce(new_delist, old_delist) end as delist_date, absences,
  case when absent then case when share > 0.05 then 'suppressed' when gone then 'delisted' else 'pending' end when known is null then 'new' when seen then 'seen' else 'kept' end as state
  from (select *, coalesce(absent and share <= 0.05 and absences >= 2, false) as gone from (select *, cast(case when absent then coalesce(before, 0) + case when share <= 0.05 then 1 else 0 end when seen then 0 else coalesce(before, 0) end as int) as absences from
  (select *, coalesce(count(*) filter (absent) over () / nullif(count(*) filter (live) over (), 0), 0.0) as share from (select *, live and seen is null as absent from
  (select coalesce(o.symbol, n.symbol) as symbol, o.name as old_name, o.list_date as old_list, o.delist_date as old_delist, n.name as new_name, n.list_date as new_list, n.delist_date as new_delist, o.known, n.seen, a.absences as before,
  coalesce(o.known, false) and (o.delist_date is null or o.delist_date >= date '2019-06-28') as live from o full join n using (symbol) left join a on a.symbol = coalesce(o.symbol, n.symbol))))))""",
            i=INSTRUMENTS, o="select *, true as known from i where list_date < date '2021-01-01'", n="select *, true as seen from i where symbol in (select symbol from daily_bars where trade_date >= date '2019-06-28')", a="select symbol, 1 as absences from i where symbol not in (select symbol from n)",
        ),
        "stats_partitions": f"select strftime(trade_date, '%Y-%m') as partition, count(*) as n_rows, count(distinct symbol) as symbols, {epoch('max(fetched_at)')} as fetched_epoch from daily_bars group by 1",
        "provenance_mix": f"select strftime(trade_date, '%Y') as partition, source, data_version, count(*) as n_rows, {epoch('min(fetched_at)')} as first_epoch, {epoch('max(fetched_at)')} as last_epoch from daily_bars group by 1, 2, 3",
        "provenance_buckets": "select unit, cast(case unit when 'day' then trade_date when 'month' then date_trunc('month', trade_date) else date_trunc('year', trade_date) end as date) as bucket_date, source, count(*) as n_rows from (select * from daily_bars where trade_date is not null), (select case when count(distinct trade_date) <= 400 then 'day' when count(distinct date_trunc('month', trade_date)) <= 400 then 'month' else 'year' end as unit from daily_bars where trade_date is not null) group by 1, 2, 3",
        "heatmap_cells": with_parts(
            "select symbol, month_date, sessions, coalesce(present, 0) as present, case when coalesce(present, 0) = 0 then 'none' when present >= sessions then 'full' else 'part' end as cell from (select symbol, cast(unnest(generate_series(lo, hi, interval 1 month)) as date) as month_date from (select symbol, cast(min(month_date) as timestamp) as lo, cast(max(month_date) as timestamp) as hi from h group by 1)) join s using (month_date) left join h using (symbol, month_date)",
            s=f"select cast(date_trunc('month', trade_date) as date) as month_date, count(*) as sessions from ({CALENDAR}) group by 1",
            h=f"select symbol, cast(date_trunc('month', trade_date) as date) as month_date, count(*) as present from (select distinct symbol, trade_date from ({BARS}) where volume > 0 or volume is null) group by 1, 2",
        ),
        "sector_code_map": """select s.sector_code, s.sector_name, b.board_code, b.board_name, case when b.board_code is null then 'predicted_no_members' when replace(s.sector_name, ' board', '') = b.board_name then 'identity' else 'identity_name_mismatch' end as match_type from
  (select 'BK' || case when length(cast(p_partkey as varchar)) < 4 then lpad(cast(p_partkey as varchar), 4, '0') else cast(p_partkey as varchar) end as sector_code, p_name || ' board' as sector_name from part) s left join
  (select p_partkey as board_code, case when p_size > 40 then upper(p_name) else p_name end as board_name from part where p_size > 20) b on s.sector_code = 'BK' || case when length(cast(board_code as varchar)) < 4 then lpad(cast(board_code as varchar), 4, '0') else cast(board_code as varchar) end""",
        "sector_fuzzy_routing": with_parts(
            "select name, case when same > 0 then name when n = 1 then one end as target, case when same > 0 then 'exact' when n = 1 then 'contains' when n > 1 then 'ambiguous' else 'none' end as tier from (select n.name, count(w.name) as n, max(w.name) as one, count(*) filter (w.name = n.name) as same from n left join w on contains(n.name, w.name) group by 1)",
            n="select distinct industry_name as name from industry_members where industry_name is not null", w="select distinct name from (select unnest(string_split(name, ' ')) as name from n) where length(name) > 4",
        ),
        "action_expand": "select l_orderkey, action_type, count(*) as n, round(max(ratio), 8) as most from (select l_orderkey, 'cash_dividend' as action_type, l_discount / 10 as ratio from lineitem union all select l_orderkey, 'bonus', l_tax / 10 from lineitem where l_tax > 0.05 union all select l_orderkey, 'transfer', 0.05 from lineitem where l_returnflag = 'R') where ratio > 0 group by 1, 2",
        "related_symbols_explode": "select symbol, related, count(*) as n from (select symbol, unnest([symbol, '600000.SH']) as related from dragon_tiger) where regexp_matches(related, '^[0-9]{6}[.](SH|SZ)$') group by 1, 2",
        "keyword_sentiment": f"select symbol, publish_date, round(avg(coalesce((p - n) / nullif(p + n, 0), 0)), 8) as score, count(*) as documents from (select symbol, publish_date, cast({words(POSITIVE)} as double) as p, cast({words(NEGATIVE)} as double) as n from (select symbol, publish_date, coalesce(text, '') as t from documents where symbol is not null and publish_date is not null)) group by 1, 2",
        "ordered_priority_topn": f"""select symbol, list, round(score, 4) as score, cast(row_number() over (order by list, score desc nulls last, symbol) as int) as position from (select symbol, list, score from (select symbol, 0 as list, cast(count(*) as double) as score from dragon_tiger group by 1 having count(*) >= 30
  union all select symbol, 1, max(amount) from ({BARS}) group by 1) qualify row_number() over (partition by symbol order by list) = 1) order by list, score desc nulls last, symbol limit 25""",
        "resolve_symbol": with_parts("select symbol, name, delist_date is null as live from i where symbol like '3%' or contains(name, '3') order by live desc, symbol limit 1000", i=INSTRUMENTS),
        "page_payload": f"select symbol, trade_date, close, (select count(*) from ({BARS})) as total from (select symbol, trade_date, close from ({BARS}) order by trade_date, symbol limit 200 offset 200)",
        "top_liquid": f"select symbol, max(amount) as amount, max(volume) as volume from ({BARS}) where volume > 0 or volume is null group by 1 order by amount desc nulls last, volume desc nulls last, symbol limit 12",
        "purge_orphans": "select doc_id, symbol from documents where symbol in (select symbol from daily_bars)",
        "stream_compact_available_now": f"select symbol, trade_date, is_trading, status, source, {epoch('fetched_at')} as fetched_epoch from ({STATUS})",
    }
