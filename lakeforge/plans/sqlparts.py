"""Shared SQL of the oracles."""

from __future__ import annotations

BAR_COLUMNS = ["symbol", "trade_date", "open", "high", "low", "close", "volume", "amount", "source", "data_version", "fetched_at"]


def canonical_sql(table: str, key: list[str], columns: list[str]) -> str:
    rest = [c for c in columns if c not in key]
    first = [c for c in ("fetched_at", "data_version") if c in rest]
    order = ", ".join(f"{c} desc nulls last" for c in [*first, *(c for c in rest if c not in first)])
    return f"select {', '.join(columns)} from {table} qualify row_number() over (partition by {', '.join(key)} order by {order}) = 1"


BARS = canonical_sql("daily_bars", ["symbol", "trade_date"], BAR_COLUMNS)
FACTORS = canonical_sql("adj_factors", ["symbol", "trade_date", "adjust_type"], ["symbol", "trade_date", "adjust_type", "factor", "source", "data_version", "fetched_at"])
STATUS = canonical_sql("trading_status", ["symbol", "trade_date"], ["symbol", "trade_date", "is_trading", "status", "source", "data_version", "fetched_at"])
ITEMS = canonical_sql("financial_statement_items", ["symbol", "report_period", "statement_type", "item_code", "announce_date"], ["symbol", "report_period", "statement_type", "item_code", "item_value", "announce_date", "source", "data_version", "fetched_at"])
MEMBERS = canonical_sql("industry_members", ["symbol", "classification_system", "as_of_date"], ["symbol", "classification_system", "industry_code", "industry_name", "as_of_date", "source", "data_version", "fetched_at"])
TICKS = canonical_sql("(select * exclude (file_id) from trade_ticks)", ["symbol", "trade_date", "tick_seq"], ["symbol", "trade_date", "tick_seq", "trade_time", "price", "volume", "direction", "source", "data_version", "fetched_at"])
#: Instruments of the test lake: listed with the first bar; every fifth code is delisted 30 days before its last bar.
INSTRUMENTS = """select symbol, 'NAME ' || substr(symbol, 1, 6) as name, split_part(symbol, '.', 2) as exchange, min(trade_date) as list_date,
  case when cast(substr(symbol, 1, 6) as int) % 5 = 0 then max(trade_date) - 30 end as delist_date from daily_bars group by symbol"""
STEPS = f"""select symbol, trade_date, factor from (select symbol, trade_date, factor, lag(factor) over (partition by symbol order by trade_date) as before from ({FACTORS}) where factor is not null and adjust_type = 'hfq')
  where before is null or abs(factor - before) > 0.02 * abs(before)"""
CALENDAR = "select distinct trade_date from daily_bars where volume > 0 or volume is null"


def with_parts(body: str, **parts: str) -> str:
    return "with " + ", ".join(f"{k} as ({v})" for k, v in parts.items()) + " " + body
