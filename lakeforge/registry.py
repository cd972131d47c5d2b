"""The registered datasets: fixed schemas, keys, partitions and how their history behaves."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import types as T

#: Name | tier | layer | partition column and granularity | history mode | flags | primary key | columns.
CATALOG = """
instruments | L0 | curated |  | by_date | no_watermark | symbol | symbol string, name string, exchange string, asset_type string, list_date date, delist_date date, prev_symbol string
trading_calendar | L0 | curated | trade_date year | by_date | | trade_date | trade_date date, is_trading boolean
trading_status | L0 | curated | trade_date month | snapshot_with_backfill | | symbol, trade_date | symbol string, trade_date date, is_trading boolean, status string
daily_bars | L1 | curated | trade_date day | by_date | dense | symbol, trade_date | symbol string, trade_date date, open double, high double, low double, close double, volume bigint, amount double
index_bars | L1 | curated | trade_date year | by_date | dense | symbol, trade_date, frequency | symbol string, trade_date date, open double, high double, low double, close double, volume bigint, amount double, frequency string
minute_bars | L1 | curated | trade_date day | by_date | dense optional history_horizon_days=95 row_grain=1m | symbol, trade_date, bar_time, frequency | symbol string, trade_date date, bar_time timestamp_ntz, frequency string, open double, high double, low double, close double, volume bigint, amount double
minute_bars_5m | L1 | curated | trade_date day | by_date | dense optional history_horizon_days=491 row_grain=5m | symbol, trade_date, bar_time, frequency | symbol string, trade_date date, bar_time timestamp_ntz, frequency string, open double, high double, low double, close double, volume bigint, amount double
trade_ticks | L1 | curated | trade_date day | by_date | dense optional history_floor_date=2024-01-02 row_grain=tick | symbol, trade_date, tick_seq | symbol string, trade_date date, tick_seq int, trade_time timestamp_ntz, price double, volume bigint, direction string
commodity_bars | L1 | curated | trade_date year | by_date | optional max_staleness_days=2 | symbol, trade_date | symbol string, name string, exchange string, trade_date date, open double, high double, low double, close double, volume bigint, amount double, open_interest double
corporate_actions | L2 | curated | ex_date year | by_date | | symbol, ex_date, action_type | symbol string, ex_date date, action_type string, cash_dividend double, bonus_ratio double, transfer_ratio double, allotment_ratio double, allotment_price double
announcement_index | L2 | curated | announce_date day | by_date | pit | announcement_id | announcement_id string, symbol string, title string, announce_date date, category string, url string
earnings_disclosure_schedule | L2 | curated | report_period quarter | by_date | no_watermark | symbol, report_period | symbol string, report_period string, scheduled_date date, first_scheduled_date date, actual_date date
financial_statement_items | L3 | curated | report_period quarter | by_date | pit no_watermark | symbol, report_period, statement_type, item_code, announce_date | symbol string, report_period string, statement_type string, item_code string, item_value double, announce_date date
share_structure | L3 | curated | change_date year | by_date | pit no_watermark history_floor_date=1990-01-01 date_col=change_date | symbol, change_date, announce_date | symbol string, change_date date, total_shares double, float_shares double, restricted_shares double, free_float_shares double, change_reason string, announce_date date
shareholder_counts | L3 | curated | count_date year | by_date | pit no_watermark history_floor_date=1992-01-01 date_col=count_date | symbol, count_date, announce_date | symbol string, count_date date, holder_count double, holder_count_change_pct double, avg_float_shares double, avg_holding_value double, announce_date date
top_holders | L3 | curated | record_date year | by_date | pit no_watermark history_floor_date=2003-01-01 date_col=record_date | symbol, record_date, holder_scope, holder_rank, holder_name, announce_date | symbol string, record_date date, holder_scope string, holder_rank int, holder_name string, holding_shares double, holding_pct double, is_institution boolean, holder_type string, announce_date date
valuation_metrics | L3 | curated | trade_date day | snapshot_with_backfill | | symbol, trade_date | symbol string, trade_date date, pe_ttm double, pb double, ps_ttm double, total_mv double, float_mv double
analyst_consensus | L3 | curated | forecast_date day | snapshot_only | | symbol, forecast_date | symbol string, forecast_date date, forecast_year bigint, eps_forecast double, pe_forecast double, target_price double, rating string, analyst_count bigint
fund_flow | L4 | curated | trade_date day | snapshot_only | | symbol, trade_date | symbol string, trade_date date, main_net_inflow double, super_large_net_inflow double, large_net_inflow double, medium_net_inflow double, small_net_inflow double
margin_trading | L4 | curated | trade_date day | by_date | max_staleness_days=2 | symbol, trade_date | symbol string, trade_date date, margin_balance double, margin_buy double, short_balance double, short_sell_volume double
northbound_holdings | L4 | curated | trade_date day | by_date | max_staleness_days=100 | symbol, trade_date, channel | symbol string, trade_date date, channel string, holding_shares double, holding_mv double, holding_ratio double
northbound_flows | L4 | curated | trade_date year | by_date | max_staleness_days=2 history_floor_date=2014-11-17 source_retired_date=2024-08-16 | trade_date, channel | trade_date date, channel string, net_buy double, buy_amount double, sell_amount double
dragon_tiger | L4 | curated | trade_date month | by_date | | symbol, trade_date, reason | symbol string, trade_date date, reason string, buy_amount double, sell_amount double, net_amount double
block_trades | L4 | curated | trade_date month | by_date | | symbol, trade_date, price, volume | symbol string, trade_date date, price double, volume double, amount double, premium_ratio double
institutional_holdings | L4 | curated | report_period quarter | by_date | no_watermark | symbol, holder_type, report_period | symbol string, holder_type string, report_period string, holding_shares double, holding_ratio double, holding_mv double
sector_members | L5 | curated | as_of_date day | snapshot_only | | symbol, sector_code, as_of_date | symbol string, sector_code string, sector_name string, as_of_date date
index_constituents | L5 | curated | as_of_date month | snapshot_with_backfill | | index_symbol, symbol, as_of_date | index_symbol string, symbol string, as_of_date date, weight double
industry_members | L5 | curated | as_of_date day | snapshot_with_backfill | | symbol, classification_system, as_of_date | symbol string, classification_system string, industry_code string, industry_name string, as_of_date date
macro_indicators | L6 | curated | obs_date year | by_date | | indicator_id, obs_date | indicator_id string, obs_date date, value double, frequency string
market_breadth | L6 | curated | trade_date year | by_date | dense | trade_date, metric_id | trade_date date, metric_id string, value double
sentiment_scores | L7 | curated | trade_date month | by_date | | symbol, trade_date, score_channel | symbol string, trade_date date, score_channel string, sentiment_score double, headline_count bigint
hot_rank | L7 | curated | trade_date month | snapshot_only | | symbol, trade_date | symbol string, trade_date date, rank bigint, rank_change bigint, hist_rank bigint
sector_bars | L7 | curated | trade_date month | snapshot_with_backfill | | sector_code, trade_date | sector_code string, sector_name string, board_type string, trade_date date, open double, high double, low double, close double, volume bigint, amount double, change_pct double
sector_fund_flow | L7 | curated | trade_date month | snapshot_only | | sector_code, trade_date | sector_code string, sector_name string, board_type string, trade_date date, main_net_inflow double, change_pct double, turnover_pct double
news_headlines | L7 | curated | publish_date month | snapshot_only | | news_id | news_id string, publish_date date, publish_time string, title string, summary string, related_symbols string, channel string
flash_news_wire | L7 | curated | publish_date month | snapshot_only | | wire_id, wire_source | wire_id string, wire_source string, item_hash string, publish_date date, publish_time string, title string, summary string, related_symbols string, importance tinyint, channel string
economic_calendar | L7 | curated | event_date year | snapshot_only | no_watermark optional | event_id | event_id string, event_date date, event_time string, country string, indicator string, importance tinyint, forecast double, previous double, actual double, unit string
share_unlock_schedule | L8 | curated | unlock_date year | snapshot_with_backfill | no_watermark | symbol, unlock_date | symbol string, unlock_date date, unlock_shares double, unlock_ratio double, unlock_type string
regulatory_events | L8 | curated | event_date year | by_date | | event_id | event_id string, symbol string, event_date date, event_type string, title string
adj_factors | L1 | derived | trade_date day | by_date | dense | symbol, trade_date, adjust_type | symbol string, trade_date date, adjust_type string, factor double
industry_index | L5 | derived | trade_date year | by_date | dense | trade_date, industry_code, level, weighting | trade_date date, industry_code string, level string, weighting string, ret double, n_members bigint, n_priced bigint, n_excluded bigint, amount double
delisting_events | L1 | derived |  | by_date | no_watermark date_col=last_trade_date | symbol | symbol string, first_trade_date date, last_trade_date date, ending_pattern string, final_close double, halt_gap_days bigint, worst_final_return double, final_window_return double, bars bigint
"""
PROVENANCE = ("source", "data_version", "fetched_at")
TYPES = {
    "string": T.StringType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
    "bigint": T.LongType(), "int": T.IntegerType(), "tinyint": T.ByteType(), "boolean": T.BooleanType(),
}
_PROVENANCE_DDL = "source string, data_version string, fetched_at timestamp"
#: Columns beside key and provenance that may not be null.
CORE_COLUMNS = {"bars": ("open", "high", "low", "close", "volume")}


@dataclass(frozen=True)
class Dataset:
    name: str
    tier: str
    layer: str
    partition_col: str | None
    granularity: str | None
    history_mode: str
    flags: frozenset[str]
    options: dict[str, str] = field(hash=False)
    key: tuple[str, ...] = ()
    ddl: str = ""

    @cached_property
    def schema(self) -> T.StructType:
        pairs = (c.split() for c in f"{self.ddl}, {_PROVENANCE_DDL}".split(","))
        return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])

    @property
    def pit(self) -> bool:
        return "pit" in self.flags

    @property
    def dense(self) -> bool:
        return "dense" in self.flags

    @property
    def required(self) -> bool:
        return "optional" not in self.flags

    @property
    def date_col(self) -> str | None:
        if self.name == "delisting_events":
            return "last_trade_date"
        return self.options.get("date_col") or self.partition_col

    @property
    def is_bars(self) -> bool:
        return {"open", "high", "low", "close", "volume"} <= set(self.schema.names)

    @property
    def required_columns(self) -> tuple[str, ...]:
        core = CORE_COLUMNS["bars"] if self.is_bars else ()
        return tuple(dict.fromkeys([*self.key, *PROVENANCE, *core]))

    def earliest_available(self, today: date) -> date | None:
        """The floor wins over the horizon, which counts sessions (242 a year)."""
        if floor := self.options.get("history_floor_date"):
            return date.fromisoformat(floor)
        if days := self.options.get("history_horizon_days"):
            return today - timedelta(days=int(days) * 365 // 242)
        return None

    def is_stale(self, mark: date | None, anchor: date) -> bool | None:
        """None where there is no mark; a retired feed that reached its last day is never stale."""
        if mark is None:
            return None
        if retired := self.options.get("source_retired_date"):
            if mark >= date.fromisoformat(retired):
                return False
            anchor = min(anchor, date.fromisoformat(retired))
        return (anchor - mark).days > int(self.options.get("max_staleness_days", "0"))


def _parse(line: str) -> Dataset:
    name, tier, layer, part, mode, flags, key, ddl = (x.strip() for x in line.split("|"))
    col, _, gran = part.partition(" ")
    words = flags.split()
    options = dict(w.split("=", 1) for w in words if "=" in w)
    return Dataset(name, tier, layer, col or None, gran or None, mode, frozenset(w for w in words if "=" not in w), options, tuple(k.strip() for k in key.split(",")), ddl)


DATASETS: dict[str, Dataset] = {d.name: d for d in map(_parse, CATALOG.strip().splitlines())}


def dataset(name: str) -> Dataset:
    try:
        return DATASETS[name]
    except KeyError:
        raise KeyError(f"no dataset is named {name}; there are {', '.join(sorted(DATASETS))}") from None
