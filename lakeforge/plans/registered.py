"""All queries of the core by name.  Results carry dates as text, YYYY-MM-DD, in Spark and SQL alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.functions.columns import iso_date
from lakeforge.plans import derived, history, problems, quality, read_path, storage

MODULES = (problems, read_path, derived, quality, storage, history)

#: Date columns of the results, where a query has others than trade_date or none.
DATE_COLUMNS = {
    "traded_only": ("first_date", "last_date"), "pit_as_of": ("announce_date",), "pit_all_vintages": ("announce_date",), "pit_quarter_range": ("announce_date",), "uncovered_symbols": ("bar_date", "factor_date"),
    "returns_adjacent_sessions": ("trade_date", "prev_trade_date"), "industry_members_asof": ("trade_date", "as_of_date"), "recon_explained": ("trade_date", "step_date"), "delisting_endings": ("last_trade_date",),
    "interval_expand_latest": ("as_of_date", "start_date"), "interval_expand_halfopen": ("as_of_date",), "month_end_sessions": ("month_date", "last_date"), "contiguous_watermark": ("last_date",),
    "interior_gaps": ("first_date",), "shallow_history": ("bar_date", "factor_date"), "last_dense_day": ("last_date",), "macro_stale": ("last_date",), "pit_bad_announcements": ("announce_date",),
    "survivorship_status": ("first_date", "last_date"), "retired_unmarked": ("last_date",), "instruments_merge": ("list_date", "delist_date"), "provenance_buckets": ("bucket_date",), "heatmap_cells": ("month_date",),
    "keyword_sentiment": ("publish_date",), "sentiment_channels": ("publish_date",), "coverage_bounds": ("first_date", "last_date"), "symbols_to_backfill": ("expected_end", "latest_date"), "repaired_instruments": ("list_date", "delist_date"),
    "complete_snapshots": ("as_of_date",), "sessions_final": ("local_date",), "sql_functions": ("last_date",), "calendar_horizon": ("last_date", "table_end"),
}
DATELESS = (
    "adjust_missing_exact_flag", "universe_strict_missing", "symbol_predicate", "pit_items", "pit_revision_size", "retry_refresh_union", "survivorship_returns", "index_coverage", "minute_daily_recon", "tick_direction",
    "volume_unit_median", "amount_completeness", "required_nulls", "nonfinite", "row_mutation_prorated", "fragmentation", "mixed_granularity", "macro_revised", "source_diff_coverage", "partial_symbols", "placeholder_share",
    "fill_ratio", "compact_merge", "repartition_labels", "tradable_on_date", "bar_ownership", "index_constituents_latest", "dates_replaced", "period_rows", "st_by_name", "industry_index_checks", "intraday_daily_bands",
    "history_validity", "scalar_stats", "finding_samples", "return_summary", "stored_stats", "inferred_symbols", "stats_partitions", "provenance_mix", "sector_code_map", "sector_fuzzy_routing", "action_expand", "related_symbols_explode", "ordered_priority_topn", "resolve_symbol",
    "top_liquid", "purge_orphans", "delisted_coverage", "receipt_coverage",
)


def date_columns(name: str) -> tuple[str, ...]:
    return () if name in DATELESS else DATE_COLUMNS.get(name, ("trade_date",))


def with_text_dates(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = f(spark, folder)
        return df.withColumns({c.name: iso_date(F.col(c.name)) for c in df.schema if isinstance(c.dataType, T.DateType)})

    query.__name__, query.__doc__ = f.__name__, f.__doc__
    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in MODULES:
        for name, f in m.queries().items():
            if name in out:
                raise ValueError(f"two queries are named {name}")
            out[name] = with_text_dates(f)
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(problems.oracle_sql())  # these name their dates as text already
    for m in MODULES:
        if m is not problems:
            for name, sql in m.oracle_sql().items():
                dates = date_columns(name)
                out[name] = f"select * replace ({', '.join(f'cast({c} as varchar) as {c}' for c in dates)}) from ({sql})" if dates else sql
    return out
