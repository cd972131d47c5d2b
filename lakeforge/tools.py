"""Read tools with paging: what an assistant or a web page asks of a lake."""

from __future__ import annotations

from collections import Counter
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge import swaps
from lakeforge.lake import Lake
from lakeforge.operators.storage import resolved
from lakeforge.partitions import parse
from lakeforge.registry import DATASETS, PROVENANCE, dataset

DEFAULT_ROWS, MOST_ROWS = 200, 2000


def payload(rows: DataFrame, limit: int = DEFAULT_ROWS, offset: int = 0) -> dict[str, Any]:
    """One page by column, the total, whether it was cut, and the sources it came from.  ``rows`` should be ordered."""
    limit = max(1, min(limit, MOST_ROWS))
    keep = [c for c in rows.columns if c not in PROVENANCE]
    about = rows.agg(F.count(F.lit(1)).alias("n"), *([F.sort_array(F.collect_set("source")).alias("sources")] if "source" in rows.columns else [])).first()
    page = list(rows.select(*keep).offset(offset).limit(limit).toLocalIterator())
    text = lambda v: v if v is None or isinstance(v, (bool, int, float, str)) else str(v)
    return {
        "columns": {c: [text(r[c]) for r in page] for c in keep}, "rows": len(page), "total": about.n, "truncated": offset + len(page) < about.n, "sources": list(about.sources) if "source" in rows.columns else [],
    }


def describe_lake(lake: Lake) -> list[dict]:
    return lake.catalogue()


def describe_dataset(name: str) -> dict[str, Any]:
    spec = dataset(name)
    return {"name": name, "key": list(spec.key), "columns": [(f.name, f.dataType.simpleString()) for f in spec.schema], "partition": spec.partition_col, "granularity": spec.granularity, "pit": spec.pit, "history_mode": spec.history_mode}


def resolve_symbol(lake: Lake, text: str, limit: int = 20) -> dict[str, Any]:
    return payload(resolved(lake.load("instruments"), text, min(limit, MOST_ROWS)), limit)


def query_bars(lake: Lake, symbols: list[str], start: str | None = None, end: str | None = None, adjust: str | None = None, limit: int = DEFAULT_ROWS, offset: int = 0) -> dict[str, Any]:
    return payload(lake.load("daily_bars", symbols=symbols, start=start, end=end, adjust=adjust, ordered=True), limit, offset)


def query_fundamentals(lake: Lake, as_of: str, symbols: list[str] | None = None, items: list[str] | None = None, all_vintages: bool = False, limit: int = DEFAULT_ROWS, offset: int = 0) -> dict[str, Any]:
    return payload(lake.load("financial_statement_items", as_of=as_of, symbols=symbols, items=items, all_vintages=all_vintages, ordered=True), limit, offset)


def query_dataset(lake: Lake, name: str, limit: int = DEFAULT_ROWS, offset: int = 0, **how: Any) -> dict[str, Any]:
    if name not in DATASETS:
        raise KeyError(name)
    return payload(lake.load(name, ordered=True, **how), limit, offset)


def run_sql(lake: Lake, text: str, limit: int = DEFAULT_ROWS, offset: int = 0) -> dict[str, Any]:
    return payload(lake.sql(text), limit, offset)


def gap_meaning(name: str) -> str:
    """Whether a day without rows is a fault, or the shape of a dataset that is not daily or only takes snapshots."""
    spec = dataset(name)
    daily = int(spec.options.get("max_staleness_days", "0")) <= 1
    return "fault" if daily and "snapshot" not in spec.flags and spec.history_mode != "snapshot_only" else "cadence"


def health(lake: Lake, anchor: date, marks: dict[str, date] = {}) -> dict[str, Any]:
    """How many datasets are fresh, stale, empty, or have no measure, and which."""
    of: dict[str, str] = {}
    for row in lake.catalogue():
        spec = dataset(row["dataset"])
        last = marks.get(spec.name) or row["last"]
        stale = spec.is_stale(last, anchor) if isinstance(last, date) else None
        of[spec.name] = "empty" if row["last"] is None and not swaps.entries(lake.spark, lake.path(spec)) else "n/a" if stale is None else "stale" if stale else "fresh"
    return {
        "anchor": anchor, "datasets": len(of), "counts": dict(Counter(of.values())), "stale": sorted(n for n, s in of.items() if s == "stale"),
        "empty_required": sorted(n for n, s in of.items() if s == "empty" and dataset(n).required), "empty_optional": sorted(n for n, s in of.items() if s == "empty" and not dataset(n).required),
    }


def stale_datasets(lake: Lake, anchor: date, marks: dict[str, date]) -> list[str]:
    """Datasets with data and a mark that lag behind; derived ones are computed, not fetched."""
    return [n for n in health(lake, anchor, marks)["stale"] if n in marks and dataset(n).layer != "derived"]


def date_options(lake: Lake, name: str, limit: int = 400) -> dict[str, Any]:
    """The values a control for dates may offer (only periods that exist, the latest first), and its kind."""
    spec = dataset(name)
    if spec.partition_col is None:
        return {"kind": "none", "column": spec.date_col, "values": [], "total": 0}
    every = swaps.entries(lake.spark, lake.path(spec))
    values = sorted({e.name.split("=", 1)[1] for e in every if e.is_dir and "=" in e.name and parse(e.name.split("=", 1)[1])}, reverse=True)
    kind = "report_period" if spec.partition_col == "report_period" else "period" if spec.granularity != "day" else "trading_day" if spec.partition_col == "trade_date" else "event_day"
    return {"kind": kind, "column": spec.date_col, "values": values[:limit], "total": len(values)}


def period_rows(lake: Lake, name: str, period: str, limit: int = DEFAULT_ROWS, offset: int = 0, **how: Any) -> dict[str, Any]:
    """One page of a period's rows with their provenance."""
    spec = dataset(name)
    p = parse(period)
    if p is None:
        raise ValueError(f"{period} is no period")
    text = spec.partition_col == "report_period"
    rows = lake.load(name, ordered=True, **({} if text else {"start": p.start.isoformat(), "end": p.end.isoformat()}), **how)
    return payload(rows.where(F.col("report_period") == period) if text else rows, limit, offset)
