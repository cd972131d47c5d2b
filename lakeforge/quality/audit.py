"""The audit of a lake: structural, derived and cross-dataset checks as one frame of findings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.lake import Lake
from lakeforge.operators.groups import unions
from lakeforge.operators.readpath import canonical, traded
from lakeforge.quality import checks as Q
from lakeforge.registry import DATASETS, dataset

SEVERITY = {"error": 0, "warning": 1, "info": 2}


def structural(lake: Lake, name: str) -> DataFrame:
    """Row count, repeated keys, required nulls, values not finite, bar rules and placeholder dates of one dataset."""
    spec = dataset(name)
    rows = lake.scan(name, must_exist=False)
    text = lambda *parts: F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts))
    empty = rows.agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    out = [Q.findings(empty, name, "error" if spec.required else "info", "non_empty", F.lit("no rows"))]
    twice = Q.duplicate_keys(rows, list(spec.key)).agg(F.count(F.lit(1)).alias("keys")).where("keys > 0")
    out.append(Q.findings(twice, name, "warning", "pk_unique", text(F.col("keys").cast("string"), " keys have several rows"), keys=F.col("keys")))
    nulls = Q.null_counts(rows, list(spec.required_columns)).where("nulls > 0 or blanks > 0")
    out.append(Q.findings(nulls, name, "error", "required_non_null", text("column ", F.col("column_name")), nulls=F.col("nulls"), blanks=F.col("blanks")))
    doubles = [f.name for f in spec.schema if f.dataType.typeName() == "double"]
    if doubles:
        odd = Q.nonfinite(rows, doubles).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out.append(Q.findings(odd, name, "error", "non_finite", text(F.col("n").cast("string"), " rows")))
    if spec.is_bars:
        bad = rows.where(Q.bar_violations()).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out.append(Q.findings(bad, name, "error", "bar_rules", text(F.col("n").cast("string"), " rows")))
    if spec.pit:
        late = Q.bad_announcements(rows).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        out.append(Q.findings(late, name, "warning", "pit_invalid_announce_date", text(F.col("n").cast("string"), " rows")))
    return unions(out)


def cross(lake: Lake) -> DataFrame:
    """Bars against the calendar, and factors against bars."""
    bars = canonical(lake.scan("daily_bars", must_exist=False), ["symbol", "trade_date"])
    calendar = lake.scan("trading_calendar", must_exist=False).where("is_trading").select("trade_date").distinct()
    orphan = Q.calendar_orphans(bars, calendar).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    hole = Q.missing_sessions(traded(bars), calendar).agg(F.count(F.lit(1)).alias("n"), F.min("trade_date").alias("first")).where("n > 0")
    symbols = bars.select("symbol").distinct().withColumn("exchange", F.split_part("symbol", F.lit("."), F.lit(2)))
    have = lake.scan("adj_factors", must_exist=False).select("symbol").distinct().withColumn("hit", F.lit(1))
    share = symbols.join(have, "symbol", "left").groupBy("exchange").agg((F.count("hit") / F.count(F.lit(1))).alias("share")).where("share < 0.98")
    return unions([
        Q.findings(orphan, "daily_bars", "error", "daily_bars_calendar_orphan", F.concat(F.col("n").cast("string"), F.lit(" days are no sessions"))),
        Q.findings(hole, "daily_bars", "error", "daily_bars_calendar_missing_day", F.concat(F.col("n").cast("string"), F.lit(" sessions have no bars")), first=F.col("first")),
        Q.findings(share, "adj_factors", "warning", "adj_factor_coverage", F.concat(F.lit("exchange "), F.col("exchange")), share=F.col("share")),
    ])


def audit(lake: Lake, names: list[str] | None = None) -> DataFrame:
    parts = [structural(lake, n) for n in names or DATASETS]
    if names is None or "daily_bars" in names:
        parts.append(cross(lake))
    rank = F.when(F.col("severity") == "error", 0).when(F.col("severity") == "warning", 1).otherwise(2)
    return unions(parts).orderBy(rank, "dataset", "check")


def verify(lake: Lake, name: str, calendar: DataFrame, today: date, mark: date | None = None) -> list[dict]:
    """Gaps of one dataset: empty, stale, interior (dense datasets) or shallow."""
    spec = dataset(name)
    rows = lake.scan(name, must_exist=False)
    if not spec.date_col or dict(rows.dtypes)[spec.date_col] != "date":
        return []
    days = rows.select(F.col(spec.date_col).alias("trade_date"))
    span = days.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi")).first()
    if span.hi is None:
        return [{"dataset": name, "kind": "empty"}] if spec.required else []
    gaps: list[dict] = []
    if spec.is_stale(mark or span.hi, today):
        gaps.append({"dataset": name, "kind": "stale", "since": mark or span.hi})
    if spec.dense and (hole := Q.missing_sessions(days, calendar).agg(F.count(F.lit(1)).alias("n"), F.min("trade_date").alias("first")).first()).n:
        gaps.append({"dataset": name, "kind": "interior", "sessions": hole.n, "first": hole.first})
    floor = spec.earliest_available(today)
    if floor and span.lo > floor:
        gaps.append({"dataset": name, "kind": "shallow", "from": span.lo, "could": floor})
    return gaps
