"""Integrity and reconciliation checks.  Each returns the rows that violate it (or one row for each group judged)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.functions.columns import any_of, relative_gap_over
from lakeforge.operators.groups import BREADTH

FINDING = "dataset string, severity string, check string, message string, detail map<string,string>"


def findings(rows: DataFrame, dataset: str, severity: str, check: str, message: Column, **detail: Column) -> DataFrame:
    """Rows as findings: dataset, severity, check, message and a map of details."""
    parts = [x for k, v in detail.items() for x in (F.lit(k), v.cast("string"))]
    return rows.select(F.lit(dataset).alias("dataset"), F.lit(severity).alias("severity"), F.lit(check).alias("check"), message.alias("message"), (F.create_map(*parts) if parts else F.expr("cast(map() as map<string,string>)")).alias("detail"))


# --- calendar and coverage


def calendar_orphans(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days with rows that are no sessions."""
    return days.select("trade_date").distinct().join(calendar, "trade_date", "left_anti")


def missing_sessions(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sessions between the first and the last day that have no rows."""
    span = days.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    inside = calendar.select("trade_date").distinct().join(F.broadcast(span), F.col("trade_date").between(F.col("lo"), F.col("hi")))
    return inside.select("trade_date").join(days.select("trade_date").distinct(), "trade_date", "left_anti")


def symbol_session_holes(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per symbol: sessions of its span, and those without a bar.  Counted from calendar positions, never paired."""
    n = calendar.select("trade_date").distinct().select("trade_date", F.row_number().over(W.orderBy("trade_date")).alias("n"))
    at = bars.select("symbol", "trade_date").distinct().join(F.broadcast(n), "trade_date")
    return at.groupBy("symbol").agg((F.max("n") - F.min("n") + 1).cast("bigint").alias("expected"), F.count(F.lit(1)).alias("present")).withColumn("missing", F.col("expected") - F.col("present"))


def last_contiguous(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """The last session before the first hole (one row; null without any day)."""
    span = days.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    marked = calendar.select("trade_date").distinct().join(F.broadcast(span), F.col("trade_date").between(F.col("lo"), F.col("hi"))).join(days.select("trade_date").distinct().withColumn("here", F.lit(True)), "trade_date", "left")
    hole = marked.agg(F.min(F.when(F.col("here").isNull(), F.col("trade_date"))).alias("hole"))
    return marked.join(F.broadcast(hole)).where("hole is null or trade_date < hole").agg(F.max("trade_date").alias("last_date"))


def coverage_by_date(covered: DataFrame, universe: DataFrame) -> DataFrame:
    """Per date, the share of the universe's symbols that are covered."""
    u = universe.select("symbol", "trade_date").distinct()
    c = covered.select("symbol", "trade_date").distinct().withColumn("hit", F.lit(1))
    return u.join(c, ["symbol", "trade_date"], "left").groupBy("trade_date").agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("covered")).withColumn("ratio", F.col("covered") / F.col("n"))


def partial_symbols(bars: DataFrame, calendar: DataFrame, least: float = 0.97) -> DataFrame:
    return symbol_session_holes(bars, calendar).where(F.col("present") < least * F.col("expected"))


def staleness(last: DataFrame, anchor: Column, tolerance: int) -> DataFrame:
    """Adds days_behind and stale to rows with a last_date."""
    return last.withColumn("days_behind", F.datediff(anchor, "last_date")).withColumn("stale", F.col("days_behind") > tolerance)


# --- structure


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_counts(df: DataFrame, required: list[str]) -> DataFrame:
    """column_name, nulls, blanks of the required columns, from one pass."""
    types = dict(df.dtypes)
    counts = df.agg(*(F.struct(F.count_if(F.col(c).isNull()).alias("nulls"), (F.count_if(F.trim(c) == "") if types[c] == "string" else F.lit(0).cast("bigint")).alias("blanks")).alias(c) for c in required))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in required))).alias("x")).select("x.column_name", "x.v.nulls", "x.v.blanks")


def nonfinite(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.where(any_of([F.isnan(c) | (F.abs(F.col(c)) == float("inf")) for c in columns]))


def bar_violations() -> Column:
    """Prices not positive, negative volume or amount, or (in traded bars) prices outside low..high."""
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    live = F.col("volume").isNull() | (F.col("volume") > 0)
    outside = live & ((F.col("high") < F.greatest("open", "close", "low")) | (F.col("low") > F.least("open", "close", "high")))
    return F.coalesce(any_of([F.coalesce(p <= 0, F.lit(False)) for p in prices]) | F.coalesce(F.col("volume") < 0, F.lit(False)) | F.coalesce(F.col("amount") < 0, F.lit(False)) | F.coalesce(outside, F.lit(False)), F.lit(False))


def elapsed_share(period: Column, as_of: Column) -> Column:
    """The share of a period (day, month, quarter or year label) that has passed on a day; 1 for periods that are over or
    have not begun, and for labels that are none."""
    text = period.cast("string")
    month = F.when(text.rlike(r"^\d{4}-\d{2}$"), F.concat(text, F.lit("-01"))).when(text.rlike(r"^\d{4}Q[1-4]$"), F.concat(F.substring(text, 1, 4), F.lit("-"), F.lpad((F.substring(text, 6, 1).cast("int") * 3 - 2).cast("string"), 2, "0"), F.lit("-01")))
    start = month.when(text.rlike(r"^\d{4}$"), F.concat(text, F.lit("-01-01"))).try_cast("date")
    months = F.when(text.rlike("^.{4}-"), 1).when(text.contains("Q"), 3).otherwise(12)
    end = F.add_months(start, months)
    inside = (as_of >= start) & (as_of < end)
    return F.when(F.coalesce(inside, F.lit(False)), (F.datediff(as_of, start) + 1) / F.datediff(end, start)).otherwise(1.0)


def row_mutations(df: DataFrame, period: Column, as_of: Column, ratio: float = 0.5, least: int = 50) -> DataFrame:
    """Periods whose rows or symbols fall under ``ratio`` of the period before, in proportion to the share of the period that
    has passed on ``as_of``."""
    p = df.groupBy(period.alias("period")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("symbols"))
    w = W.orderBy("period")  # one row a period
    p = p.withColumn("prev_n", F.lag("n").over(w)).withColumn("prev_symbols", F.lag("symbols").over(w)).withColumn("elapsed", elapsed_share(F.col("period"), as_of))
    short = lambda now, before: F.col(now) < ratio * F.col(before) * F.col("elapsed")
    found = p.where((F.col("prev_n") >= least) & (short("n", "prev_n") | ((F.col("prev_symbols") >= least) & short("symbols", "prev_symbols"))))
    return found.select("period", "n", "prev_n", "symbols", "prev_symbols", "elapsed")


def fragmentation(parts: DataFrame, rows_under: int = 50, partitions_over: int = 30) -> DataFrame:
    """dataset, partitions and rows a partition of datasets in too many, too small partitions.  parts: dataset, partition, n_rows."""
    d = parts.groupBy("dataset").agg(F.countDistinct("partition").alias("partitions"), F.sum("n_rows").alias("n_rows"))
    return d.where((F.col("partitions") >= partitions_over) & (F.col("n_rows") / F.col("partitions") < rows_under))


def granularity(label: Column | str) -> Column:
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day").when(c.rlike(r"^\d{4}-\d{2}$"), "month").when(c.rlike(r"^\d{4}Q[1-4]$"), "quarter").when(c.rlike(r"^\d{4}$"), "year")


def scalar_stats(df: DataFrame, required: list[str]) -> DataFrame:
    """One row from one scan: rows, rows of mock sources, and nulls of each required column (nulls_<column>)."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("source") == "mock").alias("mock"), *(F.count_if(F.col(c).isNull()).alias("nulls_" + c) for c in required))


def sampled(df: DataFrame, by: str, column: str, n: int = 5) -> DataFrame:
    """by, the number of rows, and the first and last ``n`` distinct values of a column, for a finding's message."""
    one = df.groupBy(by, column).agg(F.count(F.lit(1)).alias("_n"))
    ends = [one.withColumn("_r", F.row_number().over(W.partitionBy(by).orderBy(o))).where(F.col("_r") <= n).select(by, column) for o in (F.col(column).asc(), F.col(column).desc())]
    held = lambda d, name: d.groupBy(by).agg(F.concat_ws(",", F.sort_array(F.collect_list(F.col(column).cast("string")))).alias(name))
    return one.groupBy(by).agg(F.sum("_n").alias("n")).join(held(ends[0], "first"), by).join(held(ends[1], "last"), by)


# --- intraday


def off_session(rows: DataFrame, time: str, windows: tuple[tuple[str, str], ...] = (("09:25:00", "11:30:00"), ("13:00:00", "15:00:00"))) -> DataFrame:
    t = F.date_format(time, "HH:mm:ss")
    return rows.where(~any_of([t.between(a, b) for a, b in windows]))


def sequence_gaps(ticks: DataFrame) -> DataFrame:
    """Sessions whose sequence numbers are not 0..n-1 exactly once."""
    s = ticks.groupBy("symbol", "trade_date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("tick_seq").alias("distinct_seq"), F.min("tick_seq").alias("lo"), F.max("tick_seq").alias("hi"))
    return s.where("lo <> 0 or hi <> n - 1 or distinct_seq <> n")


def truncated_sessions(ticks: DataFrame, opening: str = "09:31:00") -> DataFrame:
    """Per date: sessions, and those whose first tick comes after the opening."""
    s = ticks.groupBy("symbol", "trade_date").agg(F.min("trade_time").alias("first"))
    return s.groupBy("trade_date").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.date_format("first", "HH:mm:ss") > opening).alias("truncated"))


def direction_mix(ticks: DataFrame) -> DataFrame:
    """Per symbol: ticks by direction, the share of unknown ones and of buys among the known."""
    known = F.col("direction").isin("buy", "sell", "neutral", "after_hours")
    g = ticks.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("direction") == "buy").alias("buys"), F.count_if(F.col("direction") == "sell").alias("sells"), F.count_if(~F.coalesce(known, F.lit(False))).alias("unknown")
    )
    return g.withColumn("unknown_share", F.round(F.col("unknown") / F.col("n"), 8)).withColumn("buy_share", F.round(F.try_divide("buys", F.col("buys") + F.col("sells")), 8))


def session_ratio(inner: DataFrame, daily: DataFrame) -> DataFrame:
    """Per (symbol, trade_date): intraday volume over the daily bar's."""
    i = inner.groupBy("symbol", "trade_date").agg(F.coalesce(F.sum("volume"), F.lit(0)).alias("inner_volume"))
    return i.join(daily.where("volume > 0").select("symbol", "trade_date", "volume"), ["symbol", "trade_date"]).withColumn("ratio", F.try_divide("inner_volume", "volume"))


# --- units


def unit_ratios(bars: DataFrame, least: int = 20) -> DataFrame:
    """Per source and version: the median of amount / (volume * close); 1 where volume is in shares, 100 in lots."""
    r = bars.where("volume > 0 and close > 0 and amount > 0").withColumn("ratio", F.try_divide("amount", F.col("volume") * F.col("close")))
    return r.groupBy("source", "data_version").agg(F.count(F.lit(1)).alias("n"), F.median("ratio").alias("ratio")).where(F.col("n") >= least)


def null_share(bars: DataFrame, column: str) -> DataFrame:
    return bars.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls")).withColumn("share", F.round(F.col("nulls") / F.col("n"), 8))


def placeholder_share(bars: DataFrame) -> DataFrame:
    """Per source: share of bars with flat prices and no volume."""
    flat = (F.col("open") == F.col("high")) & (F.col("high") == F.col("low")) & (F.col("low") == F.col("close")) & (F.col("volume") == 0)
    return bars.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(F.coalesce(flat, F.lit(False)).cast("int")), 8).alias("share"))


# --- derived and point in time


def breadth_findings(metrics: DataFrame) -> DataFrame:
    """trade_date and check: unknown, repeated or missing metrics, or counts that contradict each other."""
    known = F.col("metric_id").isin(*BREADTH)
    v = lambda m: F.max(F.when(F.col("metric_id") == m, F.col("value"))).alias(m)
    g = metrics.groupBy("trade_date").agg(F.count_if(~known).alias("unknown"), F.count(F.lit(1)).alias("n"), F.countDistinct("metric_id").alias("d"), F.countDistinct(F.when(known, F.col("metric_id"))).alias("k"), *map(v, BREADTH))
    parts = F.col("advance_count") + F.col("decline_count") + F.col("flat_count")
    inconsistent = (parts != F.col("total_count")) | (F.abs(F.col("advance_ratio") - F.coalesce(F.try_divide("advance_count", "total_count"), F.lit(0.0))) > 1e-9)
    checks = F.array(
        F.when(F.col("unknown") > 0, "market_breadth_unknown"), F.when(F.col("n") > F.col("d"), "market_breadth_duplicate"), F.when(F.col("k") < len(BREADTH), "market_breadth_incomplete"),
        F.when((F.col("k") == len(BREADTH)) & inconsistent, "market_breadth_inconsistent"),
    )
    return g.select("trade_date", F.explode(F.array_compact(checks)).alias("check"))


def bad_announcements(facts: DataFrame, floor: str = "2001-01-01") -> DataFrame:
    return facts.where(F.col("announce_date").isNull() | (F.col("announce_date") < F.lit(floor).cast("date")))


def revised_values(incoming: DataFrame, stored: DataFrame, key: list[str], value: str, tolerance: float = 0.05) -> DataFrame:
    both = incoming.select(*key, F.col(value).alias("new_value")).join(stored.select(*key, F.col(value).alias("old_value")), key)
    return both.where(relative_gap_over(F.col("new_value"), F.col("old_value"), tolerance))


# --- comparison of sources


def key_coverage(primary: DataFrame, backup: DataFrame, key: list[str]) -> DataFrame:
    """One row: distinct keys of each side, of both, of either alone, and the state that follows."""
    p, b = (x.select(*key).distinct().withColumn(n, F.lit(1)) for x, n in ((primary, "p"), (backup, "b")))
    both = p.join(b, key, "full")
    c = both.agg(F.count("p").alias("primary_keys"), F.count("b").alias("backup_keys"), F.count_if(F.col("p").isNotNull() & F.col("b").isNotNull()).alias("overlap"))
    state = (
        F.when((F.col("primary_keys") == 0) & (F.col("backup_keys") == 0), "no_comparable_rows").when(F.col("primary_keys") == 0, "primary_missing").when(F.col("backup_keys") == 0, "backup_missing")
        .when(F.col("overlap") == 0, "no_overlap").when(F.col("overlap") < F.col("primary_keys"), "backup_gap").when(F.col("overlap") < F.col("backup_keys"), "primary_gap").otherwise("equal")
    )
    return c.withColumn("state", state)


def field_drift(primary: DataFrame, backup: DataFrame, key: list[str], fields: list[str], bps: float = 10.0) -> DataFrame:
    """key, field_name, kind: null on one side, or farther apart than ``bps`` of the backup's value."""
    both = primary.select(*key, F.struct(*fields).alias("p")).join(backup.select(*key, F.struct(*fields).alias("b")), key)
    gap = lambda f: F.when(F.col("b")[f] == 0, F.when(F.col("p")[f] != 0, F.lit(float("inf"))).otherwise(0.0)).otherwise(F.try_divide(F.abs(F.col("p")[f] - F.col("b")[f]), F.abs(F.col("b")[f])) * 1e4)
    kind = lambda f: F.when(F.col("p")[f].isNull() != F.col("b")[f].isNull(), "field_null_mismatch").when(gap(f) > bps, "field_drift")
    each = F.array(*(F.struct(F.lit(f).alias("field_name"), kind(f).alias("kind")) for f in fields))
    return both.select(*key, F.explode(each).alias("x")).where("x.kind is not null").select(*key, "x.field_name", "x.kind")


def spread_sample(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The same ``n`` keys each time, spread by hash."""
    return df.orderBy(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in key))), *key).limit(n)


def authority_differences(values: DataFrame, reference: DataFrame, key: list[str], value: str, tolerance: float) -> DataFrame:
    """Keys of a reference (an authority's own figures) that are missing or differ by more than ``tolerance``."""
    both = reference.select(*key, F.col(value).alias("reference")).join(values.select(*key, F.col(value).alias("value"), F.lit(1).alias("_here")), key, "left")
    kind = F.when(F.col("_here").isNull(), "missing").when(relative_gap_over(F.col("value"), F.col("reference"), tolerance), "differs")
    return both.withColumn("kind", kind).where("kind is not null").drop("_here")


# --- retired symbols


def retirement(bars: DataFrame, instruments: DataFrame, gap_days: int = 180) -> DataFrame:
    """symbol, last bar, whether it stopped long before the lake's last bar, and whether a delisting is on record."""
    spans = bars.groupBy("symbol").agg(F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
    end = spans.agg(F.max("last_date").alias("lake_date"))
    r = spans.join(F.broadcast(end)).join(instruments.select("symbol", "delist_date"), "symbol", "left")
    return r.withColumn("retired", F.datediff("lake_date", "last_date") > gap_days).select("symbol", "first_date", "last_date", "retired", F.col("delist_date").isNotNull().alias("marked"))


#: Fixed values of the endings: days of a halt, worst return, return over the window and last price.
HALT_DAYS, WORST, DECLINE, PENNY = 10, -0.25, -0.4, 2.0


def ending_patterns(bars: DataFrame, window: int = 60, least: int = 30) -> DataFrame:
    """How each symbol's prices ended: the greatest gap, worst return and total return over its last bars, and a label."""
    w = W.partitionBy("symbol").orderBy(F.col("trade_date").desc())
    tail = bars.select("symbol", "trade_date", "close").withColumn("rn", F.row_number().over(w)).withColumn("n", F.count(F.lit(1)).over(W.partitionBy("symbol")))
    tail = tail.withColumn("prev", F.lead("close").over(w)).withColumn("before", F.lead("trade_date").over(w)).where(F.col("rn") <= window)
    inner = F.col("rn") < F.least("n", F.lit(window))
    g = tail.groupBy("symbol").agg(
        F.max("trade_date").alias("last_trade_date"), F.max("n").alias("bars"), F.max(F.when(inner, F.datediff("trade_date", "before"))).alias("halt_gap_days"),
        F.min(F.when(inner, F.try_divide("close", "prev") - 1)).alias("worst_final_return"), (F.try_divide(F.min_by("close", "rn"), F.max_by("close", "rn")) - 1).alias("window_return"), F.min_by("close", "rn").alias("final_close"),
    )
    label = (
        F.when(F.col("bars") < least, "insufficient").when((F.col("halt_gap_days") > HALT_DAYS) & (F.col("worst_final_return") < WORST), "consolidation")
        .when((F.col("window_return") < DECLINE) & (F.col("final_close") < PENNY), "abrupt_decline").otherwise("abrupt_stable")
    )
    return g.withColumn("ending_pattern", label)


def fill_ratio(df: DataFrame, by: str, column: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("filled")).withColumn("ratio", F.round(F.col("filled") / F.col("n"), 8))


# --- against references


def close_crosscheck(bars: DataFrame, reference: DataFrame, names: int = 12, tolerance: float = 0.001) -> DataFrame:
    """Per day: of the ``names`` symbols with the greatest amount, how many have a reference close and how many miss it."""
    order = W.partitionBy("trade_date").orderBy(F.col("amount").desc_nulls_last(), F.col("volume").desc_nulls_last(), "symbol")
    # Spark turns row_number <= names into a group limit: only so many rows of a day are shuffled from each task
    top = bars.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= names)
    ref = reference.select("symbol", "trade_date", F.col("close").alias("reference"))
    both = top.join(ref, ["symbol", "trade_date"])
    miss = F.abs(F.col("close") - F.col("reference")) > tolerance * F.abs("reference")
    return both.groupBy("trade_date").agg(F.count(F.lit(1)).alias("compared"), F.count_if(miss).alias("mismatched"))


def label_differences(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that one side labels and the other does not."""
    l, r = left.select(*key).distinct().withColumn("l", F.lit(1)), right.select(*key).distinct().withColumn("r", F.lit(1))
    return l.join(r, key, "full").where("l is null or r is null").select(*key, F.when(F.col("l").isNull(), "right_only").otherwise("left_only").alias("side"))


def delisted_coverage(terminal: DataFrame, bars: DataFrame, instruments: DataFrame, end: Column) -> DataFrame:
    """symbol and state of each terminated symbol (symbol, terminal): whether bars and instruments agree with its end."""
    spans = bars.groupBy("symbol").agg(F.max("trade_date").alias("last"))
    t = terminal.join(spans, "symbol", "left").join(instruments.select("symbol", "delist_date", F.lit(1).alias("known")), "symbol", "left")
    gap = F.datediff("terminal", "last")
    state = (
        F.when(F.col("last").isNull(), F.when(F.col("terminal") <= end, "missing_bars").otherwise("unknown_overlap"))
        .when((F.col("terminal") <= end) & (F.col("last") != F.col("terminal")) & ~F.coalesce((F.col("delist_date") == F.date_add("terminal", 1)) & gap.between(1, 3), F.lit(False)), "terminal_mismatch")
        .when(F.col("known").isNull(), "missing_instrument").when(F.col("delist_date").isNull() | (F.col("delist_date") < F.col("terminal")), "invalid_delist_date").otherwise("verified")
    )
    return t.select("symbol", "terminal", state.alias("state"))


def receipt_coverage(receipts: DataFrame, universe: DataFrame, start: Column, end: Column) -> DataFrame:
    """receipt_id of the completion proofs that cover the window and every symbol of the present universe.

    receipts: receipt_id, start_date, end_date, symbol (one row a symbol)."""
    n = universe.select("symbol").distinct()
    hit = receipts.where((F.col("start_date") <= start) & (F.col("end_date") >= end)).join(n, "symbol").groupBy("receipt_id").agg(F.countDistinct("symbol").alias("hit"))
    return hit.join(F.broadcast(n.agg(F.count(F.lit(1)).alias("need")))).where("hit = need").select("receipt_id")
