"""The lake: scans, canonical reads with their semantics, writers, views and the catalogue."""

from __future__ import annotations

import re
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators import readpath as R
from lakeforge import swaps
from lakeforge.locks import writing
from lakeforge.registry import DATASETS, Dataset, dataset
from lakeforge.sources import files
from lakeforge.sources.validate import cast_to, checked, validated

#: Directories written by this engine; a name of its own, so that no date column is shadowed on read.
PERIOD = "p_period"
#: Derived datasets whose last days may still be incomplete: their coverage ends at the last session without a hole.
CLAMPED = ("market_breadth", "industry_index")
ADJUSTABLE = ("daily_bars", "trade_ticks", "minute_bars", "minute_bars_5m")


def _day(d: str | date | None) -> date | None:
    return date.fromisoformat(d) if isinstance(d, str) else d


def lock_path(root: str) -> str:
    return f"{root.rstrip('/')}/meta/write.lock"


class Lake:
    """Datasets under ``<root>/<layer>/<dataset>``, in files of any period directories or none."""

    def __init__(self, spark: SparkSession, root: str, prefixes: dict[str, tuple[str, ...]] = R.STOCK_PREFIXES):
        self.spark, self.root, self.prefixes = spark, root.rstrip("/"), prefixes

    def path(self, spec: Dataset) -> str:
        return f"{self.root}/{spec.layer}/{spec.name}"

    # --- reading

    def scan(self, name: str, start: str | None = None, end: str | None = None, symbols: list[str] | None = None, must_exist: bool = True) -> DataFrame:
        """Raw rows: directories pruned by period, then the exact filters (pushed to the files).  Files may differ in
        their columns and in their types.  No dedupe, no validation.  A window outside the data gives an empty frame of the
        schema."""
        spec = dataset(name)
        every = swaps.entries(self.spark, self.path(spec))
        if not every and must_exist:
            raise FileNotFoundError(f"{name} has no files under {self.path(spec)}")
        s, e = _day(start), _day(end)
        column = _period_column(spec, every)
        paths = [path for p, path in files.partitions(every, column) if p.overlaps(s, e)] + files.loose_files(every) if column else [x.path for x in every]
        rows = self.read(paths, spec)
        if spec.date_col and (start or end):
            rows = R.date_range(rows, spec.date_col, start, end)
        return R.symbols_in(rows, symbols)

    def scan_files(self, name: str, paths: list[str], traded_only: bool = False) -> DataFrame:
        """Raw rows of the named files; traded_only: without the rows of bars that have no volume."""
        rows = self.read(paths, dataset(name))
        return R.traded(rows) if traded_only and "volume" in rows.columns else rows

    def read(self, paths: list[str], spec: Dataset) -> DataFrame:
        """The dataset's columns from files of any of its schemas; what does not cast is null."""
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        fit = lambda raw: cast_to(raw, spec, allow_missing=True) if set(spec.schema.names) - set(raw.columns) <= set(spec.schema.names) - set(spec.key) else raw
        load = self.spark.read.option("recursiveFileLookup", True)
        try:
            return fit(load.option("mergeSchema", True).parquet(*paths))
        except Exception as e:
            if "MERGE_SCHEMA" not in str(e) and "incompatible" not in str(e):
                raise
        # types conflict: files of one schema are read together and cast before they meet
        groups: dict[str, list[str]] = {}
        for path in (f for p in paths for f in files.leaf_files(self.spark, p)):
            groups.setdefault(self.spark.read.parquet(path).schema.json(), []).append(path)
        return reduce(DataFrame.unionByName, (fit(self.spark.read.parquet(*g)) for g in groups.values()))

    def load(
        self, name: str, *, start: str | None = None, end: str | None = None, adjust: str | None = None, universe: str | None = None, as_of: str | None = None, items: list[str] | None = None,
        symbols: list[str] | None = None, strict_adj: bool = False, strict_universe: bool = False, all_vintages: bool = False, ordered: bool = False,
    ) -> DataFrame:
        """Canonical rows with the dataset's semantics, as one lazy plan; ``ordered`` sorts at the boundary."""
        spec = dataset(name)
        if name == "index_bars" and (adjust or universe):
            raise R.ReaderError("index_bars take neither adjust nor universe")
        if spec.pit:
            if as_of is None:
                raise R.ReaderError(f"{name} is point in time: as_of is needed")
            rows = R.canonical(R.symbols_in(self.scan(name), symbols), list(spec.key))
            rows = R.as_known(rows, list(spec.key), as_of, items, all_vintages, start, end, spec.date_col)
            return rows.orderBy(*(c for c in ("announce_date", "symbol", "report_period", "item_code") if c in rows.columns)) if ordered else rows
        rows = self.scan(name, start, end, symbols)
        if universe and name == "daily_bars":
            if universe != "all_a":
                raise R.ReaderError(f"no universe is named {universe}")
            rows = self._in_universe(rows, strict_universe)
        # rows out of scope are gone by now, so they cannot make a read fail
        rows = R.canonical(checked(rows, spec), list(spec.key))
        if adjust and name in ADJUSTABLE:
            rows = R.adjusted(rows, R.canonical(self.scan("adj_factors", start, end, symbols), list(dataset("adj_factors").key)), adjust, strict=strict_adj)
        if not ordered:
            return rows
        order = ("symbol", "trade_date", "tick_seq") if name == "trade_ticks" else ("symbol", "bar_time") if "bar_time" in rows.columns else (spec.date_col, "symbol")
        return rows.orderBy(*(c for c in order if c in rows.columns))

    def _optional(self, name: str) -> DataFrame | None:
        try:
            return R.canonical(self.scan(name), list(dataset(name).key))
        except FileNotFoundError:
            return None

    def _in_universe(self, rows: DataFrame, strict: bool) -> DataFrame:
        instruments = self._optional("instruments")
        if instruments is None:
            if strict:
                raise R.UniverseCoverageError("a strict universe needs instruments")
            return rows
        return R.in_universe(rows, instruments, self._optional("trading_status"), strict, self.prefixes)

    def tradable_on(self, day: str, strict: bool = False) -> DataFrame | None:
        """Symbols that may be traded on a day; None where there are no instruments."""
        instruments = self._optional("instruments")
        if instruments is None:
            return None
        valid = instruments.where(R.in_stock_universe("symbol", self.prefixes)).where(R.listed_on(F.lit(day).cast("date"))).select("symbol")
        status = self._optional("trading_status")
        if status is None:
            return valid
        today = status.where(F.col("trade_date") == F.lit(day).cast("date"))
        if strict and (gap := valid.join(today.select("symbol"), "symbol", "left_anti").first()):
            raise R.UniverseCoverageError(f"no status for {gap.symbol} on {day}")
        return valid.join(today.where(R.bad_status()).select("symbol"), "symbol", "left_anti")

    # --- writing

    def stage(self, name: str, run: str, batch: str, rows: DataFrame) -> str:
        """A validated batch of a run; the same batch written again replaces itself."""
        spec = dataset(name)
        path = f"{self.root}/staging/{name}/run_id={run}/batch={batch}"
        validated(rows, spec).write.mode("overwrite").parquet(path)
        return path

    def staged(self, name: str, run: str) -> DataFrame | None:
        path = f"{self.root}/staging/{name}/run_id={run}"
        if not files.entries(self.spark, path):
            return None
        return cast_to(self.spark.read.option("recursiveFileLookup", True).parquet(path), dataset(name))

    def compact(self, name: str, run: str) -> int:
        """Merges a run's staged rows into the lake; returns the number of rewritten partitions."""
        incoming = self.staged(name, run)
        return 0 if incoming is None else self.merge(name, incoming)

    def clear_staging(self, keep: set[str]) -> int:
        """Deletes the staged batches of all runs but those of ``keep``."""
        n = 0
        for name in files.entries(self.spark, f"{self.root}/staging"):
            for run in files.entries(self.spark, name.path):
                if run.is_dir and run.name.removeprefix("run_id=") not in keep:
                    files.delete(self.spark, run.path)
                    n += 1
        return n

    def merge(self, name: str, incoming: DataFrame) -> int:
        """Upserts by primary key, the latest fetch winning; returns the number of rewritten partitions.

        Only the touched periods are read and replaced.  One writer at a time; a crash at any point loses nothing and the
        same merge may be repeated (``swaps``)."""
        spec = dataset(name)
        with writing(self.spark, lock_path(self.root)):
            swaps.recover(self.spark, self.path(spec))
            return self._merge(spec, incoming)

    def _merge(self, spec: Dataset, incoming: DataFrame) -> int:
        root = self.path(spec)
        staged = swaps.new_staging(root)
        every = swaps.entries(self.spark, root)
        if spec.partition_col is None:
            old = self.read([e.path for e in every], spec)
            R.canonical(old.unionByName(incoming), list(spec.key)).write.parquet(f"{staged}/data")
            swaps.swap(self.spark, root, staged, ["data"], [e.name for e in every])
            return 1
        incoming = incoming.withColumn(PERIOD, period_label(spec.partition_col, spec.granularity))
        touched = [r[0] for r in incoming.select(PERIOD).distinct().orderBy(PERIOD).toLocalIterator()]  # labels, bounded by the calendar
        have = {e.name: e.path for e in every}
        names = {t: f"{PERIOD}={'__HIVE_DEFAULT_PARTITION__' if t is None else t}" for t in touched}
        if old := [have[n] for n in names.values() if n in have]:
            incoming = self.read(old, spec).withColumn(PERIOD, period_label(spec.partition_col, spec.granularity)).unionByName(incoming)
        self._write_periods(R.canonical(incoming, list(spec.key)), spec, staged)
        if touched:
            swaps.swap(self.spark, root, staged, list(names.values()))
        return len(touched)

    def _write_periods(self, rows: DataFrame, spec: Dataset, path: str) -> None:
        # rows of a period are spread over tasks by the head of the key, so a large period is no single task
        sort = [c for c in ("symbol", spec.date_col) if c in rows.columns]
        rows.repartition(PERIOD, *sort[:1]).sortWithinPartitions(PERIOD, *sort).write.partitionBy(PERIOD).parquet(path)

    def replace_days(self, name: str, incoming: DataFrame) -> int:
        """Days of the incoming rows are replaced whole (what a day held before is gone); other days stay."""
        spec = dataset(name)
        with writing(self.spark, lock_path(self.root)):
            swaps.recover(self.spark, self.path(spec))
            root = self.path(spec)
            incoming = incoming.withColumn(PERIOD, period_label(spec.partition_col, spec.granularity))
            touched = [r[0] for r in incoming.select(PERIOD).distinct().orderBy(PERIOD).toLocalIterator()]
            have = {e.name: e.path for e in swaps.entries(self.spark, root)}
            if old := [have[n] for t in touched if (n := f"{PERIOD}={t}") in have]:
                kept = self.read(old, spec).withColumn(PERIOD, period_label(spec.partition_col, spec.granularity))
                incoming = kept.join(incoming.select(spec.date_col).distinct(), spec.date_col, "left_anti").select(*incoming.columns).unionByName(incoming)
            staged = swaps.new_staging(root)
            self._write_periods(R.canonical(incoming, list(spec.key)), spec, staged)
            if touched:
                swaps.swap(self.spark, root, staged, [f"{PERIOD}={t}" for t in touched])
            return len(touched)

    def repartition(self, name: str, dry_run: bool = False) -> dict[str, int]:
        """Rewrites a dataset to its configured periods: each key once, counts checked before the swap."""
        spec = dataset(name)
        with writing(self.spark, lock_path(self.root)):
            root = self.path(spec)
            if not dry_run:
                swaps.recover(self.spark, root)
            before = swaps.entries(self.spark, root)
            rows = R.canonical(self.scan(name), list(spec.key)).withColumn(PERIOD, period_label(spec.partition_col, spec.granularity))
            about = rows.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(PERIOD).alias("p")).first()
            report = {"partitions_before": sum(e.is_dir for e in before), "rows": about.n, "partitions_after": about.p}
            if dry_run:
                return report
            staged = swaps.new_staging(root)
            self._write_periods(rows, spec, staged)
            written = self.spark.read.option("recursiveFileLookup", True).parquet(*(e.path for e in files.entries(self.spark, staged) if e.is_dir)).count() if about.n else 0
            if written != about.n:
                raise RuntimeError(f"{name}: the rewritten rows do not add up; nothing was replaced")
            new = [e.name for e in files.entries(self.spark, staged) if e.is_dir]
            swaps.swap(self.spark, root, staged, new, [e.name for e in before])
            return report

    # --- SQL and the catalogue

    def views(self) -> list[str]:
        """A temp view of canonical rows for every dataset (typed and empty without files), and three of adjusted bars."""
        made = []
        for spec in DATASETS.values():
            rows = self.scan(spec.name, must_exist=False)
            R.canonical(rows, list(spec.key)).createOrReplaceTempView(spec.name)
            made.append(spec.name)
        bars, factors = self.spark.table("daily_bars"), self.spark.table("adj_factors")
        qfq = R.adjusted(bars, factors, "qfq", "global")
        for view, df in (("daily_bars_hfq", R.adjusted(bars, factors)), ("daily_bars_qfq", qfq), ("daily_bars_adj", R.both_adjusted(bars, factors))):
            df.createOrReplaceTempView(view)
            made.append(view)
        return made

    def sql(self, text: str) -> DataFrame:
        """One SELECT over the registered views; anything else, and any path or unknown table, is refused."""
        guard_sql(self.spark, text, {*DATASETS, "daily_bars_hfq", "daily_bars_qfq", "daily_bars_adj"})
        return self.spark.sql(text)

    def coverage(self, name: str, calendar: DataFrame | None = None) -> tuple[date | None, date | None]:
        """First and last day of a dataset.

        Day directories and quarters say it by their names.  Of coarser periods only the first and the last are read, for
        their least and greatest day.  calendar: with it, derived dense datasets end at their last session before a hole."""
        spec = dataset(name)
        every = swaps.entries(self.spark, self.path(spec))
        if not every or not spec.date_col:
            return None, None
        column = _period_column(spec, every)
        parts = files.partitions(every, column) if column else []
        loose = files.loose_files(every)
        by_name = parts and not loose and name != "daily_bars"
        if by_name and (spec.granularity == "quarter" or spec.date_col != spec.partition_col or all(p.start == p.end for p, _ in parts)):
            lo, hi = parts[0][0].start, max(p.end for p, _ in parts)
        else:
            if parts:
                # a period may hold the first day if it starts before any other that is known to begin ends
                first = [path for p, path in parts if p.start <= min(q.end for q, _ in parts)]
                last = [path for p, path in parts if p.end >= max(q.start for q, _ in parts)]
                rows = self.read(list(dict.fromkeys([*first, *last, *loose])), spec)
            else:
                rows = self.scan(name)
            rows = R.traded(rows) if name == "daily_bars" else rows
            r = rows.agg(F.min(spec.date_col).alias("lo"), F.max(spec.date_col).alias("hi")).first()
            lo, hi = r.lo, r.hi
        if name in CLAMPED and calendar is not None and hi is not None:
            from lakeforge.quality.checks import last_contiguous

            safe = last_contiguous(self.scan(name).select(F.col(spec.date_col).alias("trade_date")), calendar).first()[0]
            hi = min(hi, safe) if safe else hi
        return lo, hi

    def st_coverage_start(self) -> date | None:
        """The first day with a special-treatment label: statuses before it were never labelled."""
        rows = self.scan("trading_status", must_exist=False)
        return rows.where(F.lower(F.trim("status")).isin("st", "*st")).agg(F.min("trade_date").alias("d")).first().d

    def catalogue(self, calendar: DataFrame | None = None) -> list[dict]:
        out = []
        for spec in DATASETS.values():
            lo, hi = self.coverage(spec.name, calendar)
            out.append({"dataset": spec.name, "tier": spec.tier, "layer": spec.layer, "date_col": spec.date_col, "history_mode": spec.history_mode, "pit": spec.pit, "first": lo, "last": hi})
        return out


def _period_column(spec: Dataset, every: list) -> str | None:
    """The column in the names of the period directories; None for datasets that lie in no periods."""
    for column in (PERIOD, spec.partition_col):
        if column and any(e.name.startswith(column + "=") for e in every):
            return column
    return None


def period_label(column: str, granularity: str | None) -> Column:
    """The period a row belongs to; string columns hold their label already."""
    c = F.col(column)
    pattern = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}.get(granularity or "")
    return F.date_format(c, pattern) if pattern else c.cast("string")


_READ_PLANS = {"Project", "UnresolvedWith", "LocalRelation", "Sort", "GlobalLimit", "LocalLimit", "Filter", "Aggregate", "Distinct", "Union", "UnresolvedHaving", "SubqueryAlias", "Join", "Except", "Intersect", "Offset", "UnresolvedRelation", "UnresolvedInlineTable", "WithWindowDefinition", "UnresolvedSubqueryColumnAliases", "Window", "OneRowRelation", "Pivot", "Generate", "LateralJoin", "View", "Sample", "UnresolvedOrdinal"}


def guard_sql(spark: SparkSession, text: str, allowed: set[str]) -> None:
    jplan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    shown = jplan.toString()
    if jplan.nodeName() not in _READ_PLANS:
        raise PermissionError(f"only a SELECT may run, not {jplan.nodeName()}")
    names = set(re.findall(r"'UnresolvedRelation \[([^\]]*)\]", shown))
    own = set(re.findall(r"(?:CTE|'UnresolvedWith) \[([^\]]*)\]", shown)) | set(re.findall(r"\b(\w+)\s+AS\s*\(", text, re.I))
    for n in names:
        if n.split(",")[0].strip() not in allowed | own or "," in n.replace(", []", "").replace(", [], false", "").split(", [")[0]:
            raise PermissionError(f"no table is named {n}")
    if "UnresolvedTableValuedFunction" in shown:
        raise PermissionError("table functions are not allowed")
    if re.search(r"\b(reflect|java_method|try_reflect|input_file_name)\s*\(", text, re.I):
        raise PermissionError("that function is not allowed")
