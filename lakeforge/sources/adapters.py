"""Sources: anything that yields a frame of a dataset for a window.  Files are read here; networks are the caller's."""

from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path
from typing import Callable, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators.readpath import date_range, symbols_in
from lakeforge.registry import dataset
from lakeforge.sources.validate import provenance, validated


class SourceAdapter(Protocol):
    name: str

    def fetch(self, spark: SparkSession, dataset_name: str, start: str | None, end: str | None, symbols: list[str] | None) -> DataFrame: ...


class FileSource:
    """Parquet, CSV or JSON files ``<folder>/<dataset>.<format>`` as a vendor."""

    def __init__(self, name: str, folder: str, kind: str = "parquet", version: str = "v1"):
        self.name, self.folder, self.kind, self.version = name, folder, kind, version

    def fetch(self, spark: SparkSession, dataset_name: str, start: str | None = None, end: str | None = None, symbols: list[str] | None = None) -> DataFrame:
        spec = dataset(dataset_name)
        reader = spark.read.option("header", True) if self.kind == "csv" else spark.read
        raw = reader.format(self.kind).load(f"{self.folder}/{dataset_name}.{self.kind}")
        rows = validated(provenance(raw, self.name, self.version), spec)
        rows = symbols_in(rows, symbols)
        return date_range(rows, spec.date_col, start, end) if spec.date_col else rows


def lots_to_shares(column: str = "volume") -> F.Column:
    """Vendors' lots of 100; a null counts as none."""
    return (F.coalesce(column, F.lit(0)) * 100).cast("bigint")


class OnDemand:
    """A per-symbol JSON cache before a provider; failures are never kept, and a corrupt entry is fetched again."""

    def __init__(self, folder: str, provider: Callable[[str, str], list[dict]]):
        self.folder, self.provider = Path(folder), provider

    def fetch(self, dataset_name: str, symbol: str) -> list[dict]:
        path = self.folder / dataset_name / f"{symbol}.json"
        try:
            return json.loads(path.read_text())["rows"]
        except (OSError, ValueError, KeyError):
            rows = self.provider(dataset_name, symbol)
            path.parent.mkdir(parents=True, exist_ok=True)
            part = path.with_suffix(f".{os.getpid()}.part")
            part.write_text(json.dumps({"rows": rows}, default=str))
            part.replace(path)
            return rows


class Snapshots:
    """Rows of a backup source, kept apart from the lake: ``<root>/<source>/<dataset>/run=<time>``; the newest run is read."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def write(self, rows: DataFrame, source: str, dataset_name: str, run: str) -> str:
        path = f"{self.root}/{source}/{dataset_name}/run={run}"
        rows.write.mode("overwrite").parquet(path)
        return path

    def runs(self, source: str, dataset_name: str) -> list[str]:
        from lakeforge.sources.files import entries

        return [e.name.split("=", 1)[1] for e in entries(self.spark, f"{self.root}/{source}/{dataset_name}") if e.name.startswith("run=")]

    def latest(self, source: str, dataset_name: str) -> DataFrame | None:
        runs = self.runs(source, dataset_name)
        return self.spark.read.parquet(f"{self.root}/{source}/{dataset_name}/run={runs[-1]}") if runs else None

    def clean(self, source: str, dataset_name: str, keep: int) -> int:
        from lakeforge.sources.files import delete

        old = self.runs(source, dataset_name)[:-keep] if keep else self.runs(source, dataset_name)
        for run in old:
            delete(self.spark, f"{self.root}/{source}/{dataset_name}/run={run}")
        return len(old)


def weekday_calendar(spark: SparkSession, start: date, end: date, known: DataFrame | None = None) -> DataFrame:
    """trade_date, is_trading: known days as given; other weekdays trade unless known days surround them."""
    days = spark.sql(f"select explode(sequence(date'{start}', date'{end}')) as trade_date").withColumn("weekday", F.weekday("trade_date") < 5)
    if known is None:
        return days.select("trade_date", F.col("weekday").alias("is_trading"))
    span = known.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    k = known.groupBy("trade_date").agg(F.max("is_trading").alias("given"))
    out = days.join(F.broadcast(span)).join(k, "trade_date", "left")
    return out.select("trade_date", F.coalesce("given", F.when(F.col("trade_date").between(F.col("lo"), F.col("hi")), F.lit(False)), F.col("weekday")).alias("is_trading"))


def session_calendar(spark: SparkSession, start: date, end: date, seed: DataFrame, bars: DataFrame) -> DataFrame:
    """trade_date, is_trading: the seed's word in its span; outside it a day with bars trades and, in the era of the bars, one
    without does not; before that weekdays trade.  Days beyond both seed and bars are refused: they would be guesses."""
    last = seed.select("trade_date").unionByName(bars.select("trade_date")).agg(F.max("trade_date").alias("d")).first().d
    if last is None or end > last:
        raise ValueError(f"no calendar is known beyond {last}")
    known = bars.select("trade_date").where("trade_date is not null").distinct().withColumn("traded", F.lit(True))
    era = known.agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    said = seed.groupBy("trade_date").agg(F.max("is_trading").alias("said"))
    span = seed.agg(F.min("trade_date").alias("a"), F.max("trade_date").alias("z"))
    days = spark.sql(f"select explode(sequence(date'{start}', date'{end}')) as trade_date").join(F.broadcast(span)).join(F.broadcast(era)).join(said, "trade_date", "left").join(known, "trade_date", "left")
    day = F.col("trade_date")
    told = F.when(day.between(F.col("a"), F.col("z")), F.coalesce("said", F.lit(False))).when(day.between(F.col("lo"), F.col("hi")), F.coalesce("traded", F.lit(False))).otherwise(F.weekday(day) < 5)
    return days.select("trade_date", told.alias("is_trading"))


def sessions_after(calendar: DataFrame, mark: date | None, today: date, look_back: int = 5) -> DataFrame:
    """The sessions an incremental run has to fetch: after the mark (or of the last days) to today."""
    from datetime import timedelta

    start = mark + timedelta(days=1) if mark else today - timedelta(days=look_back)
    return calendar.where("is_trading").where(F.col("trade_date").between(F.lit(start), F.lit(today))).select("trade_date").distinct()
