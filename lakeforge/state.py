"""What a lake remembers between runs: watermarks, sets of symbols to retry, runs and batches, and who writes."""

from __future__ import annotations

import json
from collections import Counter
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.lake import Lake, lock_path
from lakeforge.locks import LockedError as LockedError
from lakeforge.locks import writing
from lakeforge.quality.checks import last_contiguous
from lakeforge.sources import files


class State:
    """Small JSON documents under ``<root>/meta``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/") + "/meta"

    def _get(self, name: str) -> dict:
        text = files.read_text(self.spark, f"{self.root}/{name}.json")
        return json.loads(text) if text else {}

    def _put(self, name: str, value: dict) -> None:
        files.write_text(self.spark, f"{self.root}/{name}.json", json.dumps(value, sort_keys=True))

    # --- watermarks

    def mark(self, dataset: str) -> date | None:
        d = self._get("watermarks").get(dataset)
        return date.fromisoformat(d) if d else None

    def raise_mark(self, dataset: str, day: date) -> date:
        """Moves forward only."""
        marks = self._get("watermarks")
        new = max(day, date.fromisoformat(marks.get(dataset, "0001-01-01")))
        self._put("watermarks", marks | {dataset: new.isoformat()})
        return new

    def reconcile_mark(self, dataset: str, days: DataFrame, calendar: DataFrame) -> tuple[date | None, date | None]:
        """Pulls a mark that is ahead of the data down to the last session before the first hole; (before, after)."""
        before = self.mark(dataset)
        true = last_contiguous(days, calendar).first()[0]
        if before is not None and (true is None or before > true):
            marks = self._get("watermarks")
            marks.pop(dataset)
            self._put("watermarks", marks | ({dataset: true.isoformat()} if true else {}))
            return before, true
        return before, before

    def window(self, dataset: str, today: date, look_back: int = 5) -> tuple[date, date] | None:
        """From the day after the mark to today, else the look-back; None when nothing is due."""
        from datetime import timedelta

        mark = self.mark(dataset)
        start = mark + timedelta(days=1) if mark else today - timedelta(days=look_back)
        return (start, today) if start <= today else None

    # --- symbols to retry

    def retries(self, name: str) -> set[str]:
        return set(self._get("retries").get(name, []))

    def update_retries(self, name: str, failed: set[str], succeeded: set[str]) -> set[str]:
        left = (self.retries(name) - succeeded) | failed
        self._put("retries", self._get("retries") | {name: sorted(left)})
        return left

    # --- runs and batches

    def start(self, run: str, job: str) -> None:
        self._put(f"runs/{run}", {"run": run, "job": job, "status": "running", "started": datetime.now(timezone.utc).isoformat(), "batches": {}})

    def batch(self, run: str, name: str, status: str, rows: int = 0) -> None:
        r = self._get(f"runs/{run}")
        r["batches"][name] = {"status": status, "rows": rows}
        self._put(f"runs/{run}", r)

    def finish(self, run: str) -> str:
        """Success only where every batch succeeded; a run without one has failed."""
        r = self._get(f"runs/{run}")
        states = {b["status"] for b in r["batches"].values()}
        r["status"] = "success" if states == {"success"} else "failed" if not states or states == {"failed"} else "warning"
        self._put(f"runs/{run}", r)
        return r["status"]

    def may_compact(self, run: str, prefix: str) -> bool:
        """Whether no batch of the dataset is incomplete."""
        return all(b["status"] == "success" for n, b in self._get(f"runs/{run}")["batches"].items() if n.startswith(prefix))

    def runs(self) -> list[dict]:
        return [self._get(f"runs/{e.name.removesuffix('.json')}") for e in files.entries(self.spark, f"{self.root}/runs") if e.name.endswith(".json")]

    def summary(self) -> dict[str, int]:
        return dict(Counter(r["status"] for r in self.runs()))

    def supersede_stale(self, running: set[str]) -> list[str]:
        """Runs left running by a driver that is gone."""
        gone = [r for r in self.runs() if r["status"] == "running" and r["run"] not in running]
        for r in gone:
            self._put(f"runs/{r['run']}", r | {"status": "superseded"})
        return [r["run"] for r in gone]

    # --- one writer

    def writing(self, stale_after: float = 600.0):
        """Holds the lake's lock, see ``locks.writing``."""
        return writing(self.spark, lock_path(self.root.removesuffix("/meta")), stale_after)


def clean_staging(spark: SparkSession, root: str, keep: set[str]) -> int:
    """Deletes staged runs other than ``keep``."""
    return Lake(spark, root).clear_staging(keep)


def unfinished_days(sessions: DataFrame, have: DataFrame, least: int, by: str = "symbol") -> DataFrame:
    """Sessions that lack ``least`` distinct ``by``: what a backfill still has to do."""
    done = have.groupBy("trade_date").agg(F.countDistinct(by).alias("n")).where(F.col("n") >= least)
    return sessions.select("trade_date").distinct().join(done.select("trade_date"), "trade_date", "left_anti")


def unissued(spark: SparkSession, bands: list[tuple[str, int, int]], known: DataFrame) -> DataFrame:
    """Codes of the bands [first, last) that no known symbol has."""
    all_codes = spark.createDataFrame(bands, "exchange string, first int, last int").select(F.explode(F.sequence("first", F.col("last") - 1)).alias("n"), "exchange")
    return all_codes.select(F.concat_ws(".", F.lpad(F.col("n").cast("string"), 6, "0"), "exchange").alias("symbol")).join(known.select("symbol"), "symbol", "left_anti")
