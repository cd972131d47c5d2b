"""Stored statistics of a lake: rows, symbols and provenance of every period, rebuilt for the datasets that changed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge import swaps
from lakeforge.functions.joins import null_safe_join
from lakeforge.lake import Lake, lock_path, period_label
from lakeforge.locks import writing
from lakeforge.operators.storage import partition_stats, provenance_mix
from lakeforge.registry import DATASETS, dataset
from lakeforge.sources import files

PARTITIONS = "dataset string, partition string, n_rows bigint, symbols bigint, fetched_epoch bigint, n_files bigint, n_bytes bigint"
PROVENANCE = "dataset string, partition string, source string, data_version string, n_rows bigint, first_epoch bigint, last_epoch bigint"


class Stats:
    """Tables below ``<root>/meta/stats``, one directory a dataset, and the state of the files they were made from."""

    def __init__(self, lake: Lake):
        self.lake, self.spark, self.root = lake, lake.spark, f"{lake.root}/meta/stats"

    def _files(self, name: str) -> DataFrame:
        """path, size and period of the data files, from the listing."""
        spec = dataset(name)
        found = [(e.name, f) for e in swaps.entries(self.spark, self.lake.path(spec)) for f in files.leaf_files(self.spark, e.path)]
        rows = [(f, files.size_of(self.spark, f), n.split("=", 1)[1] if "=" in n else None) for n, f in found]
        return self.spark.createDataFrame(rows, "path string, n_bytes bigint, partition string")

    def print_of(self, name: str) -> str:
        """What the dataset's files look like from outside; it changes whenever one is added, removed or replaced."""
        r = self._files(name).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("path", "n_bytes")).alias("x")).first()
        return f"{r.n}:{r.x}"

    def stale(self) -> list[str]:
        known = json.loads(files.read_text(self.spark, f"{self.root}/prints.json") or "{}")
        return [n for n in DATASETS if swaps.entries(self.spark, self.lake.path(dataset(n))) and known.get(n) != self.print_of(n)]

    def rebuild(self, names: list[str] | None = None) -> list[str]:
        """Statistics of the named datasets (of all that changed) anew; those of others stay."""
        names = self.stale() if names is None else names
        with writing(self.spark, lock_path(self.lake.root)):
            for kind in ("partitions", "provenance"):
                swaps.recover(self.spark, f"{self.root}/{kind}")
            known = json.loads(files.read_text(self.spark, f"{self.root}/prints.json") or "{}")
            for name in names:
                about = self._files(name)
                rows = self.lake.scan(name, must_exist=False)
                column = dataset(name).partition_col
                label = F.lit(None).cast("string") if column is None else period_label(column, dataset(name).granularity)
                sized = about.groupBy("partition").agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
                rows = rows if "symbol" in rows.columns else rows.withColumn("symbol", F.lit(None).cast("string"))
                stats = null_safe_join(partition_stats(rows, label), sized, ["partition"], "left")
                self._put("partitions", name, stats.select(F.lit(name).alias("dataset"), "partition", "n_rows", "symbols", "fetched_epoch", F.coalesce("n_files", F.lit(0)).alias("n_files"), F.coalesce("n_bytes", F.lit(0)).alias("n_bytes")))
                self._put("provenance", name, provenance_mix(rows, label).select(F.lit(name).alias("dataset"), "partition", "source", "data_version", "n_rows", "first_epoch", "last_epoch"))
                known[name] = self.print_of(name)
            files.write_text(self.spark, f"{self.root}/prints.json", json.dumps(known, sort_keys=True))
        return names

    def _put(self, kind: str, name: str, rows: DataFrame) -> None:
        root = f"{self.root}/{kind}"
        staged = swaps.new_staging(root)
        rows.coalesce(1).write.parquet(f"{staged}/of={name}")  # one row a period
        swaps.swap(self.spark, root, staged, [f"of={name}"])

    def _read(self, kind: str, ddl: str) -> DataFrame:
        paths = [e.path for e in swaps.entries(self.spark, f"{self.root}/{kind}")]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def partitions(self) -> DataFrame:
        return self._read("partitions", PARTITIONS)

    def provenance(self) -> DataFrame:
        return self._read("provenance", PROVENANCE)

    def provenance_of_periods(self, name: str) -> DataFrame:
        """The sources of each period with the period's own rows and files."""
        of = lambda df: df.where(F.col("dataset") == name)
        about = of(self.partitions()).select("partition", F.col("n_rows").alias("period_rows"), "n_files")
        return of(self.provenance()).join(about, "partition").withColumn("share", F.try_divide("n_rows", "period_rows"))
