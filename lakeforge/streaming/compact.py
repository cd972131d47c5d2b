"""Incremental loads: a stream over staged files, merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakeforge.lake import Lake
from lakeforge.registry import dataset


def stream_compact(lake: Lake, name: str, staging: str, checkpoint: str, files_per_batch: int = 100):
    """Merges what is new under ``staging`` and stops.  Each batch is one merge under the lake's lock; one that is delivered
    again merges to the same rows, so a lost executor or driver costs a repeat, never a duplicate nor a row."""
    source = lake.spark.readStream.schema(dataset(name).schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch).parquet(staging)

    def merge(rows: DataFrame, _: int) -> None:
        if not rows.isEmpty():
            lake.merge(name, rows)

    return source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_dedupe(rows: DataFrame, key: list[str], event_time: str, late: str = "1 day") -> DataFrame:
    """Each key once within the watermark, for streams that repeat deliveries."""
    return rows.withWatermark(event_time, late).dropDuplicatesWithinWatermark(key)


def stream_windows(rows: DataFrame, event_time: str, size: str, late: str, by: list[str]) -> DataFrame:
    """Tumbling counts with late rows up to the watermark."""
    from pyspark.sql import functions as F

    return rows.withWatermark(event_time, late).groupBy(F.window(event_time, size), *by).agg(F.count(F.lit(1)).alias("n"))
