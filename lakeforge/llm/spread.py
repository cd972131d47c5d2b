"""Enough tasks for work that is bound by Python rather than by input, and slices that bound a task's memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def spread(df: DataFrame, tasks_per_core: int = 4) -> DataFrame:
    """Repartitions a table that lies in fewer scan tasks than the cluster has cores; larger tables stay as they are.

    Only the plan depends on it: every row is worked on by itself, so results are the same either way."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks_per_core * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def slices(batches: Iterator[pa.RecordBatch], column: int, most_rows: int = 500, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of bounded rows and bytes of text (a longer text comes alone)."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        s, before = 0, 0
        while s < b.num_rows:
            e = min(s + most_rows, max(s + 1, int(np.searchsorted(size, before + most_bytes, side="right"))))
            yield b.slice(s, e - s)
            s, before = e, int(size[e - 1])
