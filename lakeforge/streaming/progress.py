"""What running streams report: rows and durations of every batch, kept by the driver and readable as a frame."""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Progress(StreamingQueryListener):
    """The last ``keep`` batches of all streams of a session."""

    def __init__(self, keep: int = 10_000):
        self.batches: deque[tuple] = deque(maxlen=keep)
        self.ended: dict[str, str | None] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.ended[str(event.id)] = None

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        self.batches.append((p["id"], p.get("name"), p["batchId"], p["timestamp"], int(p["numInputRows"]), int(p.get("durationMs", {}).get("triggerExecution", 0))))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.ended[str(event.id)] = event.exception or "done"

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.batches), "id string, name string, batch bigint, at string, n_rows bigint, milliseconds bigint")


def watch(spark: SparkSession, keep: int = 10_000) -> Progress:
    listener = Progress(keep)
    spark.streams.addListener(listener)
    return listener
