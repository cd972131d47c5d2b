"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Settings the engine's semantics rely on: UTC instants, ANSI errors, adaptive plans.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    b = SparkSession.builder.master(master).appName("lakeforge").config(map=SETTINGS | extra)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return b.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where it is unset (tests, one machine)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("a cluster needs spark.checkpoint.dir: a folder that all executors share")
    return "file://" + _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    """One folder for each process of a single machine; gone when it ends."""
    path = tempfile.mkdtemp(prefix="lakeforge-")
    atexit.register(shutil.rmtree, path, True)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Writes the frame to the shared folder and reads it back: a short lineage that survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/cut-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession) -> int:
    """Deletes the tables that ``cut`` wrote for this application; to be called when its results are written."""
    from lakeforge.sources.files import delete, entries

    own = [e for e in entries(spark, shared_folder(spark)) if e.name.startswith(f"cut-{spark.sparkContext.applicationId}-")]
    for e in own:
        delete(spark, e.path)
    return len(own)
