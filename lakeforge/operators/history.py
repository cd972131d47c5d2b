"""History of changing entity attributes from snapshots (problem 7).

Gaps and islands: the readings of an entity in time order are hashed, a change is marked where the hash differs from
the one before (lag), the running sum of the marks numbers the islands, the least date of an island is the start of
its version and the next island's start its end.

Defined results: readings with a null or blank attribute or a null date are skipped; repeated readings are one; an
entity with no reading has no version; the last version is open.  Extra columns are ignored.  There is one reading
for each entity and date before any window, so a hot entity's group is bounded by the calendar; longer streams can
take ``asof.lag_in_blocks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.operators.best import best_values


def versions(readings: DataFrame, entity: str, on: str, attributes: list[str]) -> DataFrame:
    """entity, attributes, valid_from, valid_to (null for the open one).  readings: at most one row for each entity and date."""
    order = W.partitionBy(entity).orderBy(on)
    marked = readings.where(F.col(on).isNotNull()).withColumn("_hash", F.xxhash64(*(F.struct(F.col(a).isNull(), a) for a in attributes)))
    before = F.lag("_hash").over(order)
    marked = marked.withColumn("_change", F.when(before.isNull() | (before != F.col("_hash")), 1).otherwise(0))
    islands = marked.withColumn("_island", F.sum("_change").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    spans = islands.groupBy(entity, "_island").agg(F.min(on).alias("valid_from"), *(F.min_by(a, on).alias(a) for a in attributes))
    return spans.withColumn("valid_to", F.lead("valid_from").over(W.partitionBy(entity).orderBy("_island"))).select(entity, *attributes, "valid_from", "valid_to")


def snapshot_readings(rows: DataFrame, entity: str, on: str, attribute: str, trust: DataFrame) -> DataFrame:
    """One reading for each entity and date: the attribute of the best row that has it, trimmed and in lower case."""
    text = F.lower(F.trim(F.col(attribute)))
    clean = rows.where(F.col(entity).isNotNull() & F.col(on).isNotNull()).withColumn(attribute, F.when(F.trim(F.col(attribute)) != "", text))
    return best_values(clean, [entity, on], attribute, trust)
