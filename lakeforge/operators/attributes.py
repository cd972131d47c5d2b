"""Attributes as known at event time (problem 4).

Each attribute keeps its own change history (one row for each day on which it became known), is matched by its own
last-known search, and the matches are pivoted back to the event as one map from attribute to version.  No wide
version of all attributes is ever stored, so attributes may change at different times.

Defined results: facts without a known date, or known before ``known_floor`` (placeholder dates), were never known;
events repeat as often as they come in ``attribute_versions`` and once in ``known_attributes``; an event with no
known attribute gets an empty map; null keys match nothing.  Hot keys: see ``asof.last_known``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.operators.asof import last_known

KNOWN_FLOOR = "2001-01-01"


def fact_history(items: DataFrame, known_floor: str = KNOWN_FLOOR) -> DataFrame:
    """symbol, attr_name, known_on, attr_key of the statement items."""
    return items.where((F.col("announce_date") >= F.lit(known_floor).cast("date")) & F.col("item_code").isNotNull() & F.col("report_period").isNotNull()).select(
        "symbol", F.col("item_code").alias("attr_name"), F.col("announce_date").alias("known_on"), F.col("report_period").alias("attr_key")
    )


def membership_history(members: DataFrame) -> DataFrame:
    return members.where(F.col("as_of_date").isNotNull() & F.col("classification_system").isNotNull()).select(
        "symbol", F.col("classification_system").alias("attr_name"), F.col("as_of_date").alias("known_on"), F.col("industry_code").alias("attr_key")
    )


def attribute_versions(events: DataFrame, histories: dict[str, tuple[DataFrame, bool]], on: str = "trade_date") -> DataFrame:
    """symbol, day and ``known``: a map from attribute name to (attr_key, known_date), one row for each distinct symbol and day.

    histories: by name, the change history and whether the greatest key wins (facts of the latest period) or the
    latest date (snapshots)."""
    days = events.select("symbol", on).where(F.col("symbol").isNotNull() & F.col(on).isNotNull()).distinct()
    matches = []
    for history, by_key in histories.values():
        # which attributes a symbol has at all: bounded by the number of attributes
        names = history.select("symbol", "attr_name").distinct()
        wanted = days.join(names, "symbol")
        value = F.struct("attr_key", F.col("known_on").alias("known_date")) if by_key else F.struct(F.col("known_on").alias("known_date"), "attr_key")
        found = last_known(wanted, history, ["symbol", "attr_name"], on, "known_on", value).where("known is not null")
        matches.append(found.select("symbol", on, "attr_name", F.struct(F.col("known.attr_key").alias("attr_key"), F.col("known.known_date").alias("known_date")).alias("version")))
    long = reduce(DataFrame.unionByName, matches)
    return long.groupBy("symbol", on).agg(F.map_from_entries(F.collect_list(F.struct("attr_name", "version"))).alias("known"))


def known_attributes(events: DataFrame, histories: dict[str, tuple[DataFrame, bool]], event_key: list[str], on: str = "trade_date") -> DataFrame:
    """Every distinct event with the map of its attributes' known versions."""
    distinct = events.select(*event_key).distinct()
    versions = attribute_versions(events, histories, on)
    return distinct.join(versions, ["symbol", on], "left").withColumn("known", F.coalesce("known", F.expr("cast(map() as " + versions.schema["known"].dataType.simpleString() + ")")))


def unpivot_known(pivoted: DataFrame, event_key: list[str]) -> DataFrame:
    """One row for each event and known attribute."""
    return pivoted.select(*event_key, F.explode("known").alias("attr_name", "version")).select(*event_key, "attr_name", "version.attr_key", "version.known_date")
