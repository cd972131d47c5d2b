"""Differences between two copies of a table (problem 5).

Method: content-defined chunking.  Only keys and hashes of the values travel: each copy is reduced to the current hash of
each key, both are brought together by (key head, period) and sorted by key; a chunk ends where the rolling hash of the
last ``roll`` keys meets a condition, so equal stretches are cut alike on both sides even where rows are missing around
them.  Chunks whose fingerprint has a partner on the other side are dropped (the anti-join: both copies lie in the same
partitions, so it needs no shuffle of its own).  In the others a key whose hash stands alone is missing on the other side;
only keys that have two different hashes get their values read again, and compared field by field.

A hash covers the values rounded to eight significant digits: equal hashes mean values that differ by less than any
tolerance above 1e-7 (smaller ones are refused), so no difference is lost, and float noise costs nothing but a comparison.

Defined results: keys are compared null-safe; of repeated keys the latest ``fetched_at`` counts, ties by the greatest
hash of the values; a field null on both sides is equal, on one side different; NaN counts as null; either table may be
empty.  Segments are bounded by the period (a year of one key head), however hot the key; repeats are folded map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeforge.functions.columns import relative_gap_over
from lakeforge.functions.joins import null_safe_join, possible
from lakeforge.session import cut


def eight_digits(c: Column) -> Column:
    """The value rounded to eight significant digits; NaN for a null, which a hash would skip."""
    v = c.cast("double")
    scale = F.pow(F.lit(10.0), F.lit(7) - F.floor(F.log10(F.abs(v))))
    return F.when(v.isNull(), F.lit(float("nan"))).when(v == 0, F.lit(0.0)).when((F.abs(v) == float("inf")) | (F.abs(v) < 1e-290), v).otherwise(F.rint(v * scale) / scale)


LEAST_TOLERANCE = 1e-7


def value_hash(values: list[str]) -> Column:
    return F.xxhash64(*(eight_digits(F.when(~F.isnan(F.col(c).cast("double")), F.col(c))) for c in values))


def current_hashes(df: DataFrame, key: list[str], values: list[str], latest: str = "fetched_at") -> DataFrame:
    """The hash ``_h`` of the latest row of each key; partial aggregation folds repeats before the shuffle."""
    best = F.max(F.struct(F.col(latest).alias("_at"), value_hash(values).alias("_h"))).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, F.col("_best._h").alias("_h"))


def current_rows(df: DataFrame, key: list[str], values: list[str], latest: str = "fetched_at") -> DataFrame:
    """The values of the latest row of each key, by the same order as ``current_hashes``."""
    clean = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c) for c in values]
    best = F.max(F.struct(F.col(latest).alias("_at"), value_hash(values).alias("_h"), F.struct(*clean).alias("_v"))).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *(F.col("_best._v")[c].alias(c) for c in values))


def unmatched_keys(left: DataFrame, right: DataFrame, key: list[str], head: str, period: Column, roll: int = 4, chunk_rows: int = 16) -> DataFrame:
    """Keys with the hashes ``l`` and ``r`` of both sides (null where the key is missing), of the keys in chunks without a
    partner whose hashes differ.  Inputs: ``current_hashes``."""
    tag = lambda df, side: df.withColumn("_side", F.lit(side))
    rows = tag(left, 0).unionByName(tag(right, 1)).withColumn("_period", period)
    segment = ["_period", head]
    rows = rows.repartition(*segment).withColumn("_k", F.xxhash64(*key))
    rows = rows.withColumn("_c", F.xxhash64("_k", "_h"))
    ordered = W.partitionBy(*segment, "_side").orderBy(*(F.col(c).asc_nulls_first() for c in key if c != head))
    rolling = F.sum(F.shiftrightunsigned("_k", 8)).over(ordered.rowsBetween(-(roll - 1), 0))
    rows = rows.withColumn("_cut", (F.pmod(F.xxhash64(rolling), F.lit(chunk_rows)) == 0).cast("int"))
    # a row that meets the condition ends its chunk, so it counts for the rows after it
    rows = rows.withColumn("_chunk", F.coalesce(F.sum("_cut").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    chunk = W.partitionBy(*segment, "_side", "_chunk")
    print_ = F.struct(F.count(F.lit(1)).over(chunk), F.sum(F.shiftrightunsigned("_c", 20)).over(chunk), F.bit_xor("_c").over(chunk))
    rows = rows.withColumn("_print", F.xxhash64(print_))
    partners = W.partitionBy(*segment, "_print")
    rows = rows.withColumn("_alone", F.min("_side").over(partners) == F.max("_side").over(partners))
    of = lambda side: F.max(F.when(F.col("_side") == side, F.col("_h")))
    both = rows.where("_alone").groupBy(*segment, *(c for c in key if c != head)).agg(of(0).alias("l"), of(1).alias("r"))
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select(*key, "l", "r")


def differences(left: DataFrame, right: DataFrame, key: list[str], values: list[str], head: str, period: Column, names: tuple[str, str], tolerance: float = 1e-6) -> DataFrame:
    """Key, diff_kind and field_name.  Inputs: the rows of both copies, as often as they come.  names: the kinds for rows
    missing on the right and on the left."""
    if tolerance < LEAST_TOLERANCE:
        raise ValueError(f"a tolerance under {LEAST_TOLERANCE} needs more digits than the fingerprints have")
    left, right = (x.select(*key, *values, "fetched_at") for x in (left, right))
    keys = cut(unmatched_keys(current_hashes(left, key, values), current_hashes(right, key, values), key, head, period))
    missing = keys.where("l is null or r is null").select(*key, F.when(F.col("r").isNull(), names[0]).otherwise(names[1]).alias("diff_kind"), F.lit("").alias("field_name"))
    asked = keys.where("l is not null and r is not null").select(*key)
    # only rows that may have such a key are shuffled with their values
    l, r = (current_rows(null_safe_join(possible(x, asked, key), asked, key, "left_semi"), key, values) for x in (left, right))
    return missing.unionByName(_compared(l, r, key, values, names, tolerance, "inner"))


def _compared(l: DataFrame, r: DataFrame, key: list[str], values: list[str], names: tuple[str, str], tolerance: float, how: str) -> DataFrame:
    both = null_safe_join(l.select(*key, F.struct(*values).alias("l")), r.select(*key, F.struct(*values).alias("r")), key, how)
    field = lambda c: F.when(relative_gap_over(F.col("l")[c], F.col("r")[c], tolerance), F.struct(F.lit("value_differs").alias("diff_kind"), F.lit(c).alias("field_name")))
    missing = lambda kind: F.array(F.struct(F.lit(kind).alias("diff_kind"), F.lit("").alias("field_name")))
    found = F.when(F.col("r").isNull(), missing(names[0])).when(F.col("l").isNull(), missing(names[1])).otherwise(F.filter(F.array(*map(field, values)), lambda x: x.isNotNull()))
    return both.select(*key, F.explode(found).alias("d")).select(*key, "d.diff_kind", "d.field_name")


def full_join_differences(left: DataFrame, right: DataFrame, key: list[str], values: list[str], names: tuple[str, str], tolerance: float = 1e-6) -> DataFrame:
    """The same by comparing every row: the plain way the chunked one is tested against.  Inputs: ``current_rows``."""
    return _compared(left, right, key, values, names, tolerance, "full")
