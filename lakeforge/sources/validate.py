"""The contract of a dataset's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.functions.columns import any_of
from lakeforge.quality.checks import bar_violations
from lakeforge.registry import Dataset


class SchemaValidationError(ValueError):
    """Rows that break their dataset's contract."""


def provenance(df: DataFrame, source: str, version: str, fetched_at: Column | None = None) -> DataFrame:
    """Stamps the three provenance columns; a source already set stays."""
    kept = F.coalesce("source", F.lit(source)) if "source" in df.columns else F.lit(source)
    return df.withColumns({"source": kept, "data_version": F.lit(version), "fetched_at": F.current_timestamp() if fetched_at is None else fetched_at})


def cast_to(df: DataFrame, spec: Dataset, allow_missing: bool = False) -> DataFrame:
    """The dataset's columns in order, cast without failing (what cannot be cast is null); others are dropped."""
    missing = [c for c in spec.schema.names if c not in df.columns]
    need = [c for c in missing if not allow_missing or c in spec.required_columns]
    if need:
        raise SchemaValidationError(f"{spec.name} lacks {', '.join(need)}")
    kinds = {f.name: f.dataType for f in df.schema}
    cells = []
    for f in spec.schema:
        if f.name in missing:
            cells.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif kinds[f.name] == f.dataType:
            cells.append(F.col(f.name))
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)) and isinstance(kinds[f.name], (T.TimestampNTZType, T.TimestampType)):
            cells.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cells.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*cells)


def faults(spec: Dataset) -> dict[str, Column]:
    """By name, whether a row breaks the contract."""
    kinds = {f.name: f.dataType for f in spec.schema}
    need = spec.required_columns
    out = {
        "null": any_of([F.col(c).isNull() for c in need]),
        "blank": any_of([F.coalesce(F.trim(c) == "", F.lit(False)) for c in need if isinstance(kinds[c], T.StringType)]),
        "not_finite": any_of([F.coalesce(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), F.lit(False)) for c, k in kinds.items() if isinstance(k, T.DoubleType)]),
    }
    if spec.is_bars:
        out["bar"] = bar_violations()
    return out


def validated(df: DataFrame, spec: Dataset, allow_missing: bool = False, strict: bool = True) -> DataFrame:
    """Cast rows; strict: one pass counts the faults and refuses any, else faulty rows are left out."""
    rows = cast_to(df, spec, allow_missing)
    bad = faults(spec)
    if not strict:
        return rows.where(~any_of(list(bad.values())))
    counts = rows.agg(*(F.count_if(c).alias(n) for n, c in bad.items())).first().asDict()
    if any(counts.values()):
        raise SchemaValidationError(f"{spec.name}: " + ", ".join(f"{v} rows {n}" for n, v in counts.items() if v))
    return rows


def checked(df: DataFrame, spec: Dataset) -> DataFrame:
    """The rows as they are; one that breaks the contract fails the query that reads it, naming the fault.

    Lazy, in one pass with the query.  The condition counts as not deterministic, so the optimiser cannot move it before
    the filters that come first."""
    fault = F.concat_ws(", ", *(F.when(c, F.lit(n)) for n, c in faults(spec).items() if n != "null" or set(spec.required_columns) <= set(df.columns)))
    if not set(spec.schema.names) <= set(df.columns):
        return df
    told = F.concat(F.lit(f"{spec.name}: a row is "), fault)
    return df.where(F.when((fault != "") & (F.rand() < 2), F.raise_error(told).cast("boolean")).otherwise(True))
