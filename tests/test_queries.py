"""Every query with SQL against DuckDB on the smallest test tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

from lakeforge.plans import registered

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def text(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return ""
        return f"{float(v):.5f}" if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "dtype") and v.dtype.kind in "if" else str(v)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, duck, name):
    got = registered.queries()[name](spark, FOLDER).toPandas()
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns)
        return
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert text(got) == text(want)


def test_dates_are_text(spark):
    for name in ("scan_range", "survivorship_status", "heatmap_cells", "month_end_sessions"):
        kinds = dict(registered.queries()[name](spark, FOLDER).dtypes)
        assert "date" not in kinds.values() and set(registered.date_columns(name)) <= set(kinds)
