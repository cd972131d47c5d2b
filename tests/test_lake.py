from __future__ import annotations

import datetime as dt

import pytest

from lakeforge import partitions as P
from lakeforge.lake import Lake
from lakeforge.operators.readpath import ReaderError, UniverseCoverageError
from lakeforge.registry import DATASETS, dataset
from lakeforge.sources.adapters import FileSource, OnDemand, Snapshots, weekday_calendar
from lakeforge.sources.validate import SchemaValidationError, provenance, validated
from lakeforge.streaming.compact import stream_compact
from tests.conftest import rows

D = dt.date
BARS = dataset("daily_bars").schema


def at(n):
    return dt.datetime(2024, 7, 1, 0, 0, n, tzinfo=dt.timezone.utc)


def bar(symbol, day, close, n=0, volume=100):
    return (symbol, day, close, close, close, close, volume, close * volume, "mock", "v2", at(n))


@pytest.fixture
def lake(spark, tmp_path):
    d = D(2024, 6, 27)
    lk = Lake(spark, str(tmp_path / "lake"))
    frame = lambda name, data: spark.createDataFrame(data, dataset(name).schema)
    p = ("mock", "v1", at(0))
    lk.merge("daily_bars", frame("daily_bars", [bar("600001.SH", d, 10.5), bar("600002.SH", d, 20.5), bar("600003.SH", d, 30.5)]))
    lk.merge("adj_factors", frame("adj_factors", [("600001.SH", d, "hfq", 2.0, *p), ("600002.SH", d, "hfq", 3.0, *p)]))
    lk.merge("instruments", frame("instruments", [(s, s, "SH", "stock", D(2000, 1, 1), None, None, *p) for s in ("600001.SH", "600002.SH", "600003.SH")]))
    lk.merge("trading_status", frame("trading_status", [("600001.SH", d, True, "normal", *p), ("600002.SH", d, True, "ST", *p), ("600003.SH", d, False, "suspended", *p)]))
    lk.merge("financial_statement_items", frame("financial_statement_items", [("600001.SH", "2024Q1", "ind", "roe", 1.0, D(2024, 4, 28), *p), ("600001.SH", "2024Q1", "inc", "revenue", 2.0, D(2024, 5, 15), *p), ("600001.SH", "2024Q1", "inc", "revenue", 3.0, D(2024, 6, 15), *p)]))
    return lk


def test_adjusted_universe_and_point_in_time(lake):
    a = {r.symbol: r for r in lake.load("daily_bars", adjust="hfq").toLocalIterator()}
    assert a["600001.SH"].adj_close == 21.0 and a["600001.SH"].adj_is_exact and not a["600003.SH"].adj_is_exact
    assert rows(lake.load("daily_bars", universe="all_a"), "symbol") == [("600001.SH",)]
    with pytest.raises(ReaderError):
        lake.load("daily_bars", adjust="hfq", strict_adj=True)
    with pytest.raises(ReaderError):
        lake.load("financial_statement_items")
    known = lambda d, **k: rows(lake.load("financial_statement_items", as_of=d, **k), "item_code", "item_value")
    assert known("2024-05-01") == [("roe", 1.0)]
    assert known("2024-06-01") == [("revenue", 2.0), ("roe", 1.0)] and known("2024-07-01") == [("revenue", 3.0), ("roe", 1.0)]
    assert len(known("2024-07-01", all_vintages=True)) == 3 and known("2024-07-01", items=["roe"]) == [("roe", 1.0)]
    assert rows(lake.tradable_on("2024-06-27")) == [("600001.SH",)]


def test_strict_universe_names_the_gap(lake, spark):
    lake.merge("daily_bars", spark.createDataFrame([bar("600001.SH", D(2024, 6, 28), 1.0)], BARS))
    with pytest.raises(UniverseCoverageError, match="600001.SH on 2024-06-28"):
        lake.load("daily_bars", universe="all_a", strict_universe=True)


def test_merge_keeps_the_newest_and_other_periods(lake, spark):
    lake.merge("daily_bars", spark.createDataFrame([bar("600001.SH", D(2024, 6, 27), 12.0, 5), bar("600001.SH", D(2024, 6, 28), 13.0, 5)], BARS))
    lake.merge("daily_bars", spark.createDataFrame([bar("600001.SH", D(2024, 6, 27), 1.0, 2)], BARS))  # late, older
    assert rows(lake.load("daily_bars"), "symbol", "close") == [("600001.SH", 12.0), ("600001.SH", 13.0), ("600002.SH", 20.5), ("600003.SH", 30.5)]
    assert rows(lake.scan("daily_bars", "2024-06-28"), "close") == [(13.0,)]
    assert lake.scan("daily_bars", "1990-01-01", "1990-02-01").schema.names == BARS.names
    with pytest.raises(FileNotFoundError):
        lake.scan("hot_rank")


def test_mixed_periods_strays_and_drift(spark, tmp_path):
    lk = Lake(spark, str(tmp_path))
    root = f"{tmp_path}/curated/daily_bars"
    write = lambda data, where, drop=(): spark.createDataFrame(data, BARS).drop(*drop).write.parquet(f"{root}/{where}")
    write([bar("A", D(2022, 3, 1), 1.0)], "trade_date=2022")
    write([bar("A", D(2023, 3, 1), 2.0)], "trade_date=2023-03", ["amount"])
    write([bar("A", D(2024, 3, 1), 3.0), bar("A", D(2024, 3, 1), 4.0, 5)], "trade_date=2024-03-01")
    write([bar("A", D(2020, 1, 1), 9.0)], "trade_date=junk")
    got = rows(lk.load("daily_bars", start="2022-06-01"), "trade_date", "close", "amount")
    assert got == [(D(2023, 3, 1), 2.0, None), (D(2024, 3, 1), 4.0, 400.0)]
    report = lk.repartition("daily_bars", dry_run=True)
    assert report["partitions_before"] == 4 and lk.scan("daily_bars").count() == 4
    lk.repartition("daily_bars")
    assert rows(lk.load("daily_bars"), "close") == [(1.0,), (2.0,), (4.0,)]


def test_staging_is_validated_and_compacted(lake, spark):
    good = spark.createDataFrame([bar("600009.SH", D(2024, 6, 27), 5.0, 9)], BARS)
    lake.stage("daily_bars", "r1", "b1", good)
    lake.stage("daily_bars", "r1", "b1", good)
    assert lake.compact("daily_bars", "r1") == 1 and lake.compact("daily_bars", "none") == 0
    assert lake.load("daily_bars").where("symbol = '600009.SH'").count() == 1
    for bad in (bar("X", D(2024, 6, 27), -1.0), bar(None, D(2024, 6, 27), 1.0), bar(" ", D(2024, 6, 27), 1.0), bar("X", D(2024, 6, 27), float("inf")), bar("X", D(2024, 6, 27), 1.0, volume=-5)):
        with pytest.raises(SchemaValidationError):
            lake.stage("daily_bars", "r2", "b", spark.createDataFrame([bad], BARS))
    with pytest.raises(SchemaValidationError, match="lacks"):
        validated(good.drop("close"), dataset("daily_bars"))
    assert validated(good.selectExpr("*", "1 as extra"), dataset("daily_bars")).columns == BARS.names


def test_sql_views_and_guard(lake, spark):
    assert len(lake.views()) == len(DATASETS) + 3
    assert lake.sql("with t as (select symbol, hfq.adj_close from daily_bars_hfq hfq) select count(*) n from t join instruments using (symbol)").first().n == 3
    assert lake.sql("select * from hot_rank").count() == 0
    for bad in ("drop view daily_bars", "select 1; select 2", "create table x as select 1", "insert into daily_bars select * from daily_bars", "select * from parquet.`/etc`", "select * from other_table", "set a=1", "select reflect('java.lang.System', 'exit')"):
        with pytest.raises(Exception):
            lake.sql(bad)


def test_streamed_batches_equal_one_merge(spark, tmp_path):
    d = D(2024, 6, 27)
    for i, data in enumerate(([bar("A", d, 1.0, 1), bar("B", d, 2.0, 1)], [bar("A", d, 5.0, 9)], [bar("A", d, 3.0, 2), bar("B", D(2024, 6, 28), 4.0, 2)])):
        spark.createDataFrame(data, BARS).coalesce(1).write.parquet(f"{tmp_path}/staging/{i}")
    lk = Lake(spark, f"{tmp_path}/lake")
    for _ in range(2):  # the second run finds nothing new
        stream_compact(lk, "daily_bars", f"{tmp_path}/staging", f"{tmp_path}/ck", 1).awaitTermination()
    assert rows(lk.load("daily_bars"), "symbol", "close") == [("A", 5.0), ("B", 2.0), ("B", 4.0)]


def test_sources(spark, tmp_path):
    spark.createDataFrame([("600001.SH", "2024-06-27", "1.5", "1.5", "1.5", "x", "100", None)], "symbol string, trade_date string, open string, high string, low string, close string, volume string, amount string").write.option("header", True).csv(f"{tmp_path}/daily_bars.csv")
    with pytest.raises(SchemaValidationError):  # a close that is no number is null, and required
        FileSource("v", str(tmp_path), "csv").fetch(spark, "daily_bars")
    calls = []
    od = OnDemand(str(tmp_path / "cache"), lambda name, s: calls.append(s) or [{"a": 1}])
    assert od.fetch("x", "A") == od.fetch("x", "A") == [{"a": 1}] and calls == ["A"]
    (tmp_path / "cache/x/A.json").write_text("{broken")
    assert od.fetch("x", "A") == [{"a": 1}] and calls == ["A", "A"]
    s = Snapshots(spark, f"{tmp_path}/snap")
    for run in ("20240101", "20240201"):
        s.write(spark.createDataFrame([(run,)], "run_day string"), "src", "daily_bars", run)
    assert s.latest("src", "daily_bars").first().run_day == "20240201" and s.clean("src", "daily_bars", 1) == 1 and s.latest("none", "x") is None
    known = spark.createDataFrame([(D(2024, 1, 2), True), (D(2024, 1, 4), True)], "trade_date date, is_trading boolean")
    cal = {r.trade_date.day: r.is_trading for r in weekday_calendar(spark, D(2024, 1, 1), D(2024, 1, 7), known).toLocalIterator()}
    assert cal == {1: True, 2: True, 3: False, 4: True, 5: True, 6: False, 7: False}
    assert provenance(spark.createDataFrame([("keep",), (None,)], "source string"), "new", "v1").select("source").distinct().count() == 2


def test_registry():
    assert len(DATASETS) == 42 and all(set(d.key) <= set(d.schema.names) for d in DATASETS.values())
    assert dataset("northbound_flows").is_stale(D(2024, 8, 16), D(2026, 1, 1)) is False and dataset("daily_bars").is_stale(D(2024, 1, 1), D(2024, 1, 5)) is True
    assert dataset("trade_ticks").earliest_available(D(2026, 1, 1)) == D(2024, 1, 2) and dataset("minute_bars").earliest_available(D(2026, 1, 1)) < D(2025, 9, 1)
    with pytest.raises(KeyError):
        dataset("nothing")


def test_periods():
    assert [P.parse(v).end for v in ("2024-02-29", "2024-02", "2024Q4", "2023")] == [D(2024, 2, 29), D(2024, 2, 29), D(2024, 12, 31), D(2023, 12, 31)]
    assert P.parse("2024-13") is None and P.parse("x") is None and P.parse("2024-02-30") is None
    assert P.parse("2024Q1").before().value == "2023Q4" and P.parse("2024-03-01").before().value == "2024-02-29"
    assert P.labels_between(D(2023, 11, 5), D(2024, 2, 1), "month") == ["2023-11", "2023-12", "2024-01", "2024-02"]
    assert P.parse("2024-02").overlaps(D(2024, 2, 29), None) and not P.parse("2024-02").overlaps(D(2024, 3, 1), None)
    assert P.parse("2024").elapsed(D(2024, 7, 1)) == pytest.approx(0.5, abs=0.01)
