from __future__ import annotations

import datetime as dt
import json

import pytest

from lakeforge import __main__ as cli
from lakeforge import tools
from lakeforge.lake import Lake
from lakeforge.quality import capture as C
from lakeforge.quality.audit import audit, verify
from lakeforge.registry import dataset
from lakeforge.state import LockedError, State, clean_staging, unfinished_days, unissued
from tests.conftest import rows

D = dt.date
BARS = dataset("daily_bars").schema
P = ("mock", "v1", dt.datetime(2024, 7, 1, tzinfo=dt.timezone.utc))


def bar(symbol, day, close=1.0):
    return (symbol, day, close, close, close, close, 100, 1.0, *P)


def days(spark, *ds):
    return spark.createDataFrame([(d,) for d in ds], "trade_date date")


def test_marks_retries_runs_and_lock(spark, tmp_path):
    s = State(spark, str(tmp_path))
    assert s.mark("x") is None and s.window("x", D(2024, 1, 10)) == (D(2024, 1, 5), D(2024, 1, 10))
    s.raise_mark("x", D(2024, 1, 9))
    assert s.raise_mark("x", D(2024, 1, 3)) == D(2024, 1, 9) and s.window("x", D(2024, 1, 9)) is None
    cal = days(spark, *(D(2024, 1, n) for n in range(1, 10)))
    assert s.reconcile_mark("x", days(spark, D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 4)), cal) == (D(2024, 1, 9), D(2024, 1, 2)) and s.mark("x") == D(2024, 1, 2)
    assert s.update_retries("f", {"A", "B"}, set()) == {"A", "B"} and s.update_retries("f", {"C"}, {"A"}) == {"B", "C"}
    s.start("r1", "daily")
    s.batch("r1", "daily_bars/1", "success", 5)
    s.batch("r1", "hot_rank/1", "failed")
    assert s.may_compact("r1", "daily_bars/") and not s.may_compact("r1", "hot_rank/") and s.finish("r1") == "warning"
    s.start("r2", "daily")
    assert s.supersede_stale(set()) == ["r2"] and s.summary() == {"warning": 1, "superseded": 1}
    with s.writing():
        with pytest.raises(LockedError):
            with s.writing():
                pass
        with s.writing(stale_after=-1):
            pass


def test_capture_guards(spark):
    b = spark.createDataFrame([bar("A", D(2024, 1, 2)), bar("A", D(2024, 1, 3)), bar("B", D(2024, 1, 2))], BARS)
    assert C.covers_symbols(b, ["A", "B"]) is b and C.within(b, "2024-01-01", "2024-01-31") is b
    for f in (
        lambda: C.covers_symbols(b, ["A", "Z"]), lambda: C.within(b, "2024-01-03", "2024-01-31"), lambda: C.of_day(b, "2024-01-02"), lambda: C.in_scope(b, ["A"], "2024-01-01", "2024-01-31"),
        lambda: C.sessions_complete(b, days(spark, D(2024, 1, 2), D(2024, 1, 3)), "2024-01-01", "2024-01-31"), lambda: C.breadth_complete(spark.createDataFrame([(D(2024, 1, 2), "flat_count")], "trade_date date, metric_id string")),
    ):
        with pytest.raises(C.CaptureError):
            f()
    assert rows(C.slices_full(b, ["trade_date"], "symbol", 2), "symbol") == [("A",), ("B",)]
    assert rows(unfinished_days(days(spark, D(2024, 1, 2), D(2024, 1, 3)), b, 2)) == [(D(2024, 1, 3),)]
    assert rows(unissued(spark, [("SH", 1, 4)], spark.createDataFrame([("000002.SH",)], "symbol string"))) == [("000001.SH",), ("000003.SH",)]


def test_audit_verify_tools_and_command_line(spark, tmp_path, capsys):
    lake = Lake(spark, str(tmp_path))
    lake.merge("trading_calendar", spark.createDataFrame([(D(2024, 1, n), n != 4, *P) for n in range(1, 8)], dataset("trading_calendar").schema))
    good = [bar("600001.SH", D(2024, 1, n)) for n in (1, 2, 4, 6)] + [bar("600002.SH", D(2024, 1, 6), -1.0)]
    spark.createDataFrame(good + good[:1], BARS).write.parquet(f"{tmp_path}/curated/daily_bars/trade_date=2024")
    found = {(r.dataset, r.check): r for r in audit(lake, ["daily_bars", "hot_rank", "adj_factors"]).toLocalIterator()}
    assert {("daily_bars", "pk_unique"), ("daily_bars", "bar_rules"), ("daily_bars", "daily_bars_calendar_orphan"), ("daily_bars", "daily_bars_calendar_missing_day"), ("adj_factors", "adj_factor_coverage"), ("hot_rank", "non_empty")} <= set(found)
    assert found["daily_bars", "pk_unique"].detail["keys"] == "1"
    cal = lake.scan("trading_calendar").where("is_trading").select("trade_date")
    kinds = {g["kind"]: g for g in verify(lake, "daily_bars", cal, D(2024, 1, 9))}
    assert kinds["interior"]["sessions"] == 2 and kinds["stale"]["since"] == D(2024, 1, 6) and verify(lake, "hot_rank", cal, D(2024, 1, 9)) == [{"dataset": "hot_rank", "kind": "empty"}]
    page = tools.query_bars(lake, ["600001.SH"], limit=2, offset=1)
    assert page["total"] == 4 and page["truncated"] and page["columns"]["trade_date"] == ["2024-01-02", "2024-01-04"] and page["sources"] == ["mock"] and "source" not in page["columns"]
    lake.views()
    assert tools.run_sql(lake, "select count(*) n from daily_bars")["columns"] == {"n": [5]}
    assert cli.main([str(tmp_path), "describe", "daily_bars"]) == 0 and json.loads(capsys.readouterr().out)["key"] == ["symbol", "trade_date"]
    assert cli.main([str(tmp_path), "repartition", "daily_bars", "--dry-run"]) == 0 and json.loads(capsys.readouterr().out)["rows"] == 5
    lake.stage("daily_bars", "r1", "b", spark.createDataFrame(good[:1], BARS))
    assert clean_staging(spark, str(tmp_path), {"r2"}) == 1 and lake.staged("daily_bars", "r1") is None
