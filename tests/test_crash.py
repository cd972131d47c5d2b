"""Writers that are lost at any step."""

from __future__ import annotations

import datetime as dt

import pytest

from lakeforge import locks, swaps
from lakeforge.lake import Lake
from lakeforge.registry import dataset
from lakeforge.sources import files
from tests.conftest import rows

BARS = dataset("daily_bars").schema


class Lost(RuntimeError):
    pass


def bar(symbol, day, close, n=0):
    return (symbol, day, close, close, close, close, 100, close * 100, "mock", "v2", dt.datetime(2024, 7, 1, 0, 0, n, tzinfo=dt.timezone.utc))


def first(spark):
    return spark.createDataFrame([bar(f"{i:06d}.SH", dt.date(2024, m, 3), 1.0) for m in (1, 2) for i in range(5)], BARS)


def second(spark):
    return spark.createDataFrame([bar(f"{i:06d}.SH", dt.date(2024, m, 3), 2.0, 9) for m in (1, 2) for i in range(4, 7)], BARS)


def want():
    return sorted((f"{i:06d}.SH", 2.0 if i >= 4 else 1.0) for m in (1, 2) for i in range(7))


@pytest.mark.parametrize("job", ["merge", "repartition", "flat"])
def test_a_crash_at_every_move_loses_nothing(spark, tmp_path, monkeypatch, job):
    move, delete = files.move, files.delete
    for step in range(12):
        lake = Lake(spark, f"{tmp_path}/{job}{step}")
        name = "daily_bars"
        if job == "flat":
            name = "instruments"
            frame = lambda n: spark.createDataFrame([(f"{i:06d}.SH", f"n{n}", "SH", "stock", None, None, None, "mock", "v1", dt.datetime(2024, 7, 1, 0, 0, n)) for i in range(n, n + 4)], dataset(name).schema)  # noqa: E731, B023
            lake.merge(name, frame(0))
            go = lambda: lake.merge(name, frame(2))  # noqa: E731, B023
        else:
            lake.merge(name, first(spark))
            go = (lambda: lake.merge("daily_bars", second(spark))) if job == "merge" else (lambda: lake.repartition("daily_bars"))  # noqa: E731, B023
        left = [step]

        def failing(f):
            def run(*a):
                if left[0] == 0:
                    raise Lost
                left[0] -= 1
                return f(*a)

            return run

        monkeypatch.setattr(files, "move", failing(move))
        monkeypatch.setattr(files, "delete", failing(delete))
        try:
            go()
            lost = False
        except Lost:
            lost = True
        monkeypatch.setattr(files, "move", move)
        monkeypatch.setattr(files, "delete", delete)
        seen = lake.load(name).count()  # what a reader sees of the interrupted swap: all of the old or more
        assert seen >= (4 if job == "flat" else 10)
        files.delete(spark, f"{lake.root}/meta/write.lock")
        go()
        if job == "merge":
            assert rows(lake.load(name), "symbol", "close") == want()
        else:
            assert lake.load(name).count() == (6 if job == "flat" else 10)
        assert not [e.name for e in files.entries(spark, lake.path(dataset(name))) if e.name.startswith("_")]
        if not lost:
            break
    else:
        raise AssertionError("the job has more steps than were tried")


def test_an_undecided_swap_leaves_the_old(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.merge("daily_bars", first(spark))
    root = lake.path(dataset("daily_bars"))
    second(spark).write.parquet(f"{swaps.new_staging(root)}/p_period=2024")
    assert lake.load("daily_bars").count() == 10
    lake.merge("daily_bars", second(spark))
    assert rows(lake.load("daily_bars"), "symbol", "close") == want()


def test_text_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t.json"
    files.write_text(spark, path, "old")
    fs, p = files._fs(spark, path)
    fs.rename(p, files._fs(spark, path + ".new")[1])  # lost after the old text was taken away
    assert files.read_text(spark, path) == "old"
    files.write_text(spark, path, "new")
    assert files.read_text(spark, path) == "new" and not files.exists(spark, path + ".new")


def test_lock_is_kept_fresh_and_never_deleted_by_another(spark, tmp_path):
    import time

    path = f"{tmp_path}/write.lock"
    with locks.writing(spark, path, stale_after=3, beat=0.5):
        time.sleep(4)
        with pytest.raises(locks.LockedError):
            with locks.writing(spark, path, stale_after=3):
                pass
        with locks.writing(spark, path, stale_after=-1):
            mine = files.read_text(spark, path)
        files.create_new(spark, path, "other")
    assert mine and files.read_text(spark, path) == "other"


def test_a_merge_waits_for_no_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with locks.writing(spark, f"{tmp_path}/meta/write.lock"):
        with pytest.raises(locks.LockedError):
            lake.merge("daily_bars", first(spark))


def test_files_of_conflicting_types_are_read_together(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    root = lake.path(dataset("daily_bars"))
    one = first(spark)
    one.coalesce(1).write.parquet(f"{root}/trade_date=2024")
    one.selectExpr("concat('9', substr(symbol, 2)) as symbol", "cast(trade_date as string) as trade_date", "open", "high", "low", "close", "cast(volume as double) as volume", "source", "data_version", "fetched_at").write.mode("append").parquet(f"{root}/trade_date=2025")
    got = lake.load("daily_bars")
    assert got.schema == one.schema and got.count() == 20 and got.where("amount is null").count() == 10 and got.where("volume = 100").count() == 20
    assert lake.scan_files("daily_bars", files.leaf_files(spark, f"{root}/trade_date=2024"), traded_only=True).count() == 10


def test_a_faulty_row_fails_the_read_unless_out_of_scope(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    bad = spark.createDataFrame([bar("600001.SH", dt.date(2024, 1, 3), 1.0), bar("999999.SH", dt.date(2024, 1, 3), -1.0)], BARS)
    bad.write.parquet(f"{lake.path(dataset('daily_bars'))}/trade_date=2024-01-03")
    with pytest.raises(Exception, match="bar"):
        lake.load("daily_bars").count()
    inst = [("600001.SH", "n", "SH", "stock", None, None, None, "mock", "v1", dt.datetime(2024, 7, 1))]
    lake.merge("instruments", spark.createDataFrame(inst, dataset("instruments").schema))
    assert lake.load("daily_bars", universe="all_a").count() == 1


def test_coverage_reads_names_or_the_outer_periods(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.merge("daily_bars", first(spark))
    assert lake.coverage("daily_bars") == (dt.date(2024, 1, 3), dt.date(2024, 2, 3)) and lake.coverage("hot_rank") == (None, None)
    p = ("mock", "v1", dt.datetime(2024, 7, 1))
    lake.merge("trading_status", spark.createDataFrame([("A", dt.date(2024, 1, 3), True, "normal", *p), ("A", dt.date(2024, 3, 4), True, "*ST", *p)], dataset("trading_status").schema))
    assert lake.coverage("trading_status") == (dt.date(2024, 1, 3), dt.date(2024, 3, 4)) and lake.st_coverage_start() == dt.date(2024, 3, 4)
    lake.replace_days("daily_bars", spark.createDataFrame([bar("000000.SH", dt.date(2024, 1, 3), 7.0)], BARS))
    assert rows(lake.load("daily_bars", end="2024-01-31"), "symbol", "close") == [("000000.SH", 7.0)] and lake.load("daily_bars").count() == 6
