from __future__ import annotations

import datetime as dt

from lakeforge.operators.compaction import carry_out, compact, merge_levels, merged_rows, numbered
from tests.conftest import rows

UNIT, KEY = ["symbol", "trade_date"], ["tick_seq"]
DAY = dt.date(2024, 1, 2)
TICKS = "symbol string, trade_date date, tick_seq int, price double, fetched_at timestamp, file_id bigint"
FILES = "file_id bigint, dataset string, file_path string, n_rows bigint, n_bytes bigint, written_at timestamp"


def at(n):
    return dt.datetime(2024, 1, 2, 0, 0, n)


def files(spark, n, labels=("2024-01-02", "2024-01", "2024Q1", "2024")):
    return spark.createDataFrame([(i, "trade_ticks", f"curated/trade_ticks/trade_date={labels[i % len(labels)]}/part-{i}.parquet", 2, 1000 * (i % 3 + 1), at(1)) for i in range(n)], FILES)


def test_each_tick_once_and_counts(spark):
    ticks = [("A.SH", DAY, s, 1.0 * f, at(f % 60), f) for f in range(70) for s in (f // 2, f // 2 + 1)] + [("B.SH", DAY, 0, 1.0, at(1), 0)]
    units, journal, newest = compact(spark.createDataFrame(ticks, TICKS), files(spark, 70), UNIT, KEY, fan_in=4)
    got = {r.symbol: r for r in units.toLocalIterator()}
    assert (got["A.SH"].files_before, got["A.SH"].partitions_before, got["A.SH"].rows_after) == (70, 4, 36)
    assert got["B.SH"].files_before == 1 and max(r.n_files for r in journal.toLocalIterator()) == 70
    assert newest.where("symbol = 'A.SH'").count() == 36
    levels = [r.level for r in journal.toLocalIterator()]
    assert max(levels) >= 2 and all(len(r.inputs) <= 4 for r in journal.toLocalIterator())


def test_journal_is_idempotent_and_consumes_each_run_once(spark):
    runs = spark.createDataFrame([("A", str(i), 1, 1000 * 4 ** (i % 4), 1) for i in range(60)], "u string, run_id string, n_rows bigint, n_bytes bigint, n_files bigint")
    final, journal = merge_levels(runs, ["u"], fan_in=4)
    again = merge_levels(runs, ["u"], fan_in=4)[1]
    assert rows(journal, "level", "run_id") == rows(again, "level", "run_id")
    used = [i for r in journal.toLocalIterator() for i in r.inputs]
    assert len(used) == len(set(used)) and {str(i) for i in range(60)} <= set(used)
    assert final.count() == 1 and final.first().n_files == 60


def test_hot_units_are_numbered_by_blocks(spark):
    data = [("A", str(i), 1, 100 + 50 * (i % 9), 1) for i in range(300)] + [(None, "x", 1, 0, 1), (None, "y", 1, 7, 1)]
    runs = spark.createDataFrame(data, "u string, run_id string, n_rows bigint, n_bytes bigint, n_files bigint")
    at = [(r.u, r.at, r.n_bytes) for r in numbered(runs, ["u"]).toLocalIterator()]
    assert sorted(x[1] for x in at if x[0] == "A") == list(range(300)) and sorted(x[1] for x in at if x[0] is None) == [0, 1]
    by_place = [b for _, _, b in sorted(x for x in at if x[0] == "A")]
    assert all(b < 1.2 * a for a, b in zip(by_place[1:], by_place))  # like sizes together
    final, _ = merge_levels(runs, ["u"], fan_in=8)
    assert {(r.u, r.n_files) for r in final.toLocalIterator()} == {("A", 300), (None, 2)}


def brute_levels(runs, fan_in, base):
    """The merges of one unit's runs {name: (rows, bytes, files)} in plain loops; ``at`` comes from the operator's order."""
    import hashlib
    import math

    tier = lambda b: 0 if b <= base else math.floor(math.log(b / base, fan_in)) + 1
    journal, level, last = [], 0, max(tier(b) for _, b, _ in runs.values())
    while len(runs) > 1:
        due = [r for r in runs if tier(runs[r][1]) <= level]
        order = yield due, runs
        new = {}
        for s in range(0, len(order), fan_in):
            group = sorted(order[s : s + fan_in])
            name = group[0] if len(group) == 1 else hashlib.sha256(",".join(group).encode()).hexdigest()
            new[name] = tuple(sum(runs[g][k] for g in group) for k in range(3))
            if len(group) > 1:
                journal.append((level, name, len(group), *new[name]))
        runs = new | {r: v for r, v in runs.items() if r not in due}
        level += 1
        if level > last + 20:
            raise AssertionError("no end")
    return journal


def test_journal_equals_brute_force(spark):
    runs = {str(i): (1 + i % 3, 900 * 4 ** (i % 4) + i, 1) for i in range(47)}
    schema = "u string, run_id string, n_rows bigint, n_bytes bigint, n_files bigint"
    _, journal = merge_levels(spark.createDataFrame([("A", r, *v) for r, v in runs.items()], schema), ["u"], fan_in=4, base_bytes=1000)
    game = brute_levels(dict(runs), 4, 1000)
    try:
        due, now = next(game)
        while True:
            placed = numbered(spark.createDataFrame([("A", r, *now[r]) for r in due], schema), ["u"]).orderBy("at") if due else None
            due, now = game.send([r.run_id for r in placed.toLocalIterator()] if due else [])
    except StopIteration as end:
        want = end.value
    assert rows(journal.selectExpr("level", "run_id", "size(inputs) as inputs", "n_rows", "n_bytes", "n_files")) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_nulls_empty_and_extra_columns(spark):
    ticks = [(None, None, 1, 1.0, at(1), 0), (None, None, 1, 2.0, at(2), 1), ("A.SH", DAY, None, 1.0, None, 1)]
    df = spark.createDataFrame(ticks, TICKS)
    units, _, newest = compact(df.selectExpr("*", "1 as n", "2 as run_id", "3 as level"), files(spark, 2), UNIT, KEY)
    assert sorted((r.symbol or "", r.files_before, r.rows_after) for r in units.toLocalIterator()) == [("", 2, 1), ("A.SH", 1, 1)]
    assert newest.where("symbol is null").first().price == 2.0
    units, journal, newest = compact(df.limit(0), files(spark, 2), UNIT, KEY)
    assert units.count() == journal.count() == newest.count() == 0


def test_latest_fetch_wins(spark):
    df = spark.createDataFrame([("A", DAY, 0, 1.0, at(1), 0), ("A", DAY, 0, 2.0, at(3), 1), ("A", DAY, 0, 3.0, at(2), 2)], TICKS)
    assert merged_rows(df, UNIT, KEY).first().price == 2.0


def test_long_sessions_are_cut_and_packed_by_size(spark, tmp_path):
    import glob

    from pyspark.sql import functions as F

    ticks = [("A.SH", DAY, s, 1.0, at(f), f) for s in range(400) for f in (s % 5, 5)] + [("A.SH", DAY, None, 1.0, at(1), 1)]
    run = lambda: carry_out(spark.createDataFrame(ticks, TICKS), files(spark, 6), UNIT, KEY, f"file://{tmp_path}/s", F.date_format("trade_date", "yyyy-MM"), target_bytes=60_000, block=F.shiftright("tick_seq", 4))
    done = run()
    assert done.units.first().rows_after == 401 and done.units.first().files_before == 6 and done.rows.count() == 401
    packed = done.packed.first()
    assert packed.files_after == len(glob.glob(f"{tmp_path}/s/data/*/*.parquet")) > 4 and packed.rows_after == 401 and packed.sessions == 1


def test_runs_are_written_and_finished_ones_stay(spark, tmp_path):
    import glob
    import os
    import shutil

    from pyspark.sql import functions as F

    ticks = [("A.SH", dt.date(2024, m, 2), s, 1.0 * f, at(f), f) for m in (1, 2) for f in range(6) for s in (f // 2, f // 2 + 1)]
    store = str(tmp_path / "store")
    run = lambda data: carry_out(spark.createDataFrame(data, TICKS), files(spark, 7), UNIT, KEY, f"file://{store}", F.date_format("trade_date", "yyyy-MM"))
    parts = lambda: {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{store}/data/*/*.parquet")}
    done, first = run(ticks), parts()
    assert len(first) == 2 and rows(done.packed, "period", "files_before", "rows_before", "files_after", "rows_after") == [("2024-01", 6, 12, 1, 4), ("2024-02", 6, 12, 1, 4)]
    assert spark.read.parquet(*first).where("tick_seq = 3").select("price").distinct().first().price == 5.0
    assert done.journal.count() == 2 and run(ticks).rows.count() == 8 and parts() == first
    more = run([*ticks, ("A.SH", dt.date(2024, 2, 2), 9, 1.0, at(9), 6)])  # only February is written
    assert len(parts()) == 3 and first.items() <= parts().items() and more.rows.count() == 9
    shutil.rmtree(f"{store}/finished")  # as if interrupted before the names were noted
    assert run(ticks).rows.count() == 8 and len(parts()) == 3


def test_crowded_units_are_folded_first(spark, monkeypatch):
    import lakeforge.operators.compaction as M

    ticks = [("A.SH", DAY, 7, 1.0, at(i % 60), i % 3) for i in range(300)] + [("B.SH", DAY, s, 1.0, at(1), 0) for s in range(5)]
    plain = rows(compact(spark.createDataFrame(ticks, TICKS), files(spark, 3), UNIT, KEY)[2])
    monkeypatch.setattr(M, "CROWDED_ROWS", 50)
    units, _, newest = compact(spark.createDataFrame(ticks, TICKS), files(spark, 3), UNIT, KEY)
    assert rows(newest) == plain and sorted((r.symbol, r.rows_after) for r in units.toLocalIterator()) == [("A.SH", 1), ("B.SH", 5)]
