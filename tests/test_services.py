from __future__ import annotations

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from lakeforge import __main__ as cli
from lakeforge import tools
from lakeforge.functions.columns import price_divisor, session_final, symbol_of, tone
from lakeforge.functions.joins import possible
from lakeforge.functions.register import register
from lakeforge.lake import Lake
from lakeforge.operators import backfill as B
from lakeforge.operators.asof import running_in_blocks
from lakeforge.operators.groups import latest_intervals, stabbed_intervals
from lakeforge.quality import checks as Q
from lakeforge.quality import recon as C
from lakeforge.quality.capture import CaptureError, session_over
from lakeforge.registry import dataset
from lakeforge.serve import answer
from lakeforge.sources.adapters import session_calendar, sessions_after
from lakeforge.sources.files import partition_containing, partitions
from lakeforge.sources.files import entries as listed
from lakeforge.stats import Stats
from lakeforge.streaming.progress import watch
from tests.conftest import rows

D = dt.date
P = ("mock", "v1", dt.datetime(2024, 7, 1))


def days(spark, *ds):
    return spark.createDataFrame([(d,) for d in ds], "trade_date date")


@pytest.fixture
def lake(spark, tmp_path):
    lk = Lake(spark, str(tmp_path / "lake"))
    bars = [(s, D(2024, m, 3), 1.0, 1.0, 1.0, 1.0, 100, 100.0, src, "v1", dt.datetime(2024, 7, 1)) for m in (1, 2) for s, src in (("600001.SH", "a"), ("600002.SH", "b"))]
    lk.merge("daily_bars", spark.createDataFrame(bars, dataset("daily_bars").schema))
    lk.merge("instruments", spark.createDataFrame([("600001.SH", "Alpha", "SH", "stock", None, None, None, *P)], dataset("instruments").schema))
    return lk


def test_stored_statistics_follow_the_files(lake, spark):
    stats = Stats(lake)
    assert set(stats.stale()) == {"daily_bars", "instruments"} and set(stats.rebuild()) == {"daily_bars", "instruments"} and stats.stale() == []
    assert rows(stats.partitions().where("dataset = 'daily_bars'"), "partition", "n_rows", "symbols") == [("2024-01-03", 2, 2), ("2024-02-03", 2, 2)]
    assert rows(stats.provenance_of_periods("daily_bars"), "source", "n_rows", "share") == [("a", 1, 0.5)] * 2 + [("b", 1, 0.5)] * 2
    more = [("600003.SH", D(2025, 1, 3), 1.0, 1.0, 1.0, 1.0, 100, 100.0, "a", "v1", dt.datetime(2025, 7, 1))]
    lake.merge("daily_bars", spark.createDataFrame(more, dataset("daily_bars").schema))
    assert stats.rebuild() == ["daily_bars"] and stats.partitions().count() == 4 and stats.partitions().where("n_files > 0 and n_bytes > 0").count() == 4


def test_answers(lake):
    Stats(lake).rebuild()
    ok = lambda t: (lambda s, b: (s == 200 or pytest.fail(f"{t}: {s} {b}")) and json.loads(json.dumps(b, default=str)))(*answer(lake, t, D(2024, 2, 3)))
    assert ok("/api/health")["counts"]["fresh"] >= 1 and len(ok("/api/datasets")) == 42 and ok("/api/tiers")
    assert ok("/api/datasets/daily_bars")["key"] == ["symbol", "trade_date"] and ok("/api/datasets/daily_bars/dates")["values"] == ["2024-02-03", "2024-01-03"]
    assert ok("/api/datasets/daily_bars/partitions")[0]["n_rows"] == 2 and len(ok("/api/datasets/daily_bars/provenance")) == 4
    assert ok("/api/datasets/daily_bars/rows?period=2024-01&symbol=600001.SH")["total"] == 1 and ok("/api/datasets/daily_bars/rows?limit=3")["rows"] == 3
    assert ok("/api/runs") == [] and isinstance(ok("/api/quality?datasets=daily_bars"), list) and ok("/api/heatmap?symbols=600001.SH") == []
    assert answer(lake, "/api/datasets/none")[0] == 404 and answer(lake, "/api/datasets/daily_bars/rows?period=x")[0] == 400 and answer(lake, "/other")[0] == 404 and answer(lake, "/api/runs/none")[0] == 404


def test_commands(lake, capsys):
    for args in (["health"], ["dates", "daily_bars"], ["coverage", "daily_bars"], ["rows", "daily_bars", "2024-02"], ["symbol", "Alpha"], ["stats"], ["due", "daily_bars", "--start", "2024-01-01", "--end", "2024-02-01"], ["clean"], ["stale"]):
        assert cli.main([lake.root, *args]) == 0
        json.loads(capsys.readouterr().out)
    assert tools.gap_meaning("daily_bars") == "fault" and tools.gap_meaning("hot_rank") == "cadence"


def test_progress_is_kept(spark, tmp_path):
    seen = watch(spark)
    spark.range(5).write.parquet(f"{tmp_path}/in")
    q = spark.readStream.schema("id bigint").parquet(f"{tmp_path}/in").writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    for _ in range(100):  # events come after the query has ended
        if "done" in seen.ended.values():
            break
        time.sleep(0.2)
    spark.streams.removeListener(seen)
    assert seen.frame(spark).agg(F.sum("n_rows")).first()[0] == 5 and "done" in seen.ended.values()


def test_calendar_of_seed_and_bars(spark):
    seed = spark.createDataFrame([(D(2024, 1, 8), True), (D(2024, 1, 9), False)], "trade_date date, is_trading boolean")
    bars = days(spark, D(2024, 1, 4), D(2024, 1, 10), D(2024, 1, 12))
    cal = {r.trade_date.day: r.is_trading for r in session_calendar(spark, D(2024, 1, 1), D(2024, 1, 12), seed, bars).toLocalIterator()}
    assert cal == {1: True, 2: True, 3: True, 4: True, 5: False, 6: False, 7: False, 8: True, 9: False, 10: True, 11: False, 12: True}
    with pytest.raises(ValueError):
        session_calendar(spark, D(2024, 1, 1), D(2024, 1, 13), seed, bars)
    frame = spark.createDataFrame([(D(2024, 1, n), True) for n in range(1, 9)], "trade_date date, is_trading boolean")
    assert sessions_after(frame, D(2024, 1, 5), D(2024, 1, 7)).count() == 2 and sessions_after(frame, None, D(2024, 1, 7)).count() == 6


def test_session_finality(spark):
    df = spark.createDataFrame([(D(2024, 1, 2), dt.datetime(2024, 1, 2, 7, 0)), (D(2024, 1, 2), dt.datetime(2024, 1, 2, 7, 30)), (D(2024, 1, 1), dt.datetime(2024, 1, 2, 1, 0))], "d date, t timestamp")
    assert [r[0] for r in df.select(session_final("d", "t")).toLocalIterator()] == [False, True, True]
    session_over("2024-01-02", "2024-01-02 09:00:00", days(spark, D(2024, 1, 2)))
    session_over("2024-01-02", "2024-01-02 05:00:00", days(spark, D(2024, 1, 3)))
    with pytest.raises(CaptureError):
        session_over("2024-01-02", "2024-01-02 05:00:00", days(spark, D(2024, 1, 2)))


def test_symbols_divisors_and_sql_functions(spark):
    df = spark.createDataFrame([("1",), ("600001",), ("830001",)], "c string")
    assert [r[0] for r in df.select(symbol_of("c")).toLocalIterator()] == ["000001.SZ", "600001.SH", "830001.BJ"]
    codes = spark.createDataFrame([("510300.SH",), ("113001.SH",), ("600001.SH",), ("999999.SH",)], "s string")
    assert [r[0] for r in codes.select(price_divisor("s")).toLocalIterator()] == [1000, 10000, 100, None]
    assert spark.range(1).select(tone(F.lit(0.75))).first()[0] == 0.5
    assert "canonical_symbol" in register(spark) and spark.sql("select canonical_symbol(' sz000001'), quarter_of(date'2024-05-01'), relative_gap(1, 2)").first() == ("000001.SZ", "2024Q2", 0.5)


def test_intervals_against_brute_force(spark):
    rnd = random.Random(3)
    day = lambda n: D(2024, 1, 1) + dt.timedelta(days=n)
    spans = [(rnd.choice("ABC"), day(a := rnd.randrange(60)), None if rnd.random() < 0.2 else day(a + rnd.randrange(20)), i) for i in range(60)] + [("A", None, day(3), 99)]
    as_of = [day(rnd.randrange(-5, 90)) for _ in range(15)] + [None]
    dates = spark.createDataFrame([(x,) for x in as_of], "as_of_date date")
    got = rows(stabbed_intervals(spark.createDataFrame(spans, "symbol string, start_date date, end_date date, i int"), dates), "symbol", "i", "as_of_date")
    want = {(s, i, x) for s, a, z, i in spans for x in as_of if x and a and a <= x and (z is None or x < z)}
    assert set(got) == want and len(got) == len(want)
    starts = spark.createDataFrame([(s, a, i) for s, a, _, i in spans], "symbol string, start_date date, i int")
    best = {}
    for s, a, _, i in spans:
        for x in as_of:
            if x and a and a <= x:
                best[s, x] = max(best.get((s, x), (a, i)), (a, i))
    assert set(rows(latest_intervals(starts, dates), "symbol", "as_of_date", "start_date", "i")) == {(s, x, *v) for (s, x), v in best.items()}


def test_running_folds_in_blocks(spark):
    rnd = random.Random(6)
    data = [(rnd.choice("AB"), D(2024, 1, 1) + dt.timedelta(days=n), rnd.choice([1, 2, 4, None])) for n in rnd.sample(range(200), 80)]
    df = spark.createDataFrame(data, "k string, d date, v bigint")
    got = {(r.k, r.d): (r.m, r.b) for r in running_in_blocks(running_in_blocks(df, ["k"], F.trunc("d", "month"), ["d"], F.col("v"), F.max, "m"), ["k"], F.trunc("d", "month"), ["d"], F.col("v"), F.bit_or, "b").toLocalIterator()}
    for k, d, _ in data:
        seen = [v for k2, d2, v in data if k2 == k and d2 <= d and v is not None]
        bits = 0
        for v in seen:
            bits |= v
        assert got[k, d] == (max(seen, default=None), bits if seen else None)


def test_possible_keeps_every_key(spark):
    df = spark.range(2000).withColumn("k", F.when(F.col("id") % 7 > 0, F.col("id") % 50))
    keys = spark.createDataFrame([(3,), (None,)], "k bigint")
    some, rest = possible(df, keys, ["k"], 1 << 10), possible(df, keys, ["k"], 1 << 10, others=True)
    assert some.count() + rest.count() == 2000 and some.where("k = 3 or k is null").count() == df.where("k = 3 or k is null").count() and some.count() < 600


def test_elapsed_share_and_mutation(spark):
    as_of = F.lit(D(2024, 2, 10))
    p = spark.createDataFrame([("2024-02",), ("2024Q1",), ("2024",), ("2024-02-10",), ("2023-12",), ("2025",), ("odd",), (None,)], "p string")
    got = [r[0] for r in p.select(Q.elapsed_share(F.col("p"), as_of)).toLocalIterator()]
    assert got == [pytest.approx(x) for x in (10 / 29, 41 / 91, 41 / 366, 1.0, 1.0, 1.0, 1.0, 1.0)]
    data = [(f"S{i}", D(2024, 1, 3)) for i in range(100)] + [(f"S{i}", D(2024, 2, 3)) for i in range(30)]
    df = spark.createDataFrame(data, "symbol string, trade_date date")
    month = F.date_format("trade_date", "yyyy-MM")
    assert Q.row_mutations(df, month, as_of).count() == 0 and Q.row_mutations(df, month, F.lit(D(2024, 3, 1))).count() == 1


def test_backfill_planning(spark):
    cal = days(spark, *(D(2024, 1, n) for n in range(1, 11)))
    due = B.due_days(cal, days(spark, D(2024, 1, 2)), "2024-01-01", "2024-01-05", flush=3)
    assert rows(due) == [(D(2024, 1, 1), 0), (D(2024, 1, 3), 0), (D(2024, 1, 4), 0), (D(2024, 1, 5), 1)]
    inst = spark.createDataFrame([("A", None, None), ("B", D(2025, 1, 1), None), ("C", None, D(2023, 1, 1)), ("E", None, D(2024, 1, 3))], "symbol string, list_date date, delist_date date")
    universe = spark.createDataFrame([(x,) for x in "ABCDE"], "symbol string")
    have = spark.createDataFrame([("A", D(2024, 1, 5), 1.0), ("D", D(2024, 1, 4), 1.0), ("E", D(2024, 1, 3), None)], "symbol string, trade_date date, v double")
    assert rows(B.symbols_to_backfill(universe, inst, have, ["v"], "2024-01-01", "2024-01-05"), "symbol") == [("D",), ("E",)]
    assert rows(B.ownership(universe, inst, "2024-01-01", "2024-01-05")) == [("A", "generic"), ("B", "expected_no_data"), ("C", "expected_no_data"), ("D", "generic"), ("E", "delegated_delisted")]
    assert B.due_days(cal.limit(0), cal, "2024-01-01", "2024-01-05").count() == 0


def test_structure_and_names_explain(spark):
    v = spark.createDataFrame([("A", D(2024, 1, 2)), ("B", D(2024, 1, 2)), ("C", D(2024, 1, 2))], "symbol string, trade_date date")
    s = spark.createDataFrame([("A", D(2024, 1, 2), "公司缩股方案"), ("A", D(2024, 1, 2), "减资"), ("C", D(2024, 1, 2), None)], "symbol string, change_date date, change_reason string")
    i = spark.createDataFrame([("B", "*S T x", "stock", D(2024, 2, 1)), ("C", "best", "etf", None)], "symbol string, name string, asset_type string, delist_date date")
    assert rows(C.unexplained(v, s, i), "symbol", "bucket") == [("A", "share_structure"), ("B", "delisted"), ("C", "active")]
    assert rows(C.st_by_name(i)) == [("B",)]


def test_partition_lookups(spark, tmp_path):
    for n in ("2024", "2024-02", "2024-02-10", "junk"):
        (tmp_path / f"d={n}").mkdir()
    found = partitions(listed(spark, str(tmp_path)), "d")
    assert [p.value for p, _ in found] == ["2024", "2024-02", "2024-02-10"] and partition_containing(found, D(2024, 2, 10))[0].value == "2024-02-10"
    assert partition_containing(found, D(2024, 2, 11))[0].value == "2024-02" and partition_containing(found, D(2023, 1, 1)) is None
