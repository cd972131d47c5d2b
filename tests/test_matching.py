from __future__ import annotations

import datetime as dt
import random

import duckdb
import pandas as pd

from pyspark.sql import functions as F

from lakeforge.operators.asof import forward_fill, lag_in_blocks, last_known
from lakeforge.operators.attributes import fact_history, known_attributes, membership_history, unpivot_known
from lakeforge.operators.best import best_values
from lakeforge.operators.history import snapshot_readings, versions
from tests.conftest import rows

D = dt.date


def day(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


def test_last_known_against_brute_force(spark):
    rnd = random.Random(4)
    e = [(rnd.choice("AB"), day(rnd.randrange(40))) for _ in range(60)]
    h = [(rnd.choice("ABC"), day(rnd.randrange(40)), rnd.randrange(9)) for _ in range(50)]
    got = last_known(spark.createDataFrame(e, "k string, d date"), spark.createDataFrame(h, "k string, t date, v int"), ["k"], "d", "t", F.col("v"))
    want = sorted((k, d, max((v for k2, t, v in h if k2 == k and t <= d), default=None)) for k, d in set(e))
    assert sorted(map(tuple, got.select("k", "d", "known").toLocalIterator()), key=str) == sorted(want, key=str)


def test_forward_fill_equals_asof_join(spark):
    rnd = random.Random(7)
    e = pd.DataFrame([(rnd.choice("AB"), day(rnd.randrange(40)), i) for i in range(80)], columns=["k", "d", "i"])
    h = pd.DataFrame([("A", day(3), 1.0), ("A", day(20), None), ("B", day(10), 5.0)], columns=["k", "t", "v"])
    got = forward_fill(spark.createDataFrame(e, "k string, d date, i int"), spark.createDataFrame([tuple(None if x != x else x for x in r) for r in h.itertuples(index=False)], "k string, t date, v double"), ["k"], "d", "t", ["v"])
    want = duckdb.sql("select e.k, e.d, e.i, h.v from e asof left join h on e.k = h.k and e.d >= h.t order by i").fetchall()
    assert [(r.i, r.v) for r in got.orderBy("i").toLocalIterator()] == [(i, v if v == v else None) for _, _, i, v in want]


def test_lag_in_blocks_equals_lag(spark):
    rnd = random.Random(9)
    data = [(rnd.choice("AB"), day(n)) for n in rnd.sample(range(300), 120)]
    df = spark.createDataFrame(data, "k string, d date").withColumn("v", F.col("d"))
    got = rows(lag_in_blocks(df, ["k"], F.trunc("d", "month"), ["d"], "v", "p"), "k", "d", "p")
    want = []
    for k in "AB":
        days = sorted(d for x, d in data if x == k)
        want += [(k, d, p) for d, p in zip(days, [None, *days])]
    assert sorted(got, key=str) == sorted(want, key=str)


ITEMS = "symbol string, report_period string, item_code string, item_value double, announce_date date"
MEMBERS = "symbol string, classification_system string, industry_code string, as_of_date date"
EVENTS = "symbol string, trade_date date, reason string"


def attributes(spark, events, items, members):
    histories = {"facts": (fact_history(spark.createDataFrame(items, ITEMS)), True), "members": (membership_history(spark.createDataFrame(members, MEMBERS)), False)}
    return known_attributes(spark.createDataFrame(events, EVENTS), histories, ["symbol", "trade_date", "reason"])


def test_attributes_are_those_known_at_the_time(spark):
    items = [
        ("A", "2023Q3", "rev", 1.0, day(0)), ("A", "2023Q4", "rev", 2.0, day(10)), ("A", "2023Q3", "rev", 3.0, day(12)),  # an older period restated later stays older
        ("A", "2024Q1", "rev", 4.0, day(30)), ("A", "2024Q2", "rev", 5.0, None), ("A", "2024Q3", "rev", 5.0, D(1900, 1, 1)), ("A", "2023Q4", "roe", 1.0, day(20)), ("A", "2023Q4", "rev", 2.5, day(14)),
    ]
    members = [("A", "sw", "11", day(5)), ("A", "sw", "12", day(15)), ("B", "sw", "99", day(1)), ("A", "em", "7", None)]
    events = [("A", day(13), "r"), ("A", day(13), "r"), ("A", day(13), "s"), ("A", day(25), "r"), ("C", day(25), "r"), ("A", None, "r")]
    got = unpivot_known(attributes(spark, events, items, members), ["symbol", "trade_date", "reason"])
    want = [("A", day(13), x, "rev", "2023Q4", day(10)) for x in "rs"] + [("A", day(13), x, "sw", "11", day(5)) for x in "rs"]
    want += [("A", day(25), "r", "rev", "2023Q4", day(14)), ("A", day(25), "r", "roe", "2023Q4", day(20)), ("A", day(25), "r", "sw", "12", day(15))]
    assert sorted(rows(got), key=str) == sorted(want, key=str)


def test_events_without_attributes_keep_an_empty_map(spark):
    got = attributes(spark, [("A", day(1), "r"), (None, day(1), "r")], [("A", "2024Q1", "rev", 1.0, day(9))], [("A", "sw", "1", day(2))])
    assert sorted(len(r.known) for r in got.toLocalIterator()) == [0, 0]
    assert attributes(spark, [], [("A", "2024Q1", "rev", 1.0, day(9))], []).count() == 0


TRUST = [("good", 1), ("fair", 2), ("poor", 3)]
STATUS = "symbol string, trade_date date, status string, source string, data_version string, fetched_at timestamp"


def at(n):
    return dt.datetime(2024, 2, 1, 0, 0, n)


def test_best_values(spark):
    data = [
        ("A", day(1), "x", "poor", "v2", at(1)), ("A", day(1), "y", "good", "v1", at(9)), ("A", day(1), None, "good", "v10", at(9)),
        ("B", day(1), "x", "fair", "v1", at(9)), ("B", day(1), "y", "good", "v1", at(1)), ("B", day(1), "z", "good", "v1", at(2)),
        ("C", day(1), None, None, None, None), ("D", day(1), "x", "good", "v1", at(1)), (None, None, "q", "odd", None, None), (None, None, "q", "odd", None, None),
    ]
    df = spark.createDataFrame(data, STATUS)
    got = best_values(df.selectExpr("*", "1 as n_extra", "2 as trust_rank"), ["symbol", "trade_date"], "status", spark.createDataFrame(TRUST, "source string, trust_rank int"))
    assert rows(got, "symbol", "status") == [("A", "x"), ("B", "z"), ("D", "x"), (None, "q")]


def test_history_versions(spark):
    data = [("A", day(n), s, "good", "v1", at(1)) for n, s in ((1, "Normal "), (2, "normal"), (4, "ST"), (5, None), (6, "st"), (9, "normal"))]
    data += [("A", day(2), "st", "poor", "v1", at(5)), ("B", day(3), " ", "good", "v1", at(1)), (None, day(1), "x", "good", "v1", at(1)), ("C", None, "x", "good", "v1", at(1))]
    df = spark.createDataFrame(data + data[:3], STATUS)
    readings = snapshot_readings(df, "symbol", "trade_date", "status", spark.createDataFrame(TRUST, "source string, trust_rank int"))
    assert rows(versions(readings, "symbol", "trade_date", ["status"])) == [("A", "normal", day(1), day(4)), ("A", "normal", day(9), None), ("A", "st", day(4), day(9))]
    assert versions(readings.limit(0), "symbol", "trade_date", ["status"]).count() == 0
