from __future__ import annotations

import datetime as dt

from lakeforge.operators import groups as G
from lakeforge.operators import returns as S
from lakeforge.operators import storage as T
from lakeforge.quality import checks as Q
from tests.conftest import rows

D = dt.date


def d(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


BAR = "symbol string, trade_date date, close double, volume bigint, amount double"


def test_returns_skip_missed_sessions(spark):
    b = spark.createDataFrame([("A", d(0), 10.0, 1, 1.0), ("A", d(1), 11.0, 1, 1.0), ("A", d(3), 22.0, 1, 1.0), ("B", d(0), 0.0, 1, 1.0), ("B", d(1), 5.0, 1, 1.0)], BAR)
    cal = spark.createDataFrame([(d(n),) for n in range(4)], "trade_date date")
    got = {(r.symbol, r.trade_date): r.ret for r in S.returns(b, "close", cal).toLocalIterator()}
    assert abs(got["A", d(1)] - 0.1) < 1e-12 and got["A", d(3)] is None and got["B", d(1)] is None


def test_resample_counts_along_the_session(spark):
    t = lambda h, m: dt.datetime(2024, 1, 2, h, m)
    ends = [t(9, 30) + dt.timedelta(minutes=5 * i) for i in range(1, 25)] + [t(13, 0) + dt.timedelta(minutes=5 * i) for i in range(1, 25)]
    m = spark.createDataFrame([("A", d(1), x, 1.0, 2.0, 0.5, float(i), 1, 1.0) for i, x in enumerate(ends)], "symbol string, trade_date date, bar_time timestamp_ntz, open double, high double, low double, close double, volume bigint, amount double")
    assert [S.resample(m, k).count() for k in (15, 30, 60)] == [16, 8, 4]
    assert rows(S.resample(m, 60), "bucket", "bar_time")[1] == (2, t(11, 30))


def test_industry_index(spark):
    members = spark.createDataFrame([("A", "240301", D(2024, 1, 2)), ("A", "270101", D(2024, 1, 4)), ("B", "240302", D(2024, 1, 2))], "symbol string, industry_code string, as_of_date date")
    days = spark.createDataFrame([(s, d(n)) for s in "AB" for n in range(5)], "symbol string, trade_date date")
    known = G.members_on(days, members)
    assert rows(known.where("symbol = 'A'"), "trade_date", "industry_code") == [(d(1), "240301"), (d(2), "240301"), (d(3), "270101"), (d(4), "270101")]
    priced = spark.createDataFrame([("A", d(1), 0.1, 300.0), ("B", d(1), 0.3, 100.0), ("A", d(2), 0.2, 5.9e-39), ("B", d(2), None, 5.0)], "symbol string, trade_date date, ret double, amount double")
    x = {(r.trade_date, r.level, r.industry_code, r.weighting): r for r in G.industry_index(priced, known.select("symbol", "trade_date", "industry_code")).toLocalIterator()}
    one = x[d(1), "L1", "24", "equal"]
    assert abs(one.ret - 0.2) < 1e-12 and abs(x[d(1), "L1", "24", "amount"].ret - 0.15) < 1e-12 and one.n_members == 2
    two = x[d(2), "L1", "24", "equal"]
    assert abs(two.ret - 0.2) < 1e-12 and (two.n_priced, two.n_excluded) == (1, 1) and x[d(2), "L1", "24", "amount"].ret is None
    assert x[d(4), "L2", "2701", "equal"].n_priced == 0


def test_breadth(spark):
    b = spark.createDataFrame([(s, d(n), c, v, 1.0) for s, cs in (("A", (10, 11)), ("B", (10, 9)), ("C", (10, 10)), ("D", (0, 5)), ("E", (10, 10))) for n, c, v in zip((0, 1), map(float, cs), (1, 0 if s == "E" else 1))], BAR)
    m = G.breadth(b, b.select("trade_date"), 0.095)
    got = {r.metric_id: r.value for r in m.toLocalIterator()}
    assert got == {"advance_count": 1, "decline_count": 1, "flat_count": 1, "limit_up_count": 1, "limit_down_count": 1, "advance_ratio": 1 / 3, "total_count": 3}
    assert Q.breadth_findings(m).count() == 0
    assert rows(Q.breadth_findings(m.where("metric_id <> 'flat_count'")), "check") == [("market_breadth_incomplete",)]
    assert rows(Q.breadth_findings(m.unionByName(m.where("metric_id = 'flat_count'"))), "check") == [("market_breadth_duplicate",)]
    assert rows(Q.breadth_findings(m.replace("flat_count", "odd", "metric_id")), "check") == [("market_breadth_incomplete",), ("market_breadth_unknown",)]


def test_suspensions(spark):
    b = spark.createDataFrame([("A", d(0), 1.0, 1, 1.0), ("A", d(2), 1.0, 1, 1.0), ("B", d(1), 1.0, 0, 0.0)], BAR)
    i = spark.createDataFrame([("A", None, None), ("B", None, None)], "symbol string, list_date date, delist_date date")
    assert rows(G.suspension_gaps(b, i, spark.createDataFrame([(d(n),) for n in range(4)], "trade_date date")), "symbol", "trade_date") == [("A", d(1))]


def test_evidence_rank(spark):
    at = lambda h: dt.datetime(2024, 1, 2, h, 30)
    data = [("A", d(1), "normal", "eastmoney", at(8)), ("A", d(1), "suspended", "derived_bar_gap", at(9)), ("B", d(1), "normal", "eastmoney", at(2)), ("B", d(1), "suspended", "derived_bar_gap", at(9))]
    df = spark.createDataFrame(data, "symbol string, trade_date date, status string, source string, fetched_at timestamp")
    assert rows(G.merge_by_rank(df, ["symbol", "trade_date"], G.evidence_rank()), "symbol", "status", "rank") == [("A", "normal", 0), ("B", "suspended", 1)]


def test_last_contiguous(spark):
    cal = spark.createDataFrame([(d(n),) for n in range(6)], "trade_date date")
    days = lambda *ns: spark.createDataFrame([(d(n),) for n in ns], "trade_date date")
    assert Q.last_contiguous(days(0, 1, 3), cal).first()[0] == d(1) and Q.last_contiguous(days(1, 2, 3), cal).first()[0] == d(3) and Q.last_contiguous(days(), cal).first()[0] is None
    assert rows(Q.missing_sessions(days(0, 3), cal)) == [(d(1),), (d(2),)] and rows(Q.calendar_orphans(days(9), cal)) == [(d(9),)]


def test_ticks(spark):
    t = lambda s, *seqs: [(s, d(1), q, dt.datetime(2024, 1, 2, 9, 25 + q), "buy" if q % 2 else "sell", 1) for q in seqs]
    df = spark.createDataFrame(t("A", 0, 1, 2) + t("B", 0, 2) + t("C", 0, 1, 1) + t("D", 1, 2), "symbol string, trade_date date, tick_seq int, trade_time timestamp_ntz, direction string, volume bigint")
    assert rows(Q.sequence_gaps(df), "symbol") == [("B",), ("C",), ("D",)]
    assert Q.off_session(df, "trade_time", (("09:26:00", "11:30:00"),)).count() == 3
    assert {r.symbol: r.buy_share for r in Q.direction_mix(df).toLocalIterator()}["A"] == round(1 / 3, 8)


def test_bar_rules_and_nulls(spark):
    ok = (1.0, 2.0, 0.5, 1.5, 10, 1.0)
    bad = [(0.0, *ok[1:]), (3.0, *ok[1:]), (*ok[:4], -1, 1.0), (*ok[:5], -1.0)]
    flat = (1.0, 0.5, 2.0, 1.5, 0, 0.0)  # not traded: its envelope does not matter
    df = spark.createDataFrame([ok, flat, (None,) * 6, *bad], "open double, high double, low double, close double, volume bigint, amount double")
    assert df.where(Q.bar_violations()).count() == len(bad)
    assert {r.column_name: r.nulls for r in Q.null_counts(df, ["open", "volume"]).toLocalIterator()} == {"open": 1, "volume": 1}


def test_coverage_states(spark):
    k = lambda *xs: spark.createDataFrame([(x,) for x in xs], "k string")
    state = lambda a, b: Q.key_coverage(a, b, ["k"]).first().state
    assert [state(k("a"), k("a")), state(k("a", "b"), k("a")), state(k("a"), k("a", "b")), state(k("a"), k("b")), state(k(), k("a")), state(k("a"), k()), state(k(), k())] == ["equal", "backup_gap", "primary_gap", "no_overlap", "primary_missing", "backup_missing", "no_comparable_rows"]


def test_instruments_merge(spark):
    s = "symbol string, name string, list_date date, delist_date date"
    old = spark.createDataFrame([(f"S{i}", "n", d(0), None) for i in range(40)], s)
    new = spark.createDataFrame([(f"S{i}", "m", None, None) for i in range(1, 41)], s)
    none = spark.createDataFrame([], "symbol string, absences int")
    one = {r.symbol: r for r in T.merged_instruments(old, new, none, "2024-06-28").toLocalIterator()}
    assert (one["S0"].state, one["S0"].absences, one["S0"].delist_date) == ("pending", 1, None) and one["S40"].state == "new" and one["S1"].list_date == d(0) and one["S1"].name == "m"
    two = {r.symbol: r for r in T.merged_instruments(old, new, spark.createDataFrame([("S0", 1), ("S1", 1)], "symbol string, absences int"), "2024-06-28").toLocalIterator()}
    assert (two["S0"].state, two["S0"].delist_date) == ("delisted", D(2024, 6, 28)) and two["S1"].absences == 0
    lost = {r.symbol: r.state for r in T.merged_instruments(old, new.limit(5), none, "2024-06-28").toLocalIterator()}
    assert "delisted" not in lost.values() and "suppressed" in lost.values()


def test_names_keywords_symbols(spark):
    n = lambda *xs: spark.createDataFrame([(x,) for x in xs], "name string")
    got = rows(T.routed_names(n("ab cd", "cd", "cd ef", "zz"), n("cd", "ef")))
    assert got == [("ab cd", "cd", "contains"), ("cd", "cd", "exact"), ("cd ef", None, "ambiguous"), ("zz", None, "none")]
    df = spark.createDataFrame([("up up down",), ("",), ("up",)], "t string")
    assert [r[0] for r in df.select(T.keyword_balance("t", {"up": 1.0}, {"down": 3.0})).toLocalIterator()] == [-0.5, 0.0, 1.0]
    r = spark.createDataFrame([("600000.sh; 1,000001.SZ",), (None,)], "s string")
    assert rows(T.related_symbols(r, "s", [])) == [("000001.SZ",), ("600000.SH",)]


def test_capped_findings(spark):
    df = spark.createDataFrame([("c", i) for i in range(7)] + [("e", 1)], "chk string, v int")
    from pyspark.sql import functions as F

    assert sorted((r.chk, r.v, r.hidden) for r in G.capped_findings(df, "chk", [F.col("v").desc()], 5).toLocalIterator() if r.v is None) == [("c", None, 2)]
