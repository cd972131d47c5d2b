from __future__ import annotations

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeforge.llm.fusion import PRECEDENCE, claims, estimated_sources, fused
from lakeforge.llm.queries import PRICES, p6_found, p6_fused
from tests.conftest import rows

TRUST = [("good", 1), ("fair", 2), ("poor", 3)]
STATUS = "symbol string, trade_date date, status string, source string, data_version string, fetched_at timestamp"
KEY = ["symbol", "trade_date"]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def at(n):
    return dt.datetime(2024, 2, 1, 0, 0, n)


def trust(spark):
    return spark.createDataFrame(TRUST, "source string, trust_rank int")


def status_items(spark, data, **how):
    df = data if not isinstance(data, list) else spark.createDataFrame(data, STATUS)
    return claims(df, KEY, {"status": F.nullif(F.trim("status"), F.lit(""))}, trust(spark), **how)


def test_precedence_field_by_field(spark):
    data = [
        ("A", day(1), "x", "poor", "v2", at(1)), ("A", day(1), "y", "good", "v1", at(9)), ("A", day(1), None, "good", "v10", at(9)),
        ("B", day(1), "x", "fair", "v1", at(9)), ("B", day(1), "y", "good", "v1", at(1)), ("B", day(1), "z", "good", "v1", at(2)),
        ("C", day(1), " ", "good", "v1", at(1)), ("C", day(1), None, None, None, None), ("D", day(1), "x", "good", "v1", at(1)), (None, None, "q", "odd", None, None), (None, None, "q", "odd", None, None),
        ("E", day(1), "q", None, None, None), ("E", day(1), "q", None, None, None),
    ]
    df = spark.createDataFrame(data, STATUS).selectExpr("*", "1 as n", "2 as trust_rank", "3 as claims", "4 as _trust")
    items = status_items(spark, df)
    got = fused(items, KEY, estimated_sources(items), PRECEDENCE)
    assert rows(got, "symbol", "value", "source", "data_version") == [("A", "x", "poor", "v2"), ("B", "z", "good", "v1"), ("E", "q", None, None), (None, "q", "odd", None)]
    assert got.where("symbol = 'B'").first().fetched_epoch % 60 == 2 and got.where("symbol = 'E'").first().fetched_epoch is None
    empty = status_items(spark, df.limit(0))
    assert fused(empty, KEY, estimated_sources(empty), PRECEDENCE).count() == 0


def test_a_newer_version_outweighs_any_votes_and_votes_settle_the_rest(spark):
    data = [("A", day(1), "old", s, "v1", at(1)) for s in ("good", "fair", "poor", "s1", "s2", "s3")] + [("A", day(1), "new", "worst", "v2", at(0))]
    items = status_items(spark, data)
    sources = estimated_sources(items)
    assert fused(items, KEY, sources, PRECEDENCE).first().value == "new" and fused(items, KEY, sources).first().value == "old"
    even = [("A", day(1), v, s, "v1", at(1)) for v, s in (("a", "z"), ("b", "x"), ("b", "y"))]  # untrusted alike, fetched at once
    items = status_items(spark, even)
    assert fused(items, KEY, estimated_sources(items), PRECEDENCE).first().value == "b"


def planted(n=300, seed=2):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        truth = f"t{i}"
        wrong = f"w{rnd.randrange(5)}" if rnd.random() < 0.35 else truth
        said = [("a", truth if rnd.random() < 0.9 else f"e{rnd.randrange(50)}"), ("b", truth if rnd.random() < 0.9 else f"f{rnd.randrange(50)}")]
        said += [(s, wrong) for s in ("c", "copy1", "copy2")]  # a poor source and its copies outvote the good ones
        data += [(f"S{i}", day(1), v, s, "v1", at(1)) for s, v in said]
    return data


def test_copied_votes_are_discounted(spark):
    data = planted()
    items = status_items(spark, data)
    got = {r.symbol: r.value for r in fused(items, KEY, estimated_sources(items)).toLocalIterator()}
    by = defaultdict(list)
    for r in data:
        by[r[0]].append(r[2])
    right = sum(v == "t" + s[1:] for s, v in got.items())
    majority = sum(max(set(v), key=v.count) == "t" + s[1:] for s, v in by.items())
    assert len(got) == 300 and right > majority and right > 270


def brute(data, rounds=10, close=1e-3, prior=0.1, n=10):
    """The same estimation over every item, in plain loops."""
    items = defaultdict(dict)
    for symbol, _, value, source, _, _ in data:
        items[symbol][source] = value
    sources = {s for c in items.values() for s in c}
    acc, truth = dict.fromkeys(sources, 0.8), None

    def weights():
        w = dict.fromkeys(sources, 1.0)
        pairs = defaultdict(lambda: [0, 0, 0, 0])
        for i, c in items.items():
            for x in c:
                for y in c:
                    if x < y:
                        pairs[x, y][3 if c[x] != c[y] else 2 if truth is None else 0 if c[x] == truth[i] else 1] += 1
        for (x, y), (kt, kf, ku, kd) in sorted(pairs.items()):
            a1, a2 = acc[x], acc[y]
            pt, pf, a = a1 * a2, (1 - a1) * (1 - a2) / n, (a1 + a2) / 2
            pd = max(1e-9, 1 - pt - pf)
            alone = kt * math.log(pt) + kf * math.log(max(pf, 1e-12)) + ku * math.log(pt + pf) + kd * math.log(pd)
            bound = kt * math.log(a * 0.8 + pt * 0.2) + kf * math.log((1 - a) * 0.8 + pf * 0.2 + 1e-12) + ku * math.log(0.8 + (pt + pf) * 0.2) + kd * math.log(pd * 0.2)
            p = 1 / (1 + math.exp(min(700, max(-700, math.log((1 - prior) / prior) + alone - bound))))
            w[x if a1 <= a2 else y] *= 1 - 0.8 * p
        return w

    w = weights()
    for _ in range(rounds):
        truth = {}
        for i, c in items.items():
            score = defaultdict(float)
            for s, v in c.items():
                score[v] += w[s] * math.log(n * acc[s] / (1 - acc[s]))
            truth[i] = max((round(x, 9), v) for v, x in score.items())[1]
        new = {}
        for s in sources:
            said = [c[s] == truth[i] for i, c in items.items() if s in c]
            new[s] = min(0.99, max(0.05, (sum(said) + 0.8) / (len(said) + 1)))
        moved, acc = max(abs(new[s] - acc[s]) for s in sources), new
        w = weights()
        if moved < close:
            break
    return acc, w


def test_estimation_by_patterns_equals_the_plain_one(spark):
    data = planted(120, 5)
    acc, w = brute(data)
    got = {r.source: r for r in estimated_sources(status_items(spark, data)).toLocalIterator()}
    assert set(got) == set(acc)
    for s, r in got.items():
        assert r.accuracy == pytest.approx(acc[s], abs=1e-6) and r.weight == pytest.approx(w[s], abs=1e-6)


def test_every_field_of_both_tables(spark, tmp_path):
    bars = [("A", day(1), s, "v1", at(1), *[v] * 6) for s, v in (("a", 1.0), ("b", 1.0), ("c", 2.0))]
    spark.createDataFrame(bars, "symbol string, trade_date date, source string, data_version string, fetched_at timestamp, " + ", ".join(f"{f} double" for f in PRICES)).write.parquet(f"{tmp_path}/daily_bars.parquet")
    spark.createDataFrame([("A", day(1), " X", "a", "v1", at(1)), ("A", day(1), "x", "b", "v1", at(2))], STATUS).write.parquet(f"{tmp_path}/trading_status.parquet")
    trust(spark).unionByName(spark.createDataFrame([("c", 9)], "source string, trust_rank int")).write.parquet(f"{tmp_path}/source_trust.parquet")
    want = [("daily_bars", f, "1.0") for f in PRICES] + [("trading_status", "status", "x")]
    assert rows(p6_fused(spark, str(tmp_path)), "table_name", "field_name", "value") == sorted(want)
    assert rows(p6_found(spark, str(tmp_path)), "field_name", "source") == sorted([(f, "c") for f in PRICES] + [("status", "b")])


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not __import__("os").path.isdir(FOLDER), reason="no test tables")
def test_p6_found_equals_its_sql(spark):
    import duckdb

    from lakeforge.llm.queries import oracle_sql

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in ("daily_bars", "trading_status", "source_trust"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    want = con.execute(oracle_sql()["p6_found"]).fetchall()
    assert rows(p6_found(spark, FOLDER)) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t)) and want
