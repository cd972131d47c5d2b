from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakeforge.functions.columns import canonical_symbol
from lakeforge.operators.reconcile import current_hashes, current_rows, differences, eight_digits, full_join_differences, unmatched_keys
from tests.conftest import rows

KEY, VALUES, NAMES = ["symbol", "trade_date", "source"], ["close", "volume"], ("missing_right", "missing_left")
SCHEMA = "symbol string, trade_date date, source string, close double, volume bigint, fetched_at timestamp"


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=n)


def copy(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def hashes(df):
    return current_hashes(df, KEY, VALUES)


def made(seed, n=800):
    rnd = random.Random(seed)
    left = [(f"{i % 3}.SH" if i % 9 else None, dt.date(2023, 1, 1) + dt.timedelta(days=i), "s" if i % 7 else None, rnd.uniform(1, 100), rnd.randrange(1000) if i % 11 else None, at(0)) for i in range(n)]
    right = []
    for r in left:
        x = rnd.random()
        if x < 0.02:
            continue
        if x < 0.04:
            r = (*r[:3], r[3] * 1.01, r[4], at(0))
        elif x < 0.06:
            r = (*r[:4], None, at(0))
        elif x < 0.5:
            r = (*r[:3], r[3] * (1 + 1e-10), r[4], at(0))  # float noise
        right.append(r)
    right += [("9.SH", dt.date(2023, 5, 1), "s", 1.0, 1, at(0))]
    return left, right


def test_equals_the_full_join(spark):
    for seed in range(3):
        l, r = (copy(spark, x) for x in made(seed))
        got = rows(differences(l, r, KEY, VALUES, "symbol", F.year("trade_date"), NAMES))
        assert got == rows(full_join_differences(*(current_rows(x, KEY, VALUES) for x in (l, r)), KEY, VALUES, NAMES)) and len(got) > 20


def test_equal_stretches_are_left_out(spark):
    left, right = made(1)
    l, r = copy(spark, left), copy(spark, [x for i, x in enumerate(left) if i != 400])
    found = unmatched_keys(hashes(l), hashes(r), KEY, "symbol", F.year("trade_date"))
    assert [(x.r is None, x.trade_date) for x in found.toLocalIterator()] == [(True, left[400][1])]
    assert unmatched_keys(hashes(l), hashes(l), KEY, "symbol", F.year("trade_date")).count() == 0


def test_a_tolerance_beyond_the_fingerprints_is_refused(spark):
    one = copy(spark, made(1, 5)[0])
    with pytest.raises(ValueError):
        differences(one, one, KEY, VALUES, "symbol", F.year("trade_date"), NAMES, 1e-8)


def test_latest_row_counts_and_nulls(spark):
    d = dt.date(2024, 1, 1)
    l = copy(spark, [("A", d, "s", 1.0, None, at(1)), ("A", d, "s", 2.0, 5, at(2)), ("A", d, "s", 2.0, 5, at(2)), (None, None, None, None, None, None)])
    r = copy(spark, [("A", d, "s", 2.0, None, at(9)), ("A", d, "s", 7.0, 5, at(1)), (None, None, None, float("nan"), None, None)])
    assert rows(differences(l, r, KEY, VALUES, "symbol", F.year("trade_date"), NAMES)) == [("A", d, "s", "value_differs", "volume")]


def test_empty_sides(spark):
    l, _ = made(2, 20)
    one, none = copy(spark, l), copy(spark, [])
    assert {r[3] for r in rows(differences(one, none, KEY, VALUES, "symbol", F.year("trade_date"), NAMES))} == {"missing_right"}
    assert differences(none, none, KEY, VALUES, "symbol", F.year("trade_date"), NAMES).count() == 0


def test_rounding_tells_null_zero_infinity_apart(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-0.0,), (float("inf"),), (1.00000001,), (1.0,), (1.0001,)], "v double").select(F.xxhash64(eight_digits(F.col("v"))).alias("h"))
    h = [r.h for r in df.toLocalIterator()]
    assert h[1] == h[2] and len({h[0], h[1], h[3], h[5], h[6]}) == 5 and h[4] == h[5]


def test_symbol_spellings(spark):
    df = spark.createDataFrame([("sz000001",), (" 000001.SZ ",), ("000001.sz",), ("SZ.000001",), ("odd",), (None,)], "s string")
    assert [r[0] for r in df.select(canonical_symbol("s")).toLocalIterator()] == ["000001.SZ"] * 4 + ["ODD", None]
