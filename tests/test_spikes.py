from __future__ import annotations

import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeforge.operators.spikes import find_spikes, find_stuck, implausible
from tests.conftest import rows

SCHEMA = "symbol string, trade_date date, close double, volume bigint, source string, fetched_at timestamp"
START = dt.date(2024, 1, 1)


def series(spark, values, volumes=None, symbol="A.SH", source="s"):
    data = [(symbol, START + dt.timedelta(i), v, 1 if volumes is None else volumes[i], source, dt.datetime(2024, 6, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, SCHEMA)


def walk(n, seed=0, scale=0.01):
    return np.round(50 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, scale, n))), 2).tolist()


def kinds(df):
    return {(int((r.trade_date - START).days), r.kind) for r in df.toLocalIterator()}


def test_spikes_shifts_limits(spark):
    v = walk(200)
    v[50] *= 1.3
    v[80], v[81] = v[80] * 0.7, v[81] * 0.7
    v[100:] = [x * 0.5 for x in v[100:]]  # stays: no case
    v[120] = 0.0
    v[121] = 2147483647.0
    v[130] = None
    assert kinds(implausible(series(spark, v), "close", "volume")) == {(50, "spike"), (80, "spike"), (81, "spike"), (120, "limit"), (121, "limit")}


def test_stuck_runs_and_suspensions(spark):
    v = walk(200, 1)
    v[60:72] = [v[60]] * 12
    v[100:112] = [v[100]] * 12
    volumes = [0 if 101 <= i < 112 else 5 for i in range(200)]
    assert kinds(implausible(series(spark, v, volumes), "close", "volume")) == {(i, "stuck") for i in range(61, 72)}


def test_exact_sources_cannot_be_stuck(spark):
    exact = [1.0] * 60 + [1.1] * 60
    jitter = np.round(1 + np.cumsum(np.random.default_rng(3).normal(0, 0.001, 120)), 6).tolist()
    jitter[40:60] = [jitter[40]] * 20
    df = series(spark, exact, source="exact").unionByName(series(spark, jitter, source="jitter"))
    assert {(r.source, r.kind) for r in implausible(df, "close", exact_sources=True).toLocalIterator()} == {("jitter", "stuck")}


def test_repeats_nulls_empty_and_short(spark):
    df = series(spark, walk(5))
    odd = spark.createDataFrame([(None, None, -1.0, None, None, None), ("B", START, float("nan"), 1, "s", None), ("B", START, None, 1, "s", None)], SCHEMA)
    both = df.unionByName(df).unionByName(odd).selectExpr("*", "1 as kind", "2 as v", "3 as bad")
    assert rows(implausible(both, "close", "volume"), "symbol", "kind") == [("B", "limit"), (None, "limit")]
    assert implausible(df.limit(0), "close", "volume").count() == 0


def test_every_series_apart_in_one_task(spark):
    a, b = walk(60, 5), walk(60, 6)
    a[30] *= 1.5
    df = series(spark, a, symbol="A").unionByName(series(spark, b, symbol="B")).unionByName(series(spark, a, symbol="A", source="t")).coalesce(1)
    assert rows(implausible(df, "close", "volume"), "symbol", "source") == [("A", "s"), ("A", "t")]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(20, 170), st.floats(0.15, 3.0), st.booleans())
def test_planted_spike_is_found_and_nothing_far_off(seed, where, size, up):
    x = np.cumsum(np.random.default_rng(seed).normal(0, 0.01, 200))
    x[where] += size if up else -size
    spike, _, _ = find_spikes(x, np.ones(200, bool))
    assert spike[where] and spike.sum() <= 1


def test_stuck_threshold_follows_the_rate_of_repeats():
    rng = np.random.default_rng(1)
    assert not find_stuck(rng.random(300) < 0.3).any()
    same = rng.random(300) < 0.02
    same[100:110] = True
    assert find_stuck(same)[100:110].all()


def test_a_long_series_keeps_all_its_spikes():
    x = np.cumsum(np.random.default_rng(4).normal(0, 0.01, 4000))
    at = np.arange(40, 4000, 80)
    x[at] += 1.0
    spike, _, _ = find_spikes(x, np.ones(4000, bool))
    assert np.flatnonzero(spike).tolist() == at.tolist()


def test_neighbouring_spikes_of_unequal_size_are_all_found():
    for patch in ([500, 100], [500, 80, 60], [500, 100, 100, 100]):
        x = np.log(50) + np.cumsum(np.random.default_rng(7).normal(0, 0.003, 200))
        x[100 : 100 + len(patch)] += np.log(np.array(patch) / 50)
        spike, _, _ = find_spikes(x, np.ones(200, bool))
        assert np.flatnonzero(spike).tolist() == list(range(100, 100 + len(patch)))


def test_a_short_series_is_judged_by_a_given_scale(spark):
    assert kinds(implausible(series(spark, [50.0, 50.5, 500.0, 50.2, 50.1, 51.0]), "close", "volume")) == {(2, "spike")}
    assert kinds(implausible(series(spark, [50.0, 52.0, 56.0, 53.0]), "close", "volume")) == set()


def test_many_spikes_end_in_few_rounds():
    import time

    x = np.cumsum(np.random.default_rng(4).normal(0, 0.01, 20_000))
    at = np.arange(40, 20_000, 25)
    x[at] += 1.0
    t = time.perf_counter()
    spike, _, _ = find_spikes(x, np.ones(20_000, bool))
    assert np.flatnonzero(spike).tolist() == at.tolist() and time.perf_counter() - t < 5
