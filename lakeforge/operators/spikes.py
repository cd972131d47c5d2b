"""Implausible readings of measured series (problem 3).

Each series (one symbol's readings from one source) is judged by itself:

* physical limits: readings that can be no value at all (not positive, not finite, beyond the limit);
* spikes: a robust autoregression of the log changes gives the series' usual movement; additive-outlier tests (the
  reading leaves the level and is back within ``max_patch`` readings) and level-shift tests (it stays) alternate, each
  spike being replaced by the level and each shift taken out before the next round, until no round finds anything;
* stuck runs: exact repeats in a run far longer than the series' rate of repeats makes likely.  Sources whose values
  are exact between steps (most readings repeat) cannot be stuck.

Defined results: null readings are skipped; of several readings of one day the latest fetched is the series' and the
least and greatest are tested against the same level; a change of level that lasts is no spike, nor is one at the end
of a series that is not back yet; series of fewer than ``min_length`` readings are judged by a given scale, those of fewer than three against physical
limits only;
null symbols, sources and dates group like others (null dates are judged by physical limits only).

A day's rows are folded before the shuffle, so a series has at most one row a session, however hot its key; series
are streamed through each task in key order, never collected by partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.functions.joins import null_safe_join
from lakeforge.session import cut

PHYSICAL_LIMIT = 50_000.0
#: Usual movement (of the logarithm) assumed for series of fewer than ``min_length`` readings.
SHORT_SCALE = 0.05
_OUT = "symbol string, source string, trade_date date, kind string, repeats double"


def robust_ar(r: np.ndarray, use: np.ndarray) -> tuple[float, float]:
    """Coefficient and residual scale of a first-order autoregression of the changes, from clipped changes."""
    rr = r[use]
    if len(rr) < 5:
        return 0.0, 0.0
    centre = np.median(rr)
    scale = 1.4826 * np.median(np.abs(rr - centre))
    if scale == 0:
        return 0.0, 0.0
    pair = use[1:] & use[:-1]
    a, b = (np.clip((x - centre) / scale, -2, 2) for x in (r[:-1][pair], r[1:][pair]))
    phi = float(np.clip((a @ b) / (a @ a), -0.5, 0.5)) if len(a) > 5 and a @ a > 0 else 0.0
    residual = r[1:][pair] - centre - phi * (r[:-1][pair] - centre)
    s = 1.4826 * np.median(np.abs(residual)) if len(residual) > 5 else scale
    return phi, float(max(s, 0.5 * scale))


def find_spikes(x: np.ndarray, moving: np.ndarray, threshold: float = 8.0, max_patch: int = 3, floor: float = 1e-5) -> tuple[np.ndarray, np.ndarray, float]:
    """Which readings of the log series are additive outliers; the cleaned series; the scale of its changes.

    moving: readings that count for the usual movement."""
    x = x.astype(float).copy()
    spike = np.zeros(len(x), bool)
    shifted = np.zeros(len(x), bool)
    scale = floor
    found = True
    while found:  # each round marks a new reading
        r = np.diff(x)
        use = moving[1:] & moving[:-1] & ~spike[1:] & ~spike[:-1] & ~shifted[1:]
        phi, s = robust_ar(r, use)
        scale = max(s, floor)
        centre = float(np.median(r[use])) if use.any() else 0.0
        before = np.concatenate(([0.0], np.where(use, r - centre, 0.0)))[: len(r)]
        e = r - centre - phi * before
        found = False
        judged = 0  # changes beside a spike of this round are judged in the next, on the cleaned series
        for i in np.flatnonzero(np.abs(e) > threshold * scale):
            t = i + 1  # the reading after the change
            if spike[t] or shifted[t] or t <= judged:
                continue
            level = x[t - 1]
            back = most = 0
            for n in range(1, max_patch + 1):
                if t + n >= len(x):
                    break
                away = abs(x[t + n] - level)
                far = np.all(np.abs(x[t : t + n] - level) > threshold * scale) and np.all(np.abs(x[t : t + n] - x[t + n]) > 0.6 * threshold * scale)
                if far and away <= 0.6 * threshold * scale * np.sqrt(n + 1):  # back within the usual movement
                    back = n
                    break
                if far and not most and away <= 0.35 * abs(x[t] - level):  # most of the way, if none is
                    most = n
            if back:  # additive outlier: the level goes on underneath
                spike[t : t + back] = True
                x[t : t + back] = np.linspace(level, x[t + back], back + 2)[1:-1]
            elif most:  # the next round tests the reading after it against the level
                spike[t : t + most] = True
                x[t : t + most] = level
            else:  # level shift
                shifted[t] = True
            found = True
            judged = t + max(back, most) + 1
    return spike, x, scale


def find_stuck(same: np.ndarray, least: int = 4) -> np.ndarray:
    """Which readings repeat the one before in a run too long for chance.  same: whether each reading repeats the last."""
    n = len(same)
    out = np.zeros(n, bool)
    if n < 2:
        return out
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.astype(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return out
    # chance of a repeat after a change; each run counts once, so a stuck run does not excuse itself
    p = min(0.9, len(starts) / max(1, n - int(same.sum())))
    usual = np.log(max(n, 2)) / -np.log(p)
    for a, b in zip(starts, ends):
        if b - a >= max(least, 2 * usual + 2):
            out[a:b] = True
    return out


def judge(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, moving: np.ndarray, threshold: float, min_length: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(spikes, stuck, share of repeats) of one series in time order."""
    n = len(v)
    spike, stuck = np.zeros(n, bool), np.zeros(n, bool)
    if n < 3:
        return spike, stuck, np.nan
    x = np.log(v)
    # a short series does not say how it usually moves: it is judged by a scale given for such
    spike, clean, scale = find_spikes(x, moving, threshold, floor=1e-5 if n >= min_length else SHORT_SCALE)
    for other in (lo, hi):  # further readings of the day, against the series' own level
        away = np.abs(np.log(other) - clean) > threshold * scale
        step = np.maximum(np.abs(np.diff(clean, prepend=clean[0])), np.abs(np.diff(clean, append=clean[-1])))
        spike |= away & (np.abs(np.log(other) - clean) > 2 * step) & (other != v)
    at = np.flatnonzero(moving)
    if len(at) > 1:
        m = [a[at] for a in (v, lo, hi)]
        same = np.zeros(len(at), bool)
        for a in m:
            for b in m:
                same[1:] |= a[1:] == b[:-1]
        stuck[at] = find_stuck(same)
        repeats = float((m[0][1:] == m[0][:-1]).mean())
    else:
        repeats = np.nan
    return spike, stuck, repeats


def implausible(rows: DataFrame, value: str, volume: str | None = None, exact_sources: bool = False, limit: float = PHYSICAL_LIMIT, threshold: float = 8.0, min_length: int = 10) -> DataFrame:
    """symbol, source, trade_date and kind (limit, spike, stuck) of the readings that cannot be trusted.

    volume: a column whose zeros mark sessions without trade, which cannot be stuck.  exact_sources: whether sources
    may be exact between steps, judged over all of a source's series."""
    key = ["symbol", "source", "trade_date"]
    v = F.col(value).cast("double")
    given = rows.where(v.isNotNull()).withColumn("_v", v)
    bad = F.isnan("_v") | (F.col("_v") <= 0) | (F.col("_v") >= limit)
    traded = F.coalesce(F.col(volume) != 0, F.lit(True)) if volume else F.lit(True)
    good = F.when(~bad, F.col("_v"))
    daily = given.groupBy(*key).agg(
        F.max_by(good, F.when(good.isNotNull(), F.struct("fetched_at", "_v"))).alias("v"), F.min(good).alias("lo"), F.max(good).alias("hi"), F.max(traded.cast("int")).alias("moving"), F.max(bad.cast("int")).alias("bad")
    )
    judged = cut(_stream(daily, threshold, min_length))
    found = judged.where("kind <> 'series'").select(*key, "kind")
    if exact_sources:
        exact = judged.where("kind = 'series'").groupBy("source").agg(F.median("repeats").alias("share")).where("share > 0.5").select("source", F.lit("stuck").alias("kind"))
        found = null_safe_join(found, exact, ["source", "kind"], "left_anti").select(*key, "kind")
    return found


def _stream(daily: DataFrame, threshold: float, min_length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            sym, src = (b.column(i).to_numpy(zero_copy_only=False).astype(object) for i in (0, 1))
            new = np.flatnonzero((sym[1:] != sym[:-1]) | (src[1:] != src[:-1])) + 1
            cuts = [0, *new.tolist(), b.num_rows]
            for s, e in zip(cuts, cuts[1:]):
                name = (sym[s], src[s])
                if held and name != last:
                    yield _series(held, last, threshold, min_length)
                    held = []
                held.append(b.slice(s, e - s))
                last = name
        if held:
            yield _series(held, last, threshold, min_length)

    ordered = daily.repartition("symbol", "source").sortWithinPartitions("symbol", "source", "trade_date")
    return ordered.mapInArrow(run, _OUT)


def _series(parts: list[pa.RecordBatch], name: tuple, threshold: float, min_length: int) -> pa.RecordBatch:
    t = pa.Table.from_batches(parts)
    day = t.column("trade_date").combine_chunks()
    v, lo, hi = (t.column(c).to_numpy().astype(float) for c in ("v", "lo", "hi"))
    moving, bad = t.column("moving").to_numpy() > 0, t.column("bad").to_numpy() > 0
    known = ~np.isnan(v) & ~np.asarray(day.is_null())
    spike, stuck, repeats = judge(v[known], lo[known], hi[known], moving[known], threshold, min_length)
    at = np.flatnonzero(known)
    days, kinds = [], []
    for kind, where in (("limit", np.flatnonzero(bad)), ("spike", at[spike]), ("stuck", at[stuck])):
        days.append(day.take(pa.array(where, pa.int64())))
        kinds += [kind] * len(where)
    n = len(kinds) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name[0]] * n, pa.string()), pa.array([name[1]] * n, pa.string()), pa.concat_arrays([*(d.cast(pa.date32()) for d in days), pa.nulls(1, pa.date32())]),
            pa.array([*kinds, "series"]), pa.array([None] * (n - 1) + [None if np.isnan(repeats) else repeats], pa.float64()),
        ],
        ["symbol", "source", "trade_date", "kind", "repeats"],
    )
