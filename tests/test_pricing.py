"""Forecasts of pooled models carried on, perceived prices and outliers of short kinds, in plain Python."""

import collections
import datetime
import hashlib
import random

import pytest

from panelwright.operators import cleaning, features, recent
from panelwright.operators.spec import PanelSpec

SPEC = PanelSpec(("k",), "dt", "x")
DAY = datetime.date(2001, 1, 1)
SCHEMA = "k int, pool int, dt date, x double"


def series(seed=1):
    """Two pools; series of 3, 7 and 8 rows, one that falls to 0 and stays there, and longer ones."""
    r = random.Random(seed)
    lengths = {0: 3, 1: 7, 2: 8, 3: 30, 4: 25, 5: 40, 6: 12}
    return {k: [0.0 if k == 3 and i > 15 else float(r.randrange(1, 20)) for i in range(n)] for k, n in lengths.items()}


def frame(spark, values):
    return spark.createDataFrame([(k, k % 2, DAY + datetime.timedelta(i), x) for k, xs in values.items() for i, x in enumerate(xs)], SCHEMA).repartition(5)


def jitter(k, step):
    return 0.001 + 0.009 * int(hashlib.md5(f"{k}:{step}".encode()).hexdigest()[:7], 16) / 16**7


def carried(xs, phi, theta, k, steps):
    d = [None] + [b - a for a, b in zip(xs, xs[1:], strict=False)]
    e = [d[i] - sum(phi[j] * d[i - 1 - j] for j in range(3)) if i >= 4 else None for i in range(len(xs))]
    outs = [xs[i] - e[i] + theta * e[i - 1] if i >= 5 else None for i in range(len(xs))]
    ys, last, found = list(xs), e[-1], []
    for step in range(1, steps + 1):
        g = None
        if last is not None:
            g = ys[-1] + sum(phi[j] * (ys[-1 - j] - ys[-2 - j]) for j in range(3))
        outs.append(None if g is None else g + theta * last)
        there = [outs[-p] for p in (1, 2, 3, 7) if p <= len(outs) and outs[-p] is not None]
        v = sum(there) / len(there) if there else None
        v = jitter(k, step) if v is not None and v <= 0 else v
        last = None if v is None else v - g
        ys.append(v)
        found.append(v)
    return found


def test_pooled_arma_carried_on(spark):
    values = series()
    df = frame(spark, values)
    models = {r.k: ((r.phi1, r.phi2, r.phi3), r.theta) for r in recent.pooled_arma(df, "pool", SPEC).collect()}
    got = collections.defaultdict(dict)
    for r in recent.pooled_arma_forecast(df, "pool", SPEC, steps=9).collect():
        got[r.k][r.step] = r.pred
    assert set(got) == set(values)
    for k, xs in values.items():
        want = carried(xs, *models[k], k, 9)
        assert [got[k][i] for i in range(1, 10)] == [pytest.approx(v, abs=1e-9) if v is not None else None for v in want]
    assert set(got[0].values()) == {None}
    assert all(v > 0 for k in got for v in got[k].values() if v is not None)


def test_a_falling_series_gets_jitter(spark):
    values = {k: [float(max(0, 100 - (7 + k) * i)) for i in range(30)] for k in range(4)}
    values[4] = [-5.0 - (i % 3) for i in range(20)]
    rows = recent.pooled_arma_forecast(frame(spark, values), "pool", SPEC, steps=3).collect()
    low = [r for r in rows if r.k == 4]
    assert [r.pred for r in sorted(low, key=lambda r: r.step)][0] == pytest.approx(jitter(4, 1))
    assert all(r.pred is None or r.pred > 0 for r in rows)
    assert recent.pooled_arma_forecast(frame(spark, values).where("false"), "pool", SPEC).count() == 0


def test_perceived_price(spark):
    r = random.Random(3)
    rows = [(k, DAY + datetime.timedelta(i), r.choice([1.0, 2.0]), r.choice([0.8, 1.1, 1.9, 2.4])) for k in range(3) for i in range(k * 5 + 1)]
    got = {(x.k, x.dt): x.perceived for x in features.perceived_price(spark.createDataFrame(rows, "k int, dt date, ref_price double, price double"), SPEC).collect()}
    groups = collections.defaultdict(list)
    for k, dt, ref, p in rows:
        groups[k, ref].append((dt, p))
    for (k, ref), all_ in groups.items():
        all_.sort()
        parts = -(-len(all_) // 3)
        size, longer = divmod(len(all_), parts)
        at = 0
        for c in range(parts):
            chunk = all_[at : at + size + (c < longer)]
            at += len(chunk)
            best = min(chunk, key=lambda t: (round(abs(t[1] - ref), 6), t[0]))[1]
            assert {got[k, dt] for dt, _ in chunk} == {best}
    assert len(got) == len(rows)


def test_outliers_of_short_kinds(spark):
    rows = [(1, DAY + datetime.timedelta(i), "a", x) for i, x in enumerate([10.0, 10.0, 100.0, 10.0])]
    rows += [(1, DAY + datetime.timedelta(10 + i), "b", x) for i, x in enumerate([10.0] * 8 + [1.0])]
    df = spark.createDataFrame(rows, "k int, dt date, kind string, x double")
    marked = lambda **more: {(r.kind, r.x) for r in cleaning.window_outliers(df, SPEC, kind="kind", **more).where("outlier = 1").collect()}
    assert marked() == {("b", 1.0)}
    assert marked(short_mean=True) == {("a", 100.0), ("b", 1.0)}
