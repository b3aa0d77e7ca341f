"""Fitted smoothing, the ridge solve and rolling origins against NumPy and plain Python."""

import datetime
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.operators import backtest, elasticity, forecast, intervals, quantiles, rolling, smoothing
from panelwright.operators.spec import PanelSpec

SPEC = PanelSpec(("sku",), "dt", "x")
DAY = datetime.date(2001, 1, 1)


def panel(spark, series):
    rows = [(k, DAY + datetime.timedelta(i), x) for k, values in series.items() for i, x in enumerate(values)]
    return spark.createDataFrame(rows, "sku string, dt date, x double").repartition(3)


def series(seed, n=40):
    r = random.Random(seed)
    kind = seed % 4
    return [max(0.0, [5 + 0.4 * i, 10 + 6 * math.sin(i * math.pi / 2), r.choice([0, 0, 9]), 20.0][kind] + r.gauss(0, 2)) for i in range(n)]


def ses_sse(x, alpha):
    level, sse = x[0], 0.0
    for v in x[1:]:
        sse += (v - level) ** 2
        level += alpha * (v - level)
    return sse, level


def test_smoothing_rate_is_at_least_as_good_as_a_dense_grid(spark):
    all_ = {f"s{k}": series(k) for k in range(24)} | {"one": [4.0], "same": [3.0] * 9, "null": [None, None], "gaps": [1.0, None, 5.0, 2.0, 8.0]}
    got = {r.sku: r for r in smoothing.ses_optimised(panel(spark, all_), SPEC).collect()}
    for k, values in all_.items():
        x = [v for v in values[-31:] if v is not None]
        if len(x) < 2:
            assert got[k].alpha is None and got[k].pred == (x[0] if x else None)
            continue
        dense = min(ses_sse(x, a / 4000)[0] for a in range(1, 4001))
        sse, level = ses_sse(x, got[k].alpha)
        assert got[k].sse == pytest.approx(sse) and sse <= dense * (1 + 1e-7) + 1e-12 and got[k].pred == pytest.approx(max(level, 0))
    late = smoothing.ses_optimised(panel(spark, {"s": series(1)}), SPEC, origin="2001-04-30").first()
    assert late.pred is None and late.alpha is not None


def hw(x, a, b, g, period):
    level = sum(x[:period]) / period
    trend, season, sse = (sum(x[period : 2 * period]) / period - level) / period, [v - level for v in x[:period]], 0.0
    for v in x[period:]:
        old = season.pop(0)
        sse += (v - level - trend - old) ** 2
        new = a * (v - old) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        level = new
        season.append(g * (v - level) + (1 - g) * old)
    return sse, level, trend, season


def test_holt_winters_is_at_least_as_good_as_a_dense_grid(spark):
    all_ = {f"s{k}": series(k) for k in range(8)} | {"short": [2.0, 5.0], "null": [None]}
    got = {r.sku: r for r in smoothing.holt_winters_fitted(panel(spark, all_), SPEC, period=4, steps=6).collect()}
    grid = [i / 12 for i in range(1, 12)]
    for k, x in all_.items():
        r = got[k]
        if len(x) < 8:
            assert r.ahead == ([5.0] * 6 if k == "short" else None) and r.a is None
            continue
        sse, level, trend, season = hw(x, r.a, r.b, r.g, 4)
        assert r.sse == pytest.approx(sse)
        assert r.ahead == pytest.approx([max(0.0, level + h * trend + season[(h - 1) % 4]) for h in range(1, 7)])
        assert sse <= min(hw(x, a, b, g, 4)[0] for a in grid for b in grid for g in grid) * 1.01


def test_rescaled_total(spark):
    df = spark.createDataFrame([("a", [4.0, 1.0, 2.0, 3.0], 5.0), ("b", [9.0, 0.0, 0.0, 0.0], 1.0), ("c", None, 1.0), ("d", [1.0, 1.0], None)], "k string, v array<double>, m double")
    got = {r.k: r.x for r in df.select("k", smoothing.rescaled(F.col("v"), F.col("m"), "k").alias("x")).collect()}
    assert sum(got["a"]) == pytest.approx(20) and got["a"][0] == 4 and got["a"][2] / got["a"][1] == pytest.approx(2.001 / 1.001)
    assert got["b"][0] == 9 and all(0.001 <= x <= 0.01 for x in got["b"][1:])  # less than the first day is left
    assert got["c"] is None and got["d"] is None


def test_ridge_equals_numpy_without_python_workers(spark):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for sku, n in (("a", 80), ("b", 200), ("c", 5)):
        x = rng.normal(size=(n, 6)) * [1, 10, 1000, 0.1, 1, 0] + [5, 0, 1e5, 0, 1, 3]
        y = x @ [1, -2, 0.01, 3, 0, 0] + rng.normal(size=n)
        rows += [(sku, DAY + datetime.timedelta(i), float(y[i]), *map(float, x[i])) for i in range(n)]
        sd = x.std(axis=0)
        sd[sd < 1e-9] = 1
        z = (x - x.mean(axis=0)) / sd
        beta = np.linalg.solve(z.T @ z + np.eye(6), z.T @ (y - y.mean())) / sd
        want[sku] = (y.mean() - beta @ x.mean(axis=0), beta)
    names = [f"f{i}" for i in range(6)]
    df = spark.createDataFrame([*rows, ("a", DAY, None, *[1.0] * 6), ("b", DAY, 1.0, None, *[1.0] * 5)], "sku string, dt date, x double, " + ", ".join(f"{n} double" for n in names))
    out = forecast.ridge(df, names, SPEC)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.sku: r for r in out.collect()}
    for sku, (intercept, beta) in want.items():
        assert got[sku].coef == pytest.approx(beta, rel=1e-7, abs=1e-9) and got[sku].intercept == pytest.approx(intercept, rel=1e-7)
    ahead = forecast.ridge_forecast(df, names, F.col("dt") < "2001-03-01", SPEC, least=50)
    new = {(r.sku, r.dt): r.pred for r in ahead.collect()}
    train = [r for r in rows if r[0] == "b" and r[1] < datetime.date(2001, 3, 1)]
    assert len(new) == 80 - 59 + 200 - 59 and min(v for v in new.values()) >= 0 and len(train) == 59


def test_blend_scales_the_weights_of_what_there_is(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None), (None, 2.0), (None, None)], "a double, b double")
    got = [r.x for r in df.select(forecast.blended([(F.col("a"), 0.6), (F.col("b"), 0.4)]).alias("x")).collect()]
    assert got == [pytest.approx(1.4), pytest.approx(1.0), pytest.approx(2.0), None]


def test_rolling_origins_see_no_later_row(spark):
    r = random.Random(5)
    all_ = {k: [float(r.randrange(9)) for _ in range(60)] for k in "ab"}
    origins = [str(DAY + datetime.timedelta(d)) for d in (20, 27, 34, 41, 48)]
    models = {"mean": lambda df, spec: forecast.recent_mean(df, 7, spec), "last": lambda df, spec: df.groupBy(*spec.keys).agg(F.max_by("x", "dt").alias("pred"))}
    tested = backtest.backtest(panel(spark, all_), origins, models, horizon=7, days=15, spec=SPEC)
    rows = tested.collect()
    assert len(rows) == 2 * 2 * 5 * 7
    for row in rows:
        at = (row.origin - DAY).days
        before, i = all_[row.sku][at - 15 : at], (row.dt - DAY).days
        assert at <= i < at + 7 and row.actual == all_[row.sku][i]
        assert row.pred == pytest.approx(before[-1] if row.model == "last" else sum(before[-7:]) / 7)
    scores = {s.model: s for s in backtest.scored(tested).collect()}
    rmse = [math.sqrt(np.mean([(q.pred - q.actual) ** 2 for q in rows if q.model == "mean" and str(q.origin) == o])) for o in origins]
    assert scores["mean"].rmse == pytest.approx(np.mean(rmse)) and scores["mean"].n_origins == 5
    best = {b.sku: b.model for b in backtest.best_model(tested, SPEC).collect()}
    assert set(best) == {"a", "b"}
    with pytest.raises(ValueError):
        backtest.backtest(panel(spark, all_), origins, {}, 7, 15, SPEC)


def test_exact_quantiles_of_hot_groups(spark):
    r = random.Random(8)
    rows = [("hot", r.gauss(0, 1)) for _ in range(20_000)] + [("ties", float(r.randrange(3))) for _ in range(5000)] + [("one", 4.0), ("none", None), (None, 1.0), (None, 2.0), ("two", 1.0), ("two", 5.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.961, "e": 1.0}
    got = {q.k: q for q in quantiles.exact_quantiles(df, ["k"], "v", shares, parts=16).collect()}
    assert set(got) == {"hot", "ties", "one", None, "two"}
    for k, q in got.items():
        want = np.quantile([v for g, v in rows if g == k and v is not None], list(shares.values()))
        assert [q[n] for n in shares] == pytest.approx(want, abs=1e-12)
    assert quantiles.exact_quantiles(df.limit(0), ["k"], "v", shares).count() == 0


def test_interval_join_finds_each_match_once(spark):
    r = random.Random(4)
    day = lambda i: None if i is None else DAY + datetime.timedelta(i)
    points = [(r.choice("ab"), r.choice([None, *range(90)])) for _ in range(200)]
    spans = [(r.choice("ab"), a, a + r.choice([-3, 0, 1, 20, 70])) for a in (r.randrange(90) for _ in range(60))] + [("a", 5, None), (None, 1, 9)]
    got = intervals.interval_join(spark.createDataFrame([(k, day(d), i) for i, (k, d) in enumerate(points)], "k string, d date, i int"), spark.createDataFrame([(k, day(a), day(b), j) for j, (k, a, b) in enumerate(spans)], "k string, a date, b date, j int"), ["k"], "d", "a", "b", bin_days=8)
    want = sorted((i, j) for i, (k, d) in enumerate(points) for j, (g, a, b) in enumerate(spans) if k == g and None not in (d, a, b) and a <= d <= b)
    assert sorted((q.i, q.j) for q in got.collect()) == want and len(want) > 300


def test_exponential_means_of_a_long_series_keep_all_weights(spark):
    import pandas as pd

    r = random.Random(6)
    long = [r.choice([0.0, r.gauss(50, 20)]) for _ in range(30_000)]
    gaps = [None, 1.0, None, 4.0, 2.0, None]
    first = datetime.date(1900, 1, 1)
    rows = [(k, first + datetime.timedelta(i), x) for k, values in (("long", long), ("gaps", gaps)) for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "sku string, dt date, x double")
    for span, block in ((1, None), (3, None), (7, 50), (2000, None)):
        got = {(q.sku, (q.dt - first).days): q[f"ewm_{span}"] for q in rolling.ewm_exact(df, span, SPEC, block=block).collect()}
        want = pd.Series(long).ewm(span=span).mean()
        assert [got["long", i] for i in range(len(long))] == pytest.approx(want.tolist(), rel=1e-9, abs=1e-9)
        want = pd.Series(gaps).ewm(span=span, ignore_na=True).mean().tolist()
        assert got["gaps", 0] is None and [got["gaps", i] for i in range(1, 6)] == pytest.approx(want[1:])


def test_price_curves_against_polyfit(spark):
    r, rows, want = random.Random(12), [], {}
    for sku, n in (("a", 120), ("b", 60), ("few", 10), ("flat", 50)):
        p = [5.0 if sku == "flat" else 5 + 3 * r.random() for _ in range(n)]
        q = [40 - 6 * v + 0.3 * v * v + r.gauss(0, 0.5) for v in p]
        rows += [(sku, "c", DAY + datetime.timedelta(i), q[i], p[i]) for i in range(n)]
        if n < 15 or sku == "flat":
            continue
        mean = [(np.mean(p[max(0, i - 29) : i + 1]), np.mean(q[max(0, i - 29) : i + 1])) for i in range(6, n)]
        gmv = [a * a * b for a, b in mean]
        lo, hi = np.percentile(gmv, 25), np.percentile(gmv, 75)
        kept = sorted(m for m, g in zip(mean, gmv) if lo - (hi - lo) <= g <= hi + (hi - lo))
        bands = [np.mean(kept[i : i + 5], axis=0) for i in range(0, len(kept), 5)]
        want[sku] = np.polyfit(*np.array(bands).T, 2)
    df = spark.createDataFrame(rows, "sku string, cat2 string, dt date, x double, w_price double")
    curves = elasticity.price_curves(df, SPEC)
    got = {c.sku: c for c in curves.collect()}
    assert set(got) == set(want)
    for sku, (c2, c1, _) in want.items():
        g = got[sku]
        assert g.c2 / g.scale**2 == pytest.approx(c2, rel=1e-6) and (g.c1 - 2 * g.c2 * g.mid / g.scale) / g.scale == pytest.approx(c1, rel=1e-6)
    out = elasticity.curve_elasticity(df, curves, SPEC).collect()
    raw = {(s, d): -(2 * want[s][0] * p + want[s][1]) if s in want else 0.0 for s, _, d, _, p in rows}
    a, b = np.percentile(list(raw.values()), 25), np.percentile(list(raw.values()), 75)
    cut = {k: min(max(v, a - 1.5 * (b - a)), b + 1.5 * (b - a)) for k, v in raw.items()}
    mean = np.mean([v for v in cut.values() if v > 0])
    assert all(o.sec_ed == pytest.approx(cut[o.sku, o.dt] if cut[o.sku, o.dt] > 0 else mean, rel=1e-5) for o in out) and len(out) == len(rows)


def test_smoothing_rules(spark):
    all_ = {"two": [4.0, 8.0], "silent": [9.0, 7.0, 6.0, 0.0, 0.0, 0.0, 0.0, 0.0], "four": [9.0, 3.0, 0.0, 0.0, 0.0, 0.0], "jump": [2.0, 1.0, 3.0, 2.0, 11.0], "long": [3.0] * 15 + [1.0, 9.0], "null": [None]}
    got = {}
    for r in smoothing.ses_with_rules(panel(spark, all_), SPEC, sellable=F.lit(True), steps=3).orderBy("step").collect():
        got.setdefault(r.sku, []).append(r.value)

    def smooth(x):
        cap, back = np.quantile(x, 0.99), np.quantile(x, 0.9)
        x = [back if v > cap else v for v in x]
        level = x[0]
        for v in x[1:]:
            level = 0.71 * v + 0.29 * level
        return level, x

    assert got["two"] == pytest.approx([np.mean(smooth([4.0, 8.0])[1])] * 3)
    assert all(0.001 <= v <= 0.01 for v in got["silent"])  # the mean of the last three is 0
    assert got["four"] == pytest.approx([smooth(all_["four"])[0]] * 3)
    level = smooth(all_["jump"])[0]
    assert got["jump"] == pytest.approx([(level + 11) / 2, level, level])
    assert got["long"] == pytest.approx([smooth(all_["long"])[0]] * 3) and set(got) == set(all_) - {"null"}
    able = {r.step: r.value for r in smoothing.ses_with_rules(panel(spark, {"a": [5.0, 0.0, 6.0, 0.0]}), SPEC, sellable=F.lit(False), steps=1).collect()}
    assert able[1] == pytest.approx(smooth([5.0, 0.0, 6.0, 0.0])[1][2] * 0.71 + 5 * 0.29)  # days without sales don't count


def test_seasonal_indices_read_their_input_twice_at_most(spark):
    from panelwright.plans import registry

    for name in ("n1_seasonal_index", "n4_index_fallback"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("l_shipdate") > 0 or name == "n4_index_fallback"
        scans = [f for f in plan._jdf.queryExecution().optimizedPlan().collectLeaves().mkString("\n").split("\n") if "l_shipdate" in f]
        assert len(scans) <= 1, name
