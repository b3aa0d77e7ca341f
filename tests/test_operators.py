"""Hand-worked series and properties."""

import datetime

import numpy as np
import pandas as pd
import pytest

from panelwright.functions import scalars as S
from panelwright.operators import cleaning as C
from panelwright.operators import features as N
from panelwright.operators import forecast as G
from panelwright.operators import rolling as R
from panelwright.operators.spec import PanelSpec
from panelwright.sources import files

SPEC = PanelSpec(keys=("k",), date="dt", target="x")


def panel(spark, series, **cols):
    rows = [(k, datetime.date(2001, 1, 1) + datetime.timedelta(i), float(x), *(c[i] for c in cols.values())) for k, xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, ["k", "dt", "x", *cols])


def values(df, col, k="a"):
    return [r[col] for r in df.where(f"k = '{k}'").orderBy("dt").collect()]


@pytest.fixture(scope="module")
def noisy(spark):
    r = np.random.default_rng(7)
    return {k: np.round(r.gamma(2, 10, 60) * (1 + 5 * (r.random(60) > 0.93))).tolist() for k in "abcd"}


def test_window_outliers(spark):
    df = panel(spark, {"a": [10] * 7 + [100] + [10] * 6, "b": [1, 100, 1]})
    assert values(C.window_outliers(df, SPEC), "outlier") == [0] * 7 + [1] + [0] * 6
    assert values(C.window_clipped(df, SPEC), "x")[7] == pytest.approx(400 / 7)
    assert values(C.window_outliers(df, SPEC), "outlier", "b") == [0, 0, 0]


def test_window_outliers_as_by_enumeration(spark, noisy):
    got = C.window_outliers(panel(spark, noisy), SPEC, top=2.0, bottom=0.3)
    capped = C.window_capped(panel(spark, noisy), SPEC, top=2.0)
    for k, xs in noisy.items():
        flag, cap = [0] * 60, list(xs)
        for i in range(54):
            m = sum(xs[i : i + 7]) / 7
            for j in range(i, i + 7):
                if xs[j] > 2 * m or xs[j] < 0.3 * m:
                    flag[j] = 1
                if xs[j] > 2 * m:
                    cap[j] = max(2 * m, cap[j] if cap[j] != xs[j] else 0)
        assert values(got, "outlier", k) == flag
        assert values(capped, "x", k) == pytest.approx(cap)


def test_rolling_as_pandas(spark, noisy):
    df = R.ewm(R.rolling(panel(spark, noisy), [7], ["mean", "std", "median"], SPEC, shift=1), [3, 7], SPEC)
    df = R.centered_mean(df, 14, SPEC)
    s = pd.Series(noisy["b"])
    for col, want in {"mean_7_shift_1": s.shift(1).rolling(7).mean(), "std_7_shift_1": s.shift(1).rolling(7).std(), "median_7_shift_1": s.shift(1).rolling(7).median(), "ewm_3": s.ewm(span=3).mean(), "ewm_7": s.ewm(span=7).mean(), "centered_14": s.rolling(14, center=True).mean()}.items():
        got = pd.Series(values(df, col, "b"), dtype=float)
        assert np.allclose(got, want, equal_nan=True, atol=1e-9), col


def test_small_goldens(spark):
    assert values(R.ewm(panel(spark, {"a": [1, 2, 3]}), [3], SPEC), "ewm_3") == pytest.approx([1, 5 / 3, 17 / 7])
    assert G.ses_forecast(panel(spark, {"a": [3, 4, 5]}), SPEC).first().pred == pytest.approx(4.6259)
    assert values(R.near_equal_chunks(panel(spark, {"a": range(7)}), 3, SPEC), "chunk") == [0, 0, 0, 1, 1, 2, 2]
    assert N.long_tail(panel(spark, {"a": [0, 1] * 4}), SPEC).first().is_long_tail == 1
    assert N.poisson_quantile(spark.createDataFrame([(2.0,)], ["r"]), "r").first().k == 3
    df = spark.createDataFrame([(9.0, p) for p in (1.0, 9.0, 40.0)], ["m", "p"])
    assert [r[0] for r in df.select(S.clamp_to_mean("p", "m")).collect()] == [3, 9, 27]
    assert values(R.streaks(panel(spark, {"a": [0, 0, 1, 1, 1, 0]}), SPEC), "streak") == [0, 1, 0, 1, 2, 0]


def test_band(spark):
    day = [datetime.date(2001, 1, 1) + datetime.timedelta(i) for i in range(7)]
    rows = [("c", s, d, float(x)) for s, x in zip("ABCD", (1, 2, 3, 5), strict=True) for d in day]
    spec = PanelSpec(keys=("sku_id",), date="dt", target="x")
    got = {r.sku_id: r.band for r in N.volume_band(spark.createDataFrame(rows, ["cat1", "sku_id", "dt", "x"]), ["cat1"], spec=spec).collect()}
    assert got == {"A": 3, "B": 3, "C": 2, "D": 0}


def test_extrapolation_as_by_hand(spark, noisy):
    got = [r.value for r in R.extrapolated(panel(spark, noisy), 20, spec=SPEC).where("k = 'c'").orderBy("step").collect()]
    xs = list(noisy["c"])
    for _ in range(20):
        xs.append(sum(np.mean(xs[-n:]) for n in (7, 15, 30)) / 3)
    assert got == pytest.approx(xs[-20:])


def test_quadratic_and_pooled_fits(spark):
    p = np.linspace(1, 3, 40)
    df = panel(spark, {"a": (50 - 8 * p + 2 * p * p).tolist()}, price=p.tolist())
    r = N.quadratic_elasticity(df, SPEC).first()
    assert r.c2 == pytest.approx(2) and r.c1 == pytest.approx(-8 + 4 * p.mean())
    xs = np.cumsum(np.random.default_rng(1).normal(size=400)).tolist()
    row = G.pooled_ar(panel(spark, {"a": xs}, bucket=["b"] * 400), "bucket", SPEC).first()
    t = np.array([[row.r0, row.r1, row.r2], [row.r1, row.r0, row.r1], [row.r2, row.r1, row.r0]])
    assert np.linalg.solve(t, [row.r1, row.r2, row.r3]) == pytest.approx([row.phi1, row.phi2, row.phi3])


def test_ridge_as_numpy(spark):
    r = np.random.default_rng(2)
    f, g = r.normal(size=60), r.normal(5, 3, 60)
    y = 3 + 2 * f - g + r.normal(0, 0.1, 60)
    got = G.ridge(panel(spark, {"a": y.tolist()}, f=f.tolist(), g=g.tolist()), ["f", "g"], SPEC).first()
    z = np.column_stack([(v - v.mean()) / v.std() for v in (f, g)])
    beta = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean())) / [f.std(), g.std()]
    assert got.coef == pytest.approx(beta) and got.intercept == pytest.approx(y.mean() - beta @ [f.mean(), g.mean()])


def test_holt_winters_keeps_season_and_floor(spark):
    df = panel(spark, {"a": [10, 20, 30, 40, 50, 60, 70] * 8, "b": [1, 2, 3]})
    got = G.holt_winters(df, SPEC)
    assert [r.value for r in got.where("k = 'a'").orderBy("step").limit(7).collect()] == pytest.approx([10, 20, 30, 40, 50, 60, 70], abs=1)
    assert got.where("k = 'b' and value = 2").count() == 20 and got.where("value < 0").count() == 0


def test_recursive_linear_by_hand(spark):
    r, day = np.random.default_rng(4), datetime.date(2001, 6, 1)
    series = {k: r.gamma(3, 5, 60).round(2).tolist() for k in "abcd"}
    last = {"a": 1, "b": 5, "c": 20, "d": 40}
    rows = [("p", k, day - datetime.timedelta(last[k] + 59 - i), x) for k, xs in series.items() for i, x in enumerate(xs) if i not in (20, 21)]
    rows += [("p", "short", day - datetime.timedelta(2), 4.0), ("p", "short", day - datetime.timedelta(1), 4.0), ("p", "a", day, 1e6), ("p", "old", day - datetime.timedelta(300), 3.0)]
    spec = PanelSpec(("q", "k"), "dt", "x")
    found = G.recursive_linear(spark.createDataFrame(rows, ["q", "k", "dt", "x"]), "2001-06-01", ("q",), spec).orderBy("dt").collect()
    got = {k: [x for x in found if x.k == k] for k in (*series, "short", "old")}
    grid = {k: [xs[22] if i in (20, 21) else x for i, x in enumerate(xs)] for k, xs in series.items()}
    fit = [(xs[i - 14 : i][::-1], xs[i]) for xs in grid.values() for i in range(14, 60)]
    beta = np.linalg.lstsq(np.array([[1, *f] for f, _ in fit]), np.array([y for _, y in fit]), rcond=None)[0]
    for k in "ab":
        xs = list(grid[k])
        for _ in range(last[k]):
            xs.append(float(beta @ [1, *xs[-14:][::-1]]))
        assert [x.pred for x in got[k]] == pytest.approx([max(xs[-1], 0)] * 20, rel=1e-4) and got[k][0].model == "linear" and got[k][0].dt == day
    assert {(x.model, x.pred) for x in got["short"]} == {("ses", 4.0)} and {x.model for x in got["c"]} == {"ses"}
    assert len(got["d"]) == len(got["old"]) == 20 and {x.pred for x in got["d"] + got["old"]} == {None}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], ["p", "v", "s"])
    files.write_partitions(df, f"{tmp_path}/t", "orc", ["p"])
    files.write_partitions(df.where("p = 'a'").withColumn("v", df.v + 10), f"{tmp_path}/t", "orc", ["p"])
    assert sorted(r.v for r in spark.read.orc(f"{tmp_path}/t").collect()) == [2, 11]
    assert not files.write_unless_empty(df.limit(0), f"{tmp_path}/none") and files.write_unless_empty(df, f"{tmp_path}/some")
    files.write_control_a(df, f"{tmp_path}/c")
    assert sorted(spark.read.text(f"{tmp_path}/c").toPandas().value) == ["a\x011\x01x", "b\x012\x01y"]


def test_entry_without_training_data_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__

    monkeypatch.setitem(sys.modules, "panelwright.llm", None)
    again = importlib.reload(__spark_entry__)
    assert "sales_drop_cases" in again.queries() and not any(q.startswith("op") for q in again.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
