"""Plans and results of steps that must not grow faster than their input."""

import datetime

import pytest


from panelwright.operators import cleaning as C
from panelwright.operators import elasticity as E
from panelwright.operators import features as N
from panelwright.operators import forecast as G
from panelwright.operators import recent as Q
from panelwright.operators import smoothing as M
from panelwright.operators.spec import PanelSpec

SPEC = PanelSpec(("sku",), "dt", "x")
DAY = datetime.date(2001, 1, 1)


def dated(spark, rows):
    """rows: (sku, day number, value)."""
    return spark.createDataFrame([(k, None if i is None else DAY + datetime.timedelta(i), x) for k, i, x in rows], "sku string, dt date, x double").repartition(3)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_grid_is_made_from_the_rows_without_a_join(spark):
    df = dated(spark, [("a", 0, 1.0), ("a", 3, None), ("a", 4, 5.0), ("a", 4, 5.0), ("a", 6, None), ("b", 2, 7.0), ("n", None, 1.0), ("c", 0, None), ("c", 2, None)])
    grid = C.daily(df, SPEC)
    assert "Join" not in plan(grid)
    got = sorted(((r.sku, (r.dt - DAY).days, r.x) for r in grid.collect()), key=str)
    assert got == sorted([("a", 0, 1.0), ("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 5.0), ("a", 4, 5.0), ("a", 4, 5.0), ("a", 5, 5.0), ("a", 6, 5.0), ("b", 2, 7.0), ("c", 0, None), ("c", 1, None), ("c", 2, None)], key=str)


def test_smoothing_rates_are_tried_for_batches_of_series(spark):
    many = {f"s{k}": [float((k * 7 + i * i) % 11) for i in range(k % 35)] for k in range(1, 60)}
    df = dated(spark, [(k, i, x) for k, xs in many.items() for i, x in enumerate(xs)] + [("null", 0, None)])
    fitted = M.ses_optimised(df, SPEC)
    assert "MapInArrow" in plan(fitted)
    got = {r.sku: (r.alpha, r.sse, r.pred) for r in fitted.collect()}
    assert got["null"] == (None, None, None) and len(got) == sum(1 for v in many.values() if v) + 1
    for k in ("s1", "s36", "s2", "s40", "s34"):  # lengths 1, 1, 2, 5 and 34, each alone
        one = M.ses_optimised(df.where(f"sku = '{k}'"), SPEC).first()
        assert got[k] == (one.alpha, one.sse, one.pred)


def test_seasonal_rates_are_tried_for_batches_of_series(spark):
    many = {f"s{k}": [float((k * 5 + i * i) % 13) for i in range(k)] for k in range(1, 30)}
    df = dated(spark, [(k, i, x) for k, xs in many.items() for i, x in enumerate(xs)] + [("null", 0, None)])
    fitted = M.holt_winters_fitted(df, SPEC, steps=6)
    assert "MapInArrow" in plan(fitted)
    got = {r.sku: r for r in fitted.collect()}
    assert got["null"].ahead is None and got["s7"].ahead == [many["s7"][-1]] * 6 and got["s7"].a is None
    for k in ("s8", "s11", "s29"):
        assert got[k] == M.holt_winters_fitted(df.where(f"sku = '{k}'"), SPEC, steps=6).first()


def test_band_of_own_rows_is_that_of_all_days(spark):
    rows = [(f"c{k % 2}", k, DAY + datetime.timedelta(i), float((k * 3 + i * i) % 17)) for k in range(8) for i in range(0, 40, 1 + k % 4)]
    df = spark.createDataFrame(rows, "cat1 string, sku_id int, dt date, x double")
    spec = PanelSpec(("sku_id",), "dt", "x")
    joined = df.join(N.volume_band(df, ["cat1"], spec=spec), ["cat1", "sku_id", "dt"], "left").select(*df.columns, "band")
    own = N.with_volume_band(df, ["cat1"], spec=spec)
    assert {tuple(r) for r in own.collect()} == {tuple(r) for r in joined.collect()}
    bands = plan(N.volume_band(df, ["cat1"], spec=spec))
    assert "Window" not in bands and bands.count("Exchange hashpartitioning") == 1


def test_ridge_of_a_pool_has_no_window_over_it(spark):
    rows = [("p", float(i % 7) + 1e6, float(i % 5), 3.0 * (i % 7) - 2.0 * (i % 5)) for i in range(200)]
    fitted = G.ridge(spark.createDataFrame(rows, "pool string, a double, b double, x double"), ["a", "b"], PanelSpec(("pool",), "dt", "x"), lam=1e-6)
    assert "Window" not in plan(fitted)
    assert fitted.first().coef == [pytest.approx(3.0, rel=1e-6), pytest.approx(-2.0, rel=1e-6)]


def test_recent_means_of_all_rows_are_worked_out_in_batches(spark):
    values = {k: [float((k * 7 + i * i * 3) % 23) / 7 for i in range(k * 6)] for k in range(1, 9)} | {9: [None, 4.0, None], 10: [2.0] * 40}
    df = dated(spark, [(f"s{k}", i, x) for k, xs in values.items() for i, x in enumerate(xs)])
    both = Q.rolling_apply(df, 30, {"t": Q.trimmed_of_rows, "l": Q.latest_of_rows, "t1": Q.trimmed_recent, "l1": Q.latest_recent}, spec=SPEC)
    assert "ArrowEvalPython" in plan(both) and plan(both).count("collect_list") == 1
    rows = both.collect()
    assert len(rows) == sum(map(len, values.values())) and [(r.t, r.l) for r in rows] == [(r.t1, r.l1) for r in rows]


def test_panel_is_dealt_once_for_its_sums_and_its_windows(spark):
    from panelwright.operators import rolling as R
    from panelwright.sources import panels

    for name in ("dense", "sparse"):
        text = plan(R.lags(getattr(panels, name)(spark, "/root/testdata/sf0.001"), [1]))
        assert text.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in text


def test_price_curves_and_elasticities_join_no_rows_with_themselves(spark):
    rows = [(k, DAY + datetime.timedelta(i), 2.0 + (i * 7 + k) % 5, 9.0 - (i * 7 + k) % 5) for k in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "sku int, dt date, price double, x double").repartition(3)
    for found in (E.price_curves(df, SPEC, price="price"), N.ratio_elasticity(df, SPEC)):
        assert "Join" not in plan(found) and plan(found).count("Exchange hashpartitioning") == 1


def test_curve_elasticity_reads_its_slopes_from_one_table(spark):
    rows = [(k, f"c{k % 2}", DAY + datetime.timedelta(i), 2.0 + (i * 7 + k) % 5, 9.0 - (i * 7 + k) % 5) for k in range(4) for i in range(30)]
    df = spark.createDataFrame(rows, "sku int, cat2 string, dt date, w_price double, x double").repartition(3)
    found = E.curve_elasticity(df, E.price_curves(df, SPEC), SPEC)
    assert found.count() == 120 and "Window" not in plan(found) and plan(found).count("SortMergeJoin") == 0


@pytest.mark.parametrize(("name", "most"), [("z4_pricing_strategy_features", 13), ("z5_augmentation_features", 19), ("z9_linear_baseline", 19), ("g9_pooled_arma_seven_days", 4), ("z14_long_tail_arma_series", 4)])
def test_first_table_of_a_recipe_holds_only_what_later_steps_read(spark, monkeypatch, name, most):
    from panelwright.plans import recipes, registry

    class Seen(Exception):
        pass

    def stop(df, *done):
        raise Seen(df.columns)

    monkeypatch.setattr(recipes, "cut", stop)
    with pytest.raises(Seen) as seen:
        registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert len(seen.value.args[0]) <= most


def test_first_table_of_category_features_holds_only_what_later_steps_read(spark, monkeypatch):
    from panelwright.plans import registry
    from panelwright.sources import files

    class Seen(Exception):
        pass

    def stop(df, *rest):
        raise Seen(df.columns)

    monkeypatch.setattr(files, "write_and_read", stop)
    with pytest.raises(Seen) as seen:
        registry.queries()["z2_category_features"](spark, "/root/testdata/sf0.001")
    assert len(seen.value.args[0]) <= 11


def test_back_test_deals_histories_once_and_leaves_out_those_that_nothing_follows(spark):
    from panelwright.operators import backtest as B

    df = dated(spark, [(f"s{k}", i, float((k * 7 + i * i) % 11)) for k in range(6) for i in range(0, 60, 1 + k * 4)])
    origins, seen = [str(DAY + datetime.timedelta(d)) for d in (20, 40, 50)], []

    def mean(df, spec, n):
        seen.append(df)
        return G.recent_mean(df, n, spec)

    models = {f"mean_{n}": lambda df, spec, n=n: mean(df, spec, n) for n in (1, 2, 3, 4)}
    whole = B.backtest(df, origins, models, 3, 30, SPEC)
    assert sum(plan(whole).count(f"{kind} [") for kind in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin")) == 1
    part = B.backtest(B.followed(df, origins, 3, SPEC), origins, models, 3, 30, SPEC)
    pairs = {(r.sku, r.origin) for r in seen[-1].select("sku", "origin").distinct().collect()}
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.collect()))
    assert pairs == {(r.sku, r.origin) for r in whole.collect()} and len(pairs) < seen[0].select("sku", "origin").distinct().count()


def test_models_of_equal_measure_are_chosen_by_name(spark):
    from panelwright.operators import backtest as B

    rows = [("s", DAY, DAY + datetime.timedelta(i), m, 0.1 * i, 0.1 * i + e) for m, e in (("a", 1 + 1e-15), ("b", 1.0)) for i in range(4)]
    tested = spark.createDataFrame(rows, "sku string, origin date, dt date, model string, actual double, pred double")
    assert B.best_model(tested, SPEC).first().model == "a"


def test_first_table_of_regional_models_holds_only_what_later_steps_read(spark, monkeypatch):
    from panelwright.plans import recipes, registry

    class Seen(Exception):
        pass

    def stop(df, *done):
        raise Seen(df.columns)

    monkeypatch.setattr(recipes, "cut", stop)
    with pytest.raises(Seen) as seen:
        registry.queries()["z18_regional_models"](spark, "/root/testdata/sf0.001")
    assert len(seen.value.args[0]) <= 10
