"""Operators of recent values, ranks, calendars and intraday rows by hand, with nulls, ties and empty frames."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import cleaning, features, intraday, recent
from panelwright.operators.spec import PanelSpec

SPEC = PanelSpec(("k",), "dt", "x")
SCHEMA = "k long, dt date, x double"
DAY = datetime.date(2001, 1, 1)


def series(spark, values, k=1):
    return spark.createDataFrame([(k, DAY + datetime.timedelta(i), v) for i, v in enumerate(values)], SCHEMA)


def trimmed(values):
    v = list(values)
    for pick in (max, min):
        if v:
            v.remove(pick(v))
    mean = lambda part: sum(part) / len(part) if part else 0.0
    n = len(v)
    cut = lambda a, b: v[max(n - a, 0) : max(n - b, 0)]
    return 0.3 * mean(cut(3, 0)) + 0.3 * mean(cut(7, 0)) + 0.2 * mean(cut(14, 7)) + 0.1 * mean(cut(21, 14)) + 0.1 * mean(cut(28, 21))


@pytest.mark.parametrize("n", [1, 2, 3, 9, 30, 45])
def test_trimmed_recent(spark, n):
    r = random.Random(n)
    values = [float(r.randrange(6)) for _ in range(n)]
    got = recent.rolling_apply(series(spark, values), 30, recent.trimmed_recent, "t", SPEC).orderBy("dt").collect()
    assert [x.t for x in got] == pytest.approx([trimmed(values[max(0, i - 29) : i + 1]) for i in range(n)])


def test_recent_values_with_nulls_and_none(spark):
    df = series(spark, [None, 1.0, None, 3.0])
    got = recent.rolling_apply(df, 3, recent.mean_of, "m", SPEC).orderBy("dt").collect()
    assert [x.m for x in got] == [0.0, 1.0, 1.0, 2.0]
    assert recent.rolling_apply(df.limit(0), 3, recent.mean_of, "m", SPEC).count() == 0 == recent.capped_recent_mean(df.limit(0), spec=SPEC).count()
    ahead = recent.last_apply(series(spark, [1.0, 2.0, 4.0]), 30, lambda a: recent.carried_on(a, (0.2, 0.3, 0.5), 2), "a", SPEC).first().a
    assert ahead == pytest.approx([2.8, 0.4 + 1.2 + 1.4])
    assert recent.last_apply(series(spark, [1.0]), 30, lambda a: recent.carried_on(a, (0.5, 0.5), 2), "a", SPEC).first().a is None


def test_ranks_are_whole_whatever_the_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice("abc"), r.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v long, i long")
    for parts in (1, 7, 400):
        got = {x.i: x.n for x in features.ranked(df, ["v", "i"], "n", parts=parts).collect()}
        assert got == {i: n + 1 for n, (_, _, i) in enumerate(sorted(rows, key=lambda x: x[1:]))}
        got = {x.i: x.n for x in features.ranked(df, ["v", "i"], "n", ("g",), parts).collect()}
        assert got == {i: n + 1 for g in "abc" for n, (_, _, i) in enumerate(sorted((x for x in rows if x[0] == g), key=lambda x: x[1:]))}
    assert features.ranked(df.limit(0), ["v"], "n").count() == 0
    codes = spark.createDataFrame([("b",), ("b",), (None,), ("a",), ("c",)], "s string")
    assert {x.s: x.n for x in features.frequency_encoded(codes, "s", "n").collect()} == {"b": 0, "a": 1, "c": 2, None: None}
    assert {x.s: x.n for x in features.label_encoded(codes, "s", "n").collect()} == {"a": 0, "b": 1, "c": 2, None: None}


def test_no_window_holds_a_dimension_or_all_rows(spark):
    df = series(spark, [1.0] * 9).withColumns({"a": F.lit("x"), "b": F.lit(1)})
    plan = features.seasonal_index(df, ["a"], ["b"], SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    plan = features.equal_buckets(df.select("k", "x"), "x", 3, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(x" not in plan


def test_calendar_and_temperatures(spark):
    days = spark.createDataFrame([(DAY + datetime.timedelta(i),) for i in range(7)], "dt date")  # Monday to Sunday
    cal = spark.createDataFrame([("2001-01-03", "holiday"), ("2001-01-07", "swap"), ("2001-01-07", "swap")], "day string, kind string")
    got = features.calendar_flags(days, cal).orderBy("dt").collect()
    assert [x.is_holiday for x in got] == [0, 0, 1, 0, 0, 0, 0] and [x.is_workday for x in got] == [1, 1, 0, 1, 1, 0, 1]
    assert [x.holiday_or_eve for x in got] == [0, 1, 1, 0, 0, 0, 0] and [x.next_is_workday for x in got] == [1, 0, 1, 1, 0, 1, 1]
    rows = [(1, 1, s, DAY + datetime.timedelta(d), t, m) for s, d, t, m in ((1, 0, 999.0, 1), (2, 0, None, 1), (1, 40, 5.0, 2), (2, 40, None, 2), (1, 80, None, 3))]
    df = spark.createDataFrame(rows, "bu_id long, wh_id long, sku_id long, dt date, avg_t double, month long")
    got = {(x.sku_id, x.month): x.avg_t for x in cleaning.temperature_repaired(df).collect()}
    assert got == {(1, 1): 5.0, (2, 1): 5.0, (1, 2): 5.0, (2, 2): 5.0, (1, 3): 5.0}


def test_intraday_rows(spark):
    rows = [(1, DAY + datetime.timedelta(d), h, 1.0 + d, 2.0 + d) for d in range(9) for h in (3, 12, 20)]
    df = spark.createDataFrame(rows, "k long, dt date, hour int, cnt double, amt double")
    got = intraday.intraday_rows(df, ["k"], cuts=(12, 13)).orderBy("dt", "cut_hour").collect()
    assert [(x.dt.day, x.cut_hour, x.current_sum, x.y) for x in got] == [(8, 12, 8.0, 16.0), (8, 13, 16.0, 8.0), (9, 12, 9.0, 18.0), (9, 13, 18.0, 9.0)]
    assert got[0].y_lag1 == 14.0 and got[0].y_lag7 == 2.0 and got[0].y_mean == 8.0 and got[0].h12 == 8.0 and got[0].h00 == 0.0
    assert intraday.intraday_rows(df.limit(0), ["k"]).count() == 0
