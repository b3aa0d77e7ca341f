"""State carried from day to day against the whole history in pandas, and dates of runs."""

import datetime
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwright.operators import incremental as D
from panelwright.operators.spec import PanelSpec
from panelwright.sources import files

SPEC = PanelSpec(("sku",), "dt", "x")
DAY = datetime.date(2001, 1, 1)
SCHEMA = "sku string, dt date, x double, mean int"


def rows(seed=4, n=24):
    """Series with gaps, nulls, late starts, one without any value and one with a single row."""
    r, out = random.Random(seed), []
    for k in range(12):
        for i in range(r.randrange(n // 2), n):
            if r.random() < 0.8:
                out.append((f"s{k}", DAY + datetime.timedelta(i), None if r.random() < 0.1 or k == 11 else 1e6 + r.gauss(0, 3), 7))
    return [*out, ("one", DAY + datetime.timedelta(9), 5.0, 7)]


def as_dict(state):
    return {r.sku: r.asDict() for r in state.collect()}


def near(got, want):
    assert got.keys() == want.keys()
    for k in want:
        for c, v in want[k].items():
            if isinstance(v, list):
                got[k][c], v = ([math.nan if y is None else y for y in z] for z in (got[k][c], v))
            assert got[k][c] == (pytest.approx(v, rel=1e-9, abs=1e-6, nan_ok=True) if isinstance(v, float | list) else v), (k, c)


def test_day_by_day_is_the_whole_run(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)  # with a column named like one of the state's
    table = D.StateTable(spark, f"file://{tmp_path}/state")
    df.write.partitionBy("dt").parquet(f"{tmp_path}/in")
    inbox = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in")
    for i in range(24):
        state = table.run_day(inbox, str(DAY + datetime.timedelta(i)), SPEC, 10, (0.3, 1.0))
    near(as_dict(state), as_dict(D.state_of(df, SPEC, 10, (0.3, 1.0))))
    assert state.inputFiles() and all("day=2001-01-24" in f for f in state.inputFiles())

    got = {r.sku: r for r in D.features(state, [0, 1, 9], [3, 10], (0.3, 1.0), SPEC).collect()}
    frame = pd.DataFrame(rows(), columns=["sku", "dt", "x", "mean"]).sort_values("dt")
    for sku, g in frame.groupby("sku"):
        x = g.x.astype(float).reset_index(drop=True)
        at = lambda k, x=x: x.iloc[-1 - k] if len(x) > k else math.nan
        there = x.dropna()
        want = [at(0), at(1), at(9), x.iloc[-3:].mean(), x.iloc[-10:].mean(), there.mean(), there.std(), there.ewm(alpha=0.3).mean().iloc[-1] if len(there) else math.nan, there.iloc[-1] if len(there) else math.nan]
        have = [math.nan if v is None else v for v in got[sku][2:]]
        assert got[sku].last_dt == g.dt.max() and have == pytest.approx(want, nan_ok=True, rel=1e-6, abs=1e-6), sku


def test_a_day_can_be_run_again_but_a_late_row_raises(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    table = D.StateTable(spark, f"file://{tmp_path}/state")
    assert table.read("2001-01-01") is None
    days = [str(DAY + datetime.timedelta(i)) for i in range(20, 24)]
    for day in days:
        once = as_dict(table.run_day(df, day, SPEC))
    again = [as_dict(table.run_day(df, day, SPEC)) for day in days[2:]]
    assert again[-1] == once and table.read("2001-02-01") is not None
    state = table.read("2001-03-01")
    with pytest.raises(Exception, match="not after its series' last day"):
        D.advanced(state, df.where(F.col("dt") == days[1]), SPEC).collect()
    assert as_dict(D.advanced(state, df.limit(0), SPEC)) == as_dict(state)


def test_empty_tables_and_days(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert D.state_of(none, SPEC, alphas=(0.5,)).count() == 0
    table = D.StateTable(spark, f"file://{tmp_path}/state")
    assert table.run_day(none, "2001-01-01", SPEC).count() == 0
    df = spark.createDataFrame([("a", DAY + datetime.timedelta(1), 2.0, 1)], SCHEMA)
    assert as_dict(table.run_day(df, "2001-01-02", SPEC))["a"]["recent"] == [2.0]


def test_a_day_reads_one_partition(spark):
    inbox = files.write_and_read(spark.createDataFrame(rows(), SCHEMA), "parquet", ["dt"])
    day = inbox.where(F.col("dt") == F.lit("2001-01-20").cast("date"))
    scans = [n for n in D.advanced(D.empty_state(inbox, SPEC), day, SPEC)._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in n]
    assert len(scans) == 1 and "PartitionFilters: [isnotnull(dt" in scans[0]


def test_dates_of_a_run(spark):
    d = D.run_dates("20010601")
    assert [str(x) for x in (d.train_start, d.train_end, d.forecast, d.test_end)] == ["1999-06-02", "2001-05-31", "2001-06-01", "2001-06-20"]
    assert D.run_dates("2001-06-01", 2, -10, 0).train_start == datetime.date(2001, 5, 24) and D.run_dates().forecast == datetime.date.today()
    for bad in ((0, 0), (-1, -1)):
        with pytest.raises(ValueError, match="negative"):
            D.run_dates("20010601", 0, *bad)
    days = [(i, DAY + datetime.timedelta(i)) for i in range(60)] + [(None, None)]
    df = spark.createDataFrame(days, "i int, dt date")
    got = {r.i: r.is_train for r in D.run_slice(df, D.run_dates("20010201", 0, -20, 4), excluded=[("2001-01-15", "2001-01-16"), ("2001-02-03", "2001-02-03")]).collect()}
    assert got == {i: int(i < 31) for i in range(11, 36) if i not in (14, 15, 33)}
