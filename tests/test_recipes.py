"""Operators of the recipes in plain Python, recipes without SQL by what must hold of them, marks and formats of series."""

import collections
import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from panelwright.functions import scalars
from panelwright.operators import cleaning, features, rolling
from panelwright.operators.spec import PanelSpec
from panelwright.plans import recipes, registry
from panelwright.sources.panels import dense

DATA = "/root/testdata/sf0.001"
SPEC = PanelSpec(("k",), "dt", "x")
DAY = datetime.date(2001, 1, 1)


def panel(seed=1, n=30):
    """Series with gaps and nulls; festivals now and then, on the first day too; index null on some of them."""
    r, rows = random.Random(seed), []
    for k in range(8):
        for i in range(n):
            if r.random() < 0.8:
                f = "fest" if r.random() < 0.3 or (k == 0 and i < 4) else "无"
                rows.append((k, DAY + datetime.timedelta(i), None if r.random() < 0.1 else float(r.randrange(20)), f, r.choice([1.5, 2.0, None])))
    return rows


SCHEMA = "k int, dt date, x double, festival_name string, idx double"


def test_festival_scaled_mean(spark):
    got = {(r.k, r.dt): r.v for r in features.festival_scaled_mean(spark.createDataFrame(panel(), SCHEMA), "idx", SPEC, name="v").collect()}
    assert len(got) == len(panel())
    plain, means = collections.defaultdict(list), {}
    for k, dt, x, f, idx in panel():
        value = means.get(k, x)
        want = value if f == "无" or value is None else value * (idx or 1.0)
        assert got[k, dt] == (pytest.approx(want) if want is not None else None)
        if f == "无":
            plain[k].append(x)
            there = [v for v in plain[k][-3:] if v is not None]
            if there:
                means[k] = sum(there) / len(there)


def test_size_recency_and_band(spark):
    rows = [r for r in panel(2) if r[0] != 3 or r[1] < DAY + datetime.timedelta(9)] + [(20, DAY + datetime.timedelta(25), 0.0, "无", None), (None, DAY + datetime.timedelta(25), 4.0, "无", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    first, last = DAY + datetime.timedelta(10), DAY + datetime.timedelta(27)
    got = features.sized_and_recent(df, 22, str(first), str(last), SPEC).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {k for k, g in by.items() if k is not None and len(g) >= 22 and sum(r[2] or 0 for r in g if first <= r[1] <= last)}
    assert {r.k for r in got} == want and 0 < len(want) < 8 and len(got) == sum(len(by[k]) for k in want)
    late = {r.k for r in features.sized_and_recent(df, 3, str(first), str(last), SPEC, counted=F.col("dt") > str(last)).collect()}
    assert late == set()  # two days are left behind the last one
    band = {r.k: r.recent_band for r in features.recent_band(df, str(last), SPEC, days=15, last=4).collect()}
    for k, g in by.items():
        recent = [r[2] for r in sorted(g, key=lambda r: r[1]) if last - datetime.timedelta(15) <= r[1] < last][-4:]
        there = [x for x in recent if x is not None]
        assert (k in band) == bool(recent) and (not recent or band[k] == (int(sum(there) / len(there) // 5) if there else None))
    none = spark.createDataFrame([], SCHEMA)
    assert features.sized_and_recent(none, 1, str(first), str(last), SPEC).count() == features.recent_band(none, str(last), SPEC).count() == features.festival_scaled_mean(none, "idx", SPEC).count() == 0


def test_regional_models_are_clamped_and_from_their_regions(spark):
    rows = registry.queries()["z18_regional_models"](spark, DATA).collect()
    df = dense(spark, DATA).where(F.col("cat1").isin(recipes.REGIONS)).where("is_train = 1")
    mean = {(r.bu_id, r.wh_id, r.sku_id): r.m for r in df.groupBy(*recipes.K).agg(F.avg(recipes.X).alias("m")).collect()}
    assert {r.model for r in rows} == {"two_means", "ses", "linear", "trees"}
    per = collections.Counter((r.bu_id, r.wh_id, r.sku_id) for r in rows)
    assert set(per) <= set(mean) and max(per.values()) <= 4 and sum(n == 4 for n in per.values()) > len(per) / 2
    for r in rows:
        m = mean[r.bu_id, r.wh_id, r.sku_id]
        assert r.pred is None or m / 3 - 1e-3 <= r.pred <= 3 * m + 1e-3


def test_validation_marks(spark):
    rows = [(k, DAY + datetime.timedelta(i), 1.0, int(i < 50)) for k in range(200) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, dt date, x double, is_train int").repartition(5)
    runs = [{(r.k, r.dt): r.is_train for r in cleaning.validation_marked(d, SPEC).collect()} for d in (df, df.repartition(3))]
    was = {(k, dt): t for k, dt, _, t in rows}
    assert runs[0] == runs[1] and all(runs[0][k] == t for k, t in was.items() if not t)
    marked = sum(runs[0][k] != t for k, t in was.items())
    assert 0.04 < marked / 10_000 < 0.06


def test_jitter_is_small_stable_and_spread(spark):
    df = spark.range(5_000).select("id", scalars.jitter("id").alias("j"))
    a, b = ({r.id: r.j for r in d.collect()} for d in (df, df.repartition(7)))
    assert a == b and all(0.001 <= j <= 0.01 for j in a.values()) and len(set(a.values())) > 4_900
    assert abs(sum(a.values()) / 5_000 - 0.0055) < 0.0002


def test_totals_and_vectors(spark):
    ahead = {}
    for r in rolling.extrapolated(dense(spark, DATA), 20).collect():
        ahead.setdefault((r.bu_id, r.wh_id, r.sku_id), {})[r.step] = r.value
    got = registry.queries()["g13_totals_and_vectors"](spark, DATA).collect()
    assert len(got) == len(ahead) > 0
    for r in got:
        steps, daily = ahead[r.bu_id, r.wh_id, r.sku_id], json.loads(r.daily_fc)
        first = datetime.date(2001, 6, 1)
        assert r.total_fc == pytest.approx(sum(steps.values()), abs=1e-3) and len(daily) == 20
        assert {k: float(v) for k, v in daily.items()} == pytest.approx({(first + datetime.timedelta(s - 1)).strftime("%Y%m%d"): v for s, v in steps.items()}, abs=1e-3)
