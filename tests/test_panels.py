"""Panels whose lines lie in several files, and what recipes leave on disk."""

import datetime
import itertools
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelwright.operators import features, rolling
from panelwright.operators.spec import PanelSpec
from panelwright.plans import pricing, registry
from panelwright.sources import files

DATA = "/root/testdata/sf0.1"
DAY = datetime.datetime(1995, 12, 23)
#: Three lines of supplier 824: whether the sums' prices are equal, or which is higher, hangs on the order of addition.
LINES = [(11.0, 20694.56), (19.0, 20193.64), (18.0, 65342.29)]
DISCOUNT = 0.08


def test_prices_are_compared_as_summed_in_the_order_of_the_files(spark, tmp_path):
    # the lines in all orders, one a supplier; the second file is the larger one, so Spark reads it first
    found, want = [[], []], {}
    for sku, lines in enumerate(itertools.permutations(LINES), 1):
        cnt = amt = net = 0.0
        for i, (q, p) in enumerate(lines):
            found[i > 0].append((i, i, sku, 1, q, p, DISCOUNT, 0.0, "N", "O", DAY))
            cnt, amt, net = cnt + q, amt + p, net + p * (1 - DISCOUNT)
        want[sku] = 3 if net / cnt > amt / cnt * (1 - DISCOUNT) else 0
    found[1] += [(i, i, 7, 1, 1.0, 1.0 + i * 0.37, 0.01, 0.0, "N", "O", DAY) for i in range(20_000)]
    os.mkdir(tmp_path / "lineitem.parquet")
    for i, rows in enumerate(found):
        table = pa.table([list(c) for c in zip(*rows, strict=True)], schema=pq.read_schema(f"{DATA}/lineitem.parquet"))
        pq.write_table(table, tmp_path / "lineitem.parquet" / f"part-{i}.parquet")
    for name in ("supplier", "nation", "region"):
        os.symlink(f"{DATA}/{name}.parquet", tmp_path / f"{name}.parquet")
    got = {r.sku_id: r.seq_num for r in registry.queries()["p10_p11_price_repair"](spark, str(tmp_path)).collect()}
    assert set(want.values()) == {0, 3} and got == want | {7: 0}


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    table = files.write_and_read(spark.range(50_000).groupBy((F.col("id") % 977).alias("k")).agg(F.sum("id").alias("s")), "parquet", [])
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before and table.count() == 977


def test_rows_of_a_recipe_move_once_after_its_table(spark):
    df = registry.queries()["z11_hourly_static_features"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_exact_weights_don_t_move_rows_that_lie_by_series(spark):
    rows = [(k, DAY.date() + datetime.timedelta(i), float((k * 7 + i * i) % 11)) for k in range(4) for i in range(30)]
    df = spark.createDataFrame(rows, "sku int, dt date, x double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rolling.ewm_exact(df, 7, PanelSpec(("sku",), "dt", "x"), block=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "__block" in x]


def test_first_table_of_pricing_features_holds_only_what_later_steps_read(spark, monkeypatch):
    seen = []

    def stop(df, *done):
        seen.extend(df.columns)
        raise InterruptedError

    monkeypatch.setattr(pricing, "cut", stop)
    with pytest.raises(InterruptedError):
        registry.queries()["z4_pricing_features_whole"](spark, "/root/testdata/sf0.001")
    assert 0 < len(seen) <= 19


def test_long_tails_are_left_out_where_the_rows_lie(spark):
    spec = PanelSpec(("k",), "dt", "x")
    values = {1: [0.0, 1.0] * 6, 2: [3.0] * 12, 3: [0.0, 0.5, 1.0], 4: [2.0, 3.0], 5: [None] * 9, 6: [9.0] * 3 + [0.0] * 9}
    rows = [(k, DAY.date() + datetime.timedelta(i), x, int(i % 5 > 0 and k != 4)) for k, xs in values.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "k int, dt date, x double, is_train int").repartition(3)
    counted = F.col("is_train") == 1
    tail = features.long_tail(df.where(counted), spec).where("is_long_tail = 1")
    got = features.without_long_tail(df, counted, spec)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, df.join(tail, "k", "left_anti").select(df.columns).collect()), key=str)
    assert {r.k for r in got.collect()} == {2, 4, 5} | ({3, 6} - {r.k for r in tail.collect()}) and 1 in {r.k for r in tail.collect()}
    text = features.without_long_tail(df.repartition("k"), counted, spec)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_drinks_features_move_their_rows_once_after_their_tables(spark):
    df = registry.queries()["z3_drinks_features"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # rows, and a row a series for the join
