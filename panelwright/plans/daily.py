"""Queries of daily runs: dates relative to the day of the run, and state carried from day to day."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import functions as F

from panelwright.operators import incremental as D
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import FORECAST_DATE, dense

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
X = "arranged_cnt"
#: Days that are run one by one, the last one before the forecast date; rate of the exponential mean.
N_DAYS, ALPHA = 5, 0.4
RUN_DAY, DELTA, TRAIN, TEST = "20010615", -14, -365, 19
EXCLUDED = ("2000-11-01", "2000-12-15")
_RUN = f"(DATE '2001-06-15' + {DELTA})"


@add("s2_relative_dates", f"SELECT {KEYS}, L(CASE WHEN dt < {_RUN} THEN 1 ELSE 0 END) in_train, L(count(*)) n_rows, R(sum({X})) total, min(dt) first_dt, max(dt) last_dt FROM {{pa}} WHERE dt BETWEEN {_RUN} + ({TRAIN}) AND {_RUN} + {TEST} AND dt NOT BETWEEN DATE '{EXCLUDED[0]}' AND DATE '{EXCLUDED[1]}' GROUP BY ALL")
def _(spark, d):
    rows = D.run_slice(dense(spark, d), D.run_dates(RUN_DAY, DELTA, TRAIN, TEST), excluded=[EXCLUDED], marked="in_train")
    return rows.groupBy(*K, "in_train").agg(F.count("*").alias("n_rows"), F.sum(X).alias("total"), F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))


@add("s2_daily_state_run", f"""WITH s AS (SELECT {KEYS}, dt, {X} x, lag({X}, 1) OVER ({W}) lag_1, lag({X}, 7) OVER ({W}) lag_7, avg({X}) OVER ({W} ROWS 6 PRECEDING) mean_7, avg({X}) OVER ({W} ROWS 27 PRECEDING) mean_28,
 avg({X}) OVER ({W} ROWS UNBOUNDED PRECEDING) expanding_mean, stddev_samp({X}) OVER ({W} ROWS UNBOUNDED PRECEDING) expanding_std, list({X}::DOUBLE) OVER ({W} ROWS UNBOUNDED PRECEDING) l FROM {{pa}}),
 t AS (SELECT * FROM s WHERE dt >= DATE '{FORECAST_DATE}' - {N_DAYS} AND dt < DATE '{FORECAST_DATE}')
 SELECT {KEYS}, dt last_dt, R(lag_1) lag_1, R(lag_7) lag_7, R(mean_7) mean_7, R(mean_28) mean_28, R(expanding_mean) expanding_mean, R(expanding_std) expanding_std, R(list_reduce(l, lambda a, v: a*(1-{ALPHA})+v) / ((1-pow(1-{ALPHA}, len(l)))/{ALPHA})) ewm_0 FROM t""")
def _(spark, d):
    first = datetime.date.fromisoformat(FORECAST_DATE) - datetime.timedelta(N_DAYS)
    days = [str(first + datetime.timedelta(k)) for k in range(N_DAYS)]
    panel = dense(spark, d).select(*K, "dt", X)
    inbox = files.write_and_read(panel.where(F.col("dt").between(F.lit(days[0]).cast("date"), F.lit(days[-1]).cast("date"))), "parquet", ["dt"])
    state = D.StateTable(spark)
    state.write(D.state_of(panel.where(F.col("dt") < F.lit(days[0]).cast("date")), alphas=(ALPHA,)), str(first - datetime.timedelta(1)))
    runs = [D.features(state.run_day(inbox, day, alphas=(ALPHA,)), [1, 7], [7, 28], (ALPHA,)).where(F.col("last_dt") == F.lit(day).cast("date")) for day in days]
    return reduce(lambda a, b: a.unionByName(b), runs)
