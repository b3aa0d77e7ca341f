"""Queries of the forecast, combination and scoring operators, and of whole recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import boosting
from panelwright.operators import cleaning as C
from panelwright.operators import features as N
from panelwright.operators import forecast as G
from panelwright.operators import rolling as R
from panelwright.operators.spec import SERIES
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import FORECAST_DATE, dense, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
X = "arranged_cnt"
LAST = f"(SELECT *, row_number() OVER ({W} DESC) rn FROM {{pb}})"


@add("g1_two_means", f"SELECT {KEYS}, R((avg({X}) FILTER (rn<=7)+avg({X}) FILTER (rn<=14))/2) pred FROM {LAST} GROUP BY ALL")
def _(spark, d):
    return G.two_means(sparse(spark, d))


@add("g2_ses", f"SELECT {KEYS}, R(greatest(list_reduce(list({X} ORDER BY dt), lambda l, x: 0.71*x+0.29*l),0)) pred FROM {LAST} WHERE rn<=31 GROUP BY ALL")
def _(spark, d):
    return G.ses_forecast(sparse(spark, d))


@add("g3_ses_fitted")
def _(spark, d):
    return G.ses_fitted(sparse(spark, d))


@add("g4_holt_winters")
def _(spark, d):
    return G.holt_winters(dense(spark, d))


@add("g5_capped_recent_mean", f"WITH a AS (SELECT *, quantile_cont({X},0.96) OVER (PARTITION BY {KEYS}) q, quantile_cont({X},0.8) OVER (PARTITION BY {KEYS}) b, row_number() OVER ({W} DESC) rn FROM {{pb}}) SELECT {KEYS}, R(avg(CASE WHEN {X}>q THEN b ELSE {X} END)) pred FROM a WHERE rn<=4 GROUP BY ALL")
def _(spark, d):
    return G.recent_mean(C.quantile_capped(sparse(spark, d)), 4)


@add("g6_ridge")
def _(spark, d):
    df = R.lags(dense(spark, d), [1, 7, 14])
    return G.ridge(df, ["price", "lag_1", "lag_7", "lag_14"]).select(*K, "intercept", F.to_json("coef").alias("coef"))


@add("g7_pooled_linear")
def _(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    lags = [f"lag_{i}" for i in range(1, 15)]
    rows = R.lags(dense(spark, d), list(range(1, 15))).dropna(subset=lags)
    rows = VectorAssembler(inputCols=lags, outputCol="f").transform(rows)
    model = LinearRegression(featuresCol="f", labelCol=X, solver="normal").fit(rows.where("is_train = 1"))
    return model.transform(rows.where("is_train = 0")).select(*K, "dt", F.greatest("prediction", F.lit(0.0)).alias("pred"))


@add("g8_boosted_trees_by_cohort")
def _(spark, d):
    cols = ["price", "day_abbr", "month", "lag_1", "lag_7"]
    rows = R.lags(dense(spark, d), [1, 7]).dropna(subset=["lag_1", "lag_7"]).withColumn("cohort", (F.col("lag_7") > 25).cast("int"))
    rows = files.write_and_read(rows.select(*K, "dt", "is_train", X, "cohort", *cols), "parquet", [])
    marked = F.pmod(F.xxhash64(*K, "dt"), F.lit(20)) == 0
    model = boosting.fit(rows.where("is_train = 1"), cols, X, "cohort", marked, rounds=5, depth=4, loss="asymmetric")
    return boosting.predict(rows.where("is_train = 0"), model).select(*K, "dt", "cohort", F.greatest("pred", F.lit(0.0)).alias("pred"))


@add("g9_g15_a17_pooled_autoregression", f"WITH d AS (SELECT {KEYS}, cat1, dt, {X}-lag({X}) OVER ({W}) d FROM {{pa}}), l AS (SELECT cat1, d, lag(d,1) OVER ({W}) l1, lag(d,2) OVER ({W}) l2, lag(d,3) OVER ({W}) l3 FROM d) SELECT cat1, sum(d*d) r0, sum(d*l1) r1, sum(d*l2) r2, sum(d*l3) r3 FROM l GROUP BY cat1")
def _(spark, d):
    return G.pooled_ar(dense(spark, d), "cat1").select("cat1", "r0", "r1", "r2", "r3")


@add("g11_long_tail_rule", f"SELECT {KEYS}, R(CASE WHEN max(cat2)<'Brand#3' THEN arg_max({X}, dt) ELSE avg({X}) END) pred FROM {LAST} WHERE rn<=6 GROUP BY ALL")
def _(spark, d):
    return G.long_tail_rule(sparse(spark, d), F.col("cat2") < "Brand#3")


@add("g10_g12_recursive_smoothing", f"WITH a AS (SELECT {KEYS}, avg({X}) FILTER (rn<=7) m, max(dt) last FROM {LAST} GROUP BY ALL) SELECT {KEYS}, last + CAST(s AS INT) AS dt, R(m) pred FROM a, range(1,8) t(s)")
def _(spark, d):
    last = sparse(spark, d).groupBy(*K).agg(F.max("dt").alias("last"))
    rows = G.recent_mean(sparse(spark, d), 7).join(last, K)
    return rows.select(*K, F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", 7))).alias("dt"), "pred")


@add("g10_g12_recursive_linear")
def _(spark, d):
    return G.recursive_linear(sparse(spark, d), FORECAST_DATE, ("bu_id", "wh_id"))


@add("j11_z15_priority_ensemble", f"WITH f AS (SELECT {KEYS}, avg({X}) FILTER (dt>=DATE '2001-05-25') a, avg({X}) FILTER (dt>=DATE '2001-05-01') b, avg({X}) c FROM {{pb}} GROUP BY ALL) SELECT {KEYS}, R(coalesce(a,b,c)) pred FROM f")
def _(spark, d):
    return G.priority_means(sparse(spark, d), [F.col("dt") >= "2001-05-25", F.col("dt") >= "2001-05-01", F.lit(True)])


@add("j11_u4_tagged_priority", f"SELECT {KEYS}, R(coalesce(avg({X}) FILTER (dt>=DATE '2001-05-25'), avg({X})*2)) pred FROM {{pb}} GROUP BY ALL")
def _(spark, d):
    pb = sparse(spark, d)
    recent = pb.where("dt >= '2001-05-25'").groupBy(*K).agg(F.avg(X).alias("pred"))
    doubled = pb.groupBy(*K).agg((F.avg(X) * 2).alias("pred"))
    return G.first_available(G.union_tagged({"recent": recent, "doubled": doubled}, "model"), ["recent", "doubled"], K)


@add("g13_totals_and_vectors")
def _(spark, d):
    f = R.extrapolated(dense(spark, d), 20).withColumn("dt", F.date_add(F.lit("2001-06-01").cast("date"), F.col("step") - 1))
    return f.groupBy(*K).agg(F.sum("value").alias("total_fc"), S.to_json_series("dt", F.round("value", 3)).alias("daily_fc"))


@add("v2_v6_scores", f"WITH a AS (SELECT cat1, {X} a, lag({X},7) OVER ({W}) p FROM {{pa}}), b AS (SELECT *, abs(a-p) e FROM a WHERE p IS NOT NULL) SELECT cat1, R(sum((CASE WHEN a=0 THEN CASE WHEN p<1 THEN 0 ELSE 1 END ELSE e END)*a)/sum(a)) wmape_as_written, R(sum(e)/sum(a)) wmape, R(sqrt(avg(e*e))) rmse, R(sqrt(avg(e*e))/avg(abs(a))) nrmse, R(sum(e)/sum(abs(a))) nd, R(avg(CASE WHEN abs(a)+abs(p)>0 THEN 2*e/(abs(a)+abs(p)) ELSE 0 END)) smape, R(avg(CASE WHEN greatest(a,p)>0 THEN least(a,p)/greatest(a,p) END)) accuracy, R(avg(CASE WHEN p-a>1 THEN 0.5 ELSE 1 END*e*e)) asymmetric_loss FROM b GROUP BY cat1")
def _(spark, d):
    return G.scores(R.lags(dense(spark, d), [7]).dropna(subset=["lag_7"]), ["cat1"], X, "lag_7")


@add("z8_forecast_degradation", f"WITH a AS (SELECT {KEYS}, avg({X}) m FROM {LAST} WHERE rn<=28 GROUP BY ALL), p AS (SELECT {KEYS}, dt, {X}*2 pred FROM {{pb}} WHERE is_train=0) SELECT {KEYS}, dt, R(greatest(least(pred, 3*m), m/3)) pred, R(sum(greatest(least(pred, 3*m), m/3)) OVER (PARTITION BY {KEYS})) total FROM p JOIN a USING ({KEYS})")
def _(spark, d):
    pb = sparse(spark, d)
    p = pb.where("is_train = 0").select(*K, "dt", (F.col(X) * 2).alias("pred")).join(G.recent_mean(pb, 28, name="m"), K)
    p = p.withColumn("pred", S.clamp_to_mean("pred", "m"))
    return p.select(*K, "dt", "pred", F.sum("pred").over(SERIES.whole()).alias("total"))


@add("z2_category_features")
def _(spark, d):
    df = C.temperature_repaired(C.stockout_corrected(dense(spark, d)))
    df = C.window_clipped(df.withColumn("promo", (F.col("seq_num") > 0).cast("int")), kind="promo")
    df = files.write_and_read(df.select(*K, "dt", X, "cat1", "cat2", "day_abbr", "month", "avg_t", "is_train"), "parquet", [])
    df = N.seasonal_index(df, ["cat1", "cat2"], ["day_abbr", "month"], train=F.col("is_train") == 1)
    df = files.write_and_read(C.validation_marked(N.horizon_statistics(R.history_mean(df), 20)), "parquet", [])
    return N.with_volume_band(df, ["cat1"]).select(*K, "dt", "is_train", X, "avg_t", "history_mean", "known_mean_7", "idx_cat2_month", "band")


@add("z9_baseline_with_fallback")
def _(spark, d):
    pb = sparse(spark, d)
    tail = N.long_tail(pb).where("is_long_tail = 1")
    main = G.ses_forecast(pb.join(tail, K, "left_anti").where("dt >= '2000-01-01'"))
    return G.with_fallback(main, G.long_tail_rule(pb, F.lit(False)), K)
