"""Queries of fitted and back-tested forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import backtest as B
from panelwright.operators import boosting
from panelwright.operators import forecast as G
from panelwright.operators import recent as Q
from panelwright.operators import rolling as R
from panelwright.operators import smoothing as M
from panelwright.operators.elasticity import curve_elasticity, elastic_predictions, positive_or_category, price_curves
from panelwright.operators.features import elasticity, poisson_demand, ratio_elasticity, weekday_ratio, winsorised_elasticity
from panelwright.operators.intervals import interval_join
from panelwright.operators.quantiles import exact_quantiles
from panelwright.operators.spec import SERIES
from panelwright.plans.features import _ED
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import FORECAST_DATE, HORIZON, dense, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
X = "arranged_cnt"
ORIGINS = ["2001-01-01", "2001-02-01", "2001-03-01", "2001-04-01", "2001-05-01", "2001-06-01"]
_ORIGINS_SQL = ", ".join(f"(DATE '{o}')" for o in ORIGINS)
_MODELS = {
    "mean_7": lambda df, spec: G.recent_mean(df, 7, spec),
    "ses": lambda df, spec: G.ses_forecast(df, spec, alpha=0.4),
    "two_means": lambda df, spec: G.two_means(df, spec),
}
_FORECASTS = f"""o(origin) AS (VALUES {_ORIGINS_SQL}),
 p AS (SELECT {KEYS}, origin, dt, {X} x, row_number() OVER (PARTITION BY {KEYS}, origin ORDER BY dt DESC) rn FROM {{pa}} JOIN o ON dt < origin AND dt >= origin - 365),
 f AS (SELECT {KEYS}, origin, avg(x) FILTER (rn<=7) mean_7, (avg(x) FILTER (rn<=7)+avg(x) FILTER (rn<=14))/2 two_means, greatest(list_reduce(list(x ORDER BY dt) FILTER (rn<=31), lambda l, v: 0.4*v+0.6*l), 0) ses FROM p GROUP BY ALL),
 l AS ({" UNION ALL ".join(f"SELECT {KEYS}, origin, '{m}' model, {m} pred FROM f" for m in _MODELS)}),
 t AS (SELECT {KEYS}, l.origin, model, {X} a, greatest(pred, 0) p, abs({X}-pred) e FROM {{pa}} a JOIN l USING ({KEYS}) WHERE dt >= l.origin AND dt < l.origin + 20 AND pred IS NOT NULL)"""
_MEASURES = "sqrt(avg(e*e)) rmse, sqrt(avg(e*e))/avg(abs(a)) nrmse, sum(e)/sum(abs(a)) nd, avg(CASE WHEN abs(a)+abs(p)>0 THEN 2*e/(abs(a)+abs(p)) ELSE 0 END) smape, avg(CASE WHEN greatest(a,p)>0 THEN least(a,p)/greatest(a,p) END) accuracy"


@add("v5_rolling_origin_scores", f"""WITH {_FORECASTS}, s AS (SELECT model, origin, {_MEASURES} FROM t GROUP BY model, origin)
 SELECT model, L(count(*)) n_origins, R(avg(rmse)) rmse, R(avg(nrmse)) nrmse, R(avg(nd)) nd, R(avg(smape)) smape, R(avg(accuracy)) accuracy FROM s GROUP BY model""")
def _(spark, d):
    return B.scored(B.backtest(dense(spark, d), ORIGINS, _MODELS, horizon=20, days=365))


@add("v5_scores_by_category_and_origin", f"""WITH {_FORECASTS}, c AS (SELECT DISTINCT {KEYS}, cat1 FROM {{pa}}), s AS (SELECT cat1, model, origin, {_MEASURES} FROM t JOIN c USING ({KEYS}) GROUP BY cat1, model, origin)
 SELECT cat1, model, L(count(*)) n_origins, R(avg(rmse)) rmse, R(avg(nrmse)) nrmse, R(avg(nd)) nd, R(avg(smape)) smape, R(avg(accuracy)) accuracy FROM s GROUP BY cat1, model""")
def _(spark, d):
    df = dense(spark, d)
    tested = B.backtest(df, ORIGINS, _MODELS, horizon=20, days=365)
    return B.scored(tested.join(df.select(*K, "cat1").distinct(), K), ("cat1", "model"))


@add("v5_best_model_by_backtest")
def _(spark, d):
    models = _MODELS | {"fitted": lambda df, spec: M.ses_optimised(df, spec).select(*spec.keys, "pred")}
    # one panel for all models; each forecasts a series by itself, so histories that no outcome follows aren't needed
    df = files.write_and_read(B.followed(sparse(spark, d).select(*K, "dt", X), ORIGINS, 20), "parquet", [])
    return B.best_model(B.backtest(df, ORIGINS, models, horizon=20, days=365))


@add("g3_ses_optimised")
def _(spark, d):
    return M.ses_optimised(sparse(spark, d), origin=FORECAST_DATE)


@add("g4_holt_winters_fitted_and_rescaled")
def _(spark, d):
    df = dense(spark, d)
    fit = M.holt_winters_fitted(df.where("is_train = 1"), period=4, steps=HORIZON)
    mean = G.recent_mean(df.where("is_train = 1"), 28, name="mean")
    ahead = M.rescaled(F.col("ahead"), F.col("mean"), *K)
    rows = fit.join(mean, K).select(*K, "a", "b", "g", F.posexplode(ahead).alias("step", "pred"))
    return rows.withColumn("dt", F.date_add(F.to_date(F.lit(FORECAST_DATE)), F.col("step"))).drop("step")


def _lines(x: str, y: str, one: str, two: str) -> str:
    """Sums about the mean of a regression on two columns."""
    about = lambda p, q: f"(sum({p}*{q})-sum({p})*sum({q})/count(*))"
    return f"{about(one, one)} c11, {about(one, two)} c12, {about(two, two)} c22, {about(one, y)} c1y, {about(two, y)} c2y"


#: Standardised ridge with lambda 1 on two columns: with S = n * sd^2 the system is (c11 + sd1^2, c12; c12, c22 + sd2^2).
@add("g6_ridge_forecast_blended", f"""WITH a AS (SELECT *, avg({X}) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) m7, avg({X}) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING) l1 FROM {{pa}}),
 b AS (SELECT *, price - avg(price) OVER (PARTITION BY {KEYS}) f1, m7 f2, {X}::DOUBLE y FROM a),
 r AS (SELECT {KEYS}, count(*) n, avg(f1) m1, avg(f2) m2, avg(y) my, {_lines('', 'y', 'f1', 'f2')} FROM b WHERE is_train=1 AND f1 IS NOT NULL AND f2 IS NOT NULL GROUP BY ALL HAVING count(*)>=60),
 q AS (SELECT *, c11+c11/n d11, c22+c22/n d22 FROM r), c AS (SELECT *, (c1y*d22-c2y*c12)/(d11*d22-c12*c12) b1, (c2y*d11-c1y*c12)/(d11*d22-c12*c12) b2 FROM q),
 z AS (SELECT {KEYS}, avg({X}) FILTER (rn<=7) m FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM {{pa}} WHERE is_train=1) GROUP BY ALL),
 f AS (SELECT {KEYS}, dt, CASE WHEN my+b1*(f1-m1)+b2*(f2-m2)<0 THEN 0 ELSE my+b1*(f1-m1)+b2*(f2-m2) END pred, m FROM b LEFT JOIN c USING ({KEYS}) LEFT JOIN z USING ({KEYS}) WHERE is_train=0)
 SELECT {KEYS}, dt, R(pred) ridge, R(CASE WHEN pred IS NULL THEN m WHEN m IS NULL THEN pred ELSE .6*pred+.4*m END) pred FROM f""")
def _(spark, d):
    df = R.rolling(dense(spark, d), [7], ["mean"], least=1, shift=1).withColumnRenamed("mean_7_shift_1", "f2")
    df = files.write_and_read(df.withColumn("f1", F.col("price") - F.avg("price").over(SERIES.whole())), "parquet", [])
    train = F.col("is_train") == 1
    ahead = G.ridge_forecast(df, ["f1", "f2"], train).withColumnRenamed("pred", "ridge")
    both = ahead.join(G.recent_mean(df.where(train), 7, name="m"), K, "left")
    return both.select(*K, "dt", "ridge", G.blended([(F.col("ridge"), 0.6), (F.col("m"), 0.4)]).alias("pred"))


@add("z1_promotion_fallback_blended")
def _(spark, d):
    """R5's cases, features, G6 on ten columns, .6 of it and .4 of T8, total and vector, written by day and model."""
    from panelwright.operators.features import sales_drop_cases

    df = dense(spark, d)
    cases = sales_drop_cases(R.lags(df, [7]).withColumnRenamed("lag_7", "pred_t0")).select(*K)
    rows = df.join(cases, K, "left_semi").fillna(0, ["seq_num", "pro_num", "csu_redu_num"]).withColumn("promotions", F.col("seq_num") + F.col("pro_num") + F.col("csu_redu_num"))
    rows = R.rolling(R.lags(rows, [1, 2, 7]), [7, 14], ["mean"], least=1, shift=1)
    rows = files.write_and_read(rows.withColumn("week_end", (F.col("day_abbr") >= 5).cast("int")), "parquet", [])
    names = ["price", "w_price", "promotions", "week_end", "month", "lag_1", "lag_2", "lag_7", "mean_7_shift_1", "mean_14_shift_1"]
    train = F.col("is_train") == 1
    ahead = G.ridge_forecast(rows, names, train).withColumnRenamed("pred", "ridge")
    recent = Q.last_apply(rows.where(train), 30, Q.trimmed_recent, "recent")
    pred = ahead.join(recent, K, "left").select(*K, "dt", G.blended([(F.col("ridge"), 0.6), (F.col("recent"), 0.4)]).alias("pred"))
    out = pred.groupBy(*K).agg(F.sum("pred").alias("total_fc"), S.to_json_series("dt", F.round("pred", 3)).alias("daily_fc"))
    return files.write_and_read(out.withColumns({"fc_dt": F.lit(FORECAST_DATE), "model_name": F.lit("promotion_blend")}), "orc", ["fc_dt", "model_name"])


@add("g8_rounds_by_cohort")
def _(spark, d):
    """The losses of every round, and which rounds count: trees of each volume band's rows under the asymmetric loss."""
    rows = R.lags(dense(spark, d), [1, 7]).dropna(subset=["lag_1", "lag_7"]).withColumn("band", F.least(F.floor(F.col("lag_7") / 20), F.lit(3)).cast("int"))
    marked = F.pmod(F.xxhash64(*K, "dt"), F.lit(20)) == 0
    model = boosting.fit(rows.where("is_train = 1"), ["price", "day_abbr", "lag_1", "lag_7"], X, "band", marked, rounds=3, depth=3, loss="asymmetric", patience=2)
    return model.losses.withColumnRenamed("cohort", "band")


_P = "PARTITION BY bu_id, wh_id, sku_id"


#: The curve's elasticity of each row (CTE x: y is cut off, not yet replaced).
_E4 = f"""WITH t AS (SELECT *, w_price/1000 wp FROM {{pa}}),
 a AS (SELECT {KEYS}, dt, count(*) OVER ({_P}) n, count(*) OVER w c, avg(wp) OVER w p, avg({X}) OVER w q FROM t WHERE is_train=1 AND csu_redu_num=0 WINDOW w AS ({W} ROWS 29 PRECEDING)),
 b AS (SELECT *, p*p*q gmv FROM a WHERE n>=15 AND c>=7), c AS (SELECT *, max(p) OVER ({_P}) top, min(p) OVER ({_P}) low, quantile_cont(gmv,0.25) OVER ({_P}) g1, quantile_cont(gmv,0.75) OVER ({_P}) g3 FROM b),
 e AS (SELECT *, (row_number() OVER ({_P} ORDER BY round(p,9), dt)-1)//5 g FROM c WHERE round(top,3)<>round(low,3) AND gmv BETWEEN g1-(g3-g1)-g3*1e-12 AND g3+(g3-g1)+g3*1e-12),
 f AS (SELECT {KEYS}, g, avg(p) p, avg(q) q FROM e GROUP BY ALL), h AS (SELECT *, avg(p) OVER ({_P}) m, stddev_pop(p) OVER ({_P}) s FROM f), u AS (SELECT *, (p-m)/s u FROM h WHERE s>0),
 z AS (SELECT {KEYS}, any_value(m) m, any_value(s) s, count(*)::DOUBLE s0, sum(u) s1, sum(u*u) s2, sum(u*u*u) s3, sum(u*u*u*u) s4, sum(q) t0, sum(u*q) t1, sum(u*u*q) t2 FROM u GROUP BY ALL),
 d AS (SELECT *, s4*(s2*s0-s1*s1)-s3*(s3*s0-s1*s2)+s2*(s3*s1-s2*s2) det FROM z),
 k AS (SELECT {KEYS}, m, s, (t2*(s2*s0-s1*s1)-s3*(t1*s0-s1*t0)+s2*(t1*s1-s2*t0))/det c2, (s4*(t1*s0-t0*s1)-t2*(s3*s0-s1*s2)+s2*(s3*t0-t1*s2))/det c1 FROM d WHERE det>1e-6*s0*s0*s0),
 r AS (SELECT {KEYS}, dt, cat2, coalesce(-(2*c2*(wp-m)/s+c1)/s, 0) ed FROM t LEFT JOIN k USING ({KEYS})),
 v AS (SELECT *, quantile_cont(ed,0.25) OVER (PARTITION BY cat2) a, quantile_cont(ed,0.75) OVER (PARTITION BY cat2) b FROM r), x AS (SELECT *, least(greatest(ed, a-1.5*(b-a)), b+1.5*(b-a)) y FROM v)"""
_SEC = "CASE WHEN y>0 THEN y ELSE coalesce(avg(y) FILTER (y>0) OVER (PARTITION BY cat2), 1) END"


@add("e4_curve_elasticity", f"{_E4} SELECT {KEYS}, dt, R({_SEC}) sec_ed FROM x")
def _(spark, d):
    df = dense(spark, d).select(*K, "dt", "cat2", "is_train", "csu_redu_num", X, (F.col("w_price") / 1000).alias("w_price"))
    curves = price_curves(df.where("is_train = 1 and csu_redu_num = 0"))
    return curve_elasticity(df, curves).select(*K, "dt", "sec_ed")


@add("a9_quantiles_by_narrowing", f"SELECT cat1, R(quantile_cont({X}, 0.25)) q1, R(quantile_cont({X}, 0.5)) q2, R(quantile_cont({X}, 0.96)) q96, R(quantile_cont(price, 0.25)) p1 FROM {{pb}} GROUP BY cat1")
def _(spark, d):
    pb = sparse(spark, d)
    volume = exact_quantiles(pb, ["cat1"], X, {"q1": 0.25, "q2": 0.5, "q96": 0.96})
    return volume.join(exact_quantiles(pb, ["cat1"], "price", {"p1": 0.25}), "cat1")


@add("j16_rows_near_promotions", f"SELECT p.wh_id, p.sku_id, p.dt, L(count(*)) near FROM {{pa}} p JOIN {{pa}} q ON p.wh_id=q.wh_id AND p.sku_id=q.sku_id AND p.dt BETWEEN q.dt-3 AND q.dt+3 WHERE q.seq_num>0 AND p.seq_num=0 GROUP BY ALL")
def _(spark, d):
    df = dense(spark, d)
    around = df.where("seq_num > 0").select("wh_id", "sku_id", F.date_sub("dt", 3).alias("first"), F.date_add("dt", 3).alias("last"))
    near = interval_join(df.where("seq_num = 0").select("wh_id", "sku_id", "dt"), around, ["wh_id", "sku_id"], "dt", "first", "last", bin_days=7)
    return near.groupBy("wh_id", "sku_id", "dt").agg(F.count("*").alias("near"))


@add("g2_ses_with_rules", f"""WITH q AS (SELECT *, quantile_cont({X},0.99) OVER ({_P}) a, quantile_cont({X},0.9) OVER ({_P}) b, row_number() OVER ({W} DESC) rn, count(*) OVER ({_P}) n FROM {{pb}}),
 y AS (SELECT *, CASE WHEN {X}>a THEN b ELSE {X} END y FROM q),
 g AS (SELECT {KEYS}, max(n) n, avg(y) m, avg(y) FILTER (rn<=3) m3, max(abs(y)) FILTER (rn<=5) z, max({X}) FILTER (rn=1) l1, max({X}) FILTER (rn=2) l2, list_reduce(list(y ORDER BY dt) FILTER (rn<=31), lambda l, v: 0.71*v+0.29*l) s FROM y GROUP BY ALL),
 r AS (SELECT *, CASE WHEN n<=2 THEN m WHEN z=0 AND n>=5 THEN m3 ELSE s END p, n>2 AND NOT (z=0 AND n>=5) AND n<=15 AND l2>=1 AND floor(l1/l2)>=5 jump FROM g)
 SELECT {KEYS}, L(step) step, R(CASE WHEN jump AND step=1 THEN (s+l1)/2 ELSE p END) AS value FROM r, range(1,21) t(step)""")
def _(spark, d):
    return M.ses_with_rules(sparse(spark, d))


@add("f7_poisson_weekday_demand", f"""WITH a AS (SELECT {KEYS}, cat2, avg({X})/6 rate, count(*) n_days FROM {{pb}} WHERE is_train=1 AND dt>=DATE '2001-01-01' GROUP BY ALL),
 k AS (SELECT {KEYS}, k, sum(exp(-least(rate,7))*pow(least(rate,7),k)/gamma(k+1)) OVER ({_P} ORDER BY k) c FROM a, range(0,41) t(k)), m AS (SELECT {KEYS}, min(k) FILTER (c>0.85) k FROM k GROUP BY ALL),
 w AS (SELECT cat2, isodow(dt)-1 weekday, avg({X})+0.01 m FROM {{pb}} WHERE dt IN (SELECT DISTINCT dt FROM {{pb}} ORDER BY dt DESC LIMIT 45) GROUP BY ALL), s AS (SELECT *, m/sum(m) OVER (PARTITION BY cat2) ratio FROM w)
 SELECT {KEYS}, L(a.weekday) weekday, R(greatest(k, least(rate,7))/n_days*7*coalesce(ratio, 1/7.0::DOUBLE)) demand FROM (SELECT * FROM a, range(7) t(weekday)) a JOIN m USING ({KEYS}) LEFT JOIN s ON s.cat2=a.cat2 AND s.weekday=a.weekday""")
def _(spark, d):
    pb = sparse(spark, d)
    rates = pb.where("is_train = 1 and dt >= '2001-01-01'").groupBy(*K, "cat2").agg((F.avg(X) / 6).alias("rate"), F.count("*").alias("days"))
    return poisson_demand(rates, weekday_ratio(pb)).select(*K, "weekday", "demand")


_RATIO = f"""(WITH d AS (SELECT {KEYS}, dt, lead(price) OVER ({W})/price-1 rp, lead({X}) OVER ({W})/{X}-1 rq FROM {{pa}}), f AS (SELECT {KEYS}, quantile_cont(rp,0.25) a, quantile_cont(rp,0.75) b FROM d GROUP BY ALL),
 g AS (SELECT d.*, (row_number() OVER ({_P} ORDER BY rp, dt)-1)//5 g FROM d JOIN f USING ({KEYS}) WHERE rp BETWEEN a-1.5*(b-a)-1e-9 AND b+1.5*(b-a)+1e-9), h AS (SELECT {KEYS}, g, avg(rp) x, avg(rq) y FROM g GROUP BY ALL),
 r AS (SELECT {KEYS}, -regr_slope(y, x) e FROM h GROUP BY ALL), c AS (SELECT * FROM (SELECT DISTINCT {KEYS}, cat2 FROM {{pa}}) LEFT JOIN r USING ({KEYS}))
 SELECT {KEYS}, CASE WHEN e>0 THEN e ELSE coalesce(avg(e) FILTER (e>0) OVER (PARTITION BY cat2), 1) END e FROM c)"""


@add("e3_ratio_elasticity_replaced", f"SELECT {KEYS}, R(e) ratio_ed FROM {_RATIO}")
def _(spark, d):
    df = dense(spark, d)
    return positive_or_category(ratio_elasticity(df), "ratio_ed", df.select(*K, "cat2").distinct()).select(*K, "ratio_ed")


@add("e5_four_elastic_volumes", f"""WITH w AS (SELECT * FROM ({_ED}, i AS (SELECT quantile_cont(ed,0.25) a, quantile_cont(ed,0.75) b FROM h), j AS (SELECT h.*, least(greatest(ed, a-1.5*(b-a)), b+1.5*(b-a)) e2 FROM h, i) SELECT {KEYS}, CASE WHEN e2>0 THEN e2 ELSE coalesce(avg(CASE WHEN e2>0 THEN e2 END) OVER (PARTITION BY cat2),1) END ed FROM j)),
 sec AS (SELECT {KEYS}, dt, s, avg(s) OVER ({_P}) ms FROM ({_E4} SELECT {KEYS}, dt, {_SEC} s FROM x)),
 t AS (SELECT *, w_price/1000 wp, arg_max({X}, dt) FILTER (is_train=1) OVER ({_P}) lq, arg_max(w_price/1000, dt) FILTER (is_train=1) OVER ({_P}) lp FROM {{pa}}),
 v AS (SELECT *, coalesce(CASE WHEN is_train=1 THEN lag(wp) OVER ({W}) ELSE lp END, wp) p0, coalesce(CASE WHEN is_train=1 THEN lag({X}) OVER ({W}) ELSE lq END, {X}) q0 FROM t)
 SELECT {KEYS}, dt, R(greatest(0, q0*(1-(wp-p0)/p0*ed))) v_ed, R(greatest(0, q0*(1-(wp-p0)/p0*e))) v_ratio, R(greatest(0, q0*(1-(wp-p0)/p0*s))) v_sec, R(greatest(0, q0*(1-(wp-p0)/p0*ms))) v_mean_sec FROM v JOIN w USING ({KEYS}) JOIN {_RATIO} USING ({KEYS}) JOIN sec USING ({KEYS}, dt)""")
def _(spark, d):
    df = dense(spark, d).select(*K, "dt", "cat2", "is_train", "csu_redu_num", "price", X, (F.col("w_price") / 1000).alias("w_price"))
    cats = df.select(*K, "cat2").distinct()
    ed = winsorised_elasticity(elasticity(df), cats).select(*K, "ed")
    ratio = positive_or_category(ratio_elasticity(df), "ratio_ed", cats).select(*K, "ratio_ed")
    rows = curve_elasticity(df.drop("price"), price_curves(df.where("is_train = 1 and csu_redu_num = 0")))
    rows = rows.withColumn("mean_sec_ed", F.avg("sec_ed").over(SERIES.whole())).join(ed, K).join(ratio, K)
    names = {"v_ed": "ed", "v_ratio": "ratio_ed", "v_sec": "sec_ed", "v_mean_sec": "mean_sec_ed"}
    return elastic_predictions(rows, names).select(*K, "dt", *names)
