"""Queries of the cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.operators import cleaning as C
from panelwright.operators.spec import PanelSpec
from panelwright.plans.registry import add
from panelwright.sources.panels import dense, hourly, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
P = "PARTITION BY bu_id, wh_id, sku_id"
X = "arranged_cnt"


def out(df):
    return df.select(*K, "dt", F.col(X).alias("x"))


@add("c1_stockout_correction", f"SELECT {KEYS}, dt, R(CASE WHEN is_outstock=1 THEN greatest({X}, coalesce(avg({X}) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),{X}), coalesce(avg({X}) OVER ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),{X})) ELSE {X} END) x FROM {{pa}}")
def _(spark, d):
    return out(C.stockout_corrected(dense(spark, d)))


@add("c1b_p10b_row_removal", f"SELECT {KEYS}, dt, {X} x FROM {{pa}} WHERE NOT (is_outstock=1 AND {X}<2) AND price<>0")
def _(spark, d):
    return out(dense(spark, d).where(~((F.col("is_outstock") == 1) & (F.col(X) < 2)) & (F.col("price") != 0)))


@add("p10_p11_price_repair", f"SELECT {KEYS}, dt, R(CASE WHEN p<s THEN p ELSE s END) seq_price, L(CASE WHEN p<s OR (p=s AND seq_num>0) THEN 0 ELSE seq_num END) seq_num FROM (SELECT *, w_price p, coalesce(seq_price, w_price) s FROM {{pa}})")
def _(spark, d):
    # both prices are sums of the same lines, equal or not in their last bits
    df = dense(spark, d, in_order=True).withColumn("price", F.col("w_price"))
    return C.price_repaired(df).select(*K, "dt", "seq_price", "seq_num")


@add("c2_w18_temperature_repair", "WITH a AS (SELECT *, CASE WHEN abs(avg_t)<=100 THEN avg_t END t FROM {pa}), b AS (SELECT *, coalesce(t, avg(t) OVER (PARTITION BY bu_id, wh_id, month)) u FROM a) SELECT bu_id, wh_id, sku_id, dt, R(coalesce(u, first_value(u IGNORE NULLS) OVER (PARTITION BY bu_id, wh_id ORDER BY dt, sku_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(u IGNORE NULLS) OVER (PARTITION BY bu_id, wh_id ORDER BY dt, sku_id ROWS UNBOUNDED PRECEDING), 0)) t FROM b")
def _(spark, d):
    return C.temperature_repaired(dense(spark, d)).select(*K, "dt", F.col("avg_t").alias("t"))


@add("c3_c4_future_price", f"SELECT {KEYS}, dt, R(CASE WHEN is_train=0 THEN coalesce(arg_max(price, dt) FILTER (is_train=1) OVER ({P}), price) ELSE price END) price FROM {{pa}}")
def _(spark, d):
    return C.future_price_from_train(dense(spark, d)).select(*K, "dt", "price")


_OUT = f"WITH a AS (SELECT *, CASE WHEN seq_num>0 THEN 1 ELSE 0 END promo FROM {{pa}}), b AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY {KEYS}, promo ORDER BY dt)>=7 THEN avg({X}) OVER (PARTITION BY {KEYS}, promo ORDER BY dt ROWS 6 PRECEDING) END m FROM a), c AS (SELECT *, min(m) OVER w lo, max(m) OVER w hi, list(m) OVER w ms FROM b WINDOW w AS (PARTITION BY {KEYS}, promo ORDER BY dt ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING))"


def promo(spark, d):
    return dense(spark, d).withColumn("promo", (F.col("seq_num") > 0).cast("int"))


@add("c6_c21_window_outliers", _OUT + f" SELECT {KEYS}, dt, L(CASE WHEN {X}>1.5*lo OR {X}<0.3*hi THEN 1 ELSE 0 END) outlier FROM c")
def _(spark, d):
    return C.window_outliers(promo(spark, d), kind="promo", top=1.5, bottom=0.3).select(*K, "dt", "outlier")


@add("c8_window_clip", _OUT + f" SELECT {KEYS}, dt, R(CASE WHEN {X}<0.3*hi THEN 0.3*hi WHEN {X}>1.5*lo THEN 1.5*lo ELSE {X} END) x FROM c")
def _(spark, d):
    return out(C.window_clipped(promo(spark, d), kind="promo", top=1.5, bottom=0.3))


@add("c7_window_cap", _OUT + f" SELECT {KEYS}, dt, R(coalesce(list_max(list_filter(ms, lambda m: {X}>1.5*m))*1.5, {X})) x FROM c")
def _(spark, d):
    return out(C.window_capped(promo(spark, d), kind="promo", top=1.5))


@add("c9_quantile_cap", f"SELECT {KEYS}, dt, R(CASE WHEN {X}>quantile_cont({X},0.96) OVER ({P}) THEN quantile_cont({X},0.8) OVER ({P}) ELSE {X} END) x FROM {{pa}}")
def _(spark, d):
    return out(C.quantile_capped(dense(spark, d)))


@add("c10_normal_cap", f"WITH a AS (SELECT *, CASE WHEN row_number() OVER ({W})>=7 THEN avg({X}) OVER ({W} ROWS 6 PRECEDING) END s0 FROM {{pa}}), b AS (SELECT *, coalesce(s0, first_value(s0 IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) s FROM a), c AS (SELECT *, CASE WHEN row_number() OVER ({W})>=7 THEN stddev_samp({X}-s) OVER ({W} ROWS 6 PRECEDING) END d0 FROM b), e AS (SELECT *, coalesce(d0, first_value(d0 IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) d FROM c) SELECT {KEYS}, dt, R(CASE WHEN {X}>s+1.644854*d THEN s+0.253347*d ELSE {X} END) x FROM e")
def _(spark, d):
    return out(C.normal_capped(dense(spark, d)))


@add("c11_lognormal_cap", f"WITH a AS (SELECT *, count(CASE WHEN {X}>0 THEN 1 END) OVER ({P}) n, avg(CASE WHEN {X}>0 THEN ln({X}) END) OVER ({P}) mu, stddev_pop(CASE WHEN {X}>0 THEN ln({X}) END) OVER ({P}) sd FROM {{pa}}) SELECT {KEYS}, dt, R(CASE WHEN n>=10 AND {X}>greatest(exp(mu+1.644854*sd),10) THEN exp(mu+0.253347*sd) ELSE {X} END) x FROM a")
def _(spark, d):
    return out(C.lognormal_capped(dense(spark, d)))


@add("c12_coverage_cap", f"WITH r AS (SELECT {KEYS}, {X} x, row_number() OVER (PARTITION BY {KEYS} ORDER BY {X}, dt)-1 i, count(*) OVER ({P}) n FROM {{pb}}), p AS (SELECT {KEYS}, q, x b FROM r, range(60,101) t(q) WHERE i=CAST(round_even((n-1)*q/100.0::DOUBLE,0) AS INT)), c AS (SELECT p.bu_id, p.wh_id, p.sku_id, q, b, sum(CASE WHEN abs(x-b)<=2 OR x BETWEEN b*0.5 AND b*1.4 THEN 1 ELSE 0 END) cover FROM p JOIN r USING (sku_id) GROUP BY ALL), best AS (SELECT sku_id, arg_max(b, cover*1000-q) b FROM c GROUP BY ALL) SELECT {KEYS}, dt, R(least({X}, greatest(b+2, b*1.4))) x FROM {{pb}} JOIN best USING (sku_id)")
def _(spark, d):
    return out(C.coverage_capped(sparse(spark, d)))


@add("c13_promo_damping", f"SELECT {KEYS}, dt, R(CASE WHEN count({X}) OVER w=3 AND {X}>sum({X}) OVER w THEN sum({X}) OVER w/3 ELSE {X} END) x FROM {{pa}} WINDOW w AS ({W} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")
def _(spark, d):
    return out(C.promo_damped(dense(spark, d)))


@add("c14_c15_threshold_damping", f"WITH a AS (SELECT *, avg({X}) OVER ({P}) m FROM {{pa}}), b AS (SELECT * FROM a WHERE {X}<3*m), c AS (SELECT *, CASE WHEN count(*) OVER t=14 THEN avg({X}) OVER t END tr, CASE WHEN count(*) OVER c=14 THEN avg({X}) OVER c END mid FROM b WINDOW t AS ({W} ROWS 13 PRECEDING), c AS ({W} ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)) SELECT {KEYS}, dt, R(CASE WHEN {X}>3*tr AND {X}>10 AND mid IS NOT NULL THEN 3*mid ELSE {X} END) x FROM c")
def _(spark, d):
    return out(C.threshold_damped(C.mean_cut(dense(spark, d))))


@add("c16_daily_grid", f"WITH s AS (SELECT {KEYS}, unnest(generate_series(min(dt), max(dt), INTERVAL 1 DAY))::DATE dt FROM {{pa}} GROUP BY {KEYS}), j AS (SELECT s.*, b.{X} v FROM s LEFT JOIN {{pa}} b USING ({KEYS}, dt)) SELECT {KEYS}, dt, coalesce(v, first_value(v IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) x FROM j")
def _(spark, d):
    return out(C.daily(dense(spark, d)))


@add("c16_daily_grid_whole")
def _(spark, d):
    return out(C.daily(sparse(spark, d)))


@add("c17_hourly_grid", "WITH s AS (SELECT wh_id, sku, unnest(generate_series(min(ts_hour), max(ts_hour), INTERVAL 1 HOUR)) ts_hour FROM {ph} GROUP BY 1,2) SELECT wh_id, sku, strftime(ts_hour, '%Y-%m-%d %H') h, coalesce(cnt,0) cnt, R(coalesce(amt,0)) amt FROM s LEFT JOIN {ph} USING (wh_id, sku, ts_hour)")
def _(spark, d):
    g = C.every_hour(hourly(spark, d), ["wh_id", "sku"], "ts_hour", ["cnt", "amt"])
    return g.select("wh_id", "sku", F.date_format("ts_hour", "yyyy-MM-dd HH").alias("h"), "cnt", "amt")


@add("c18_left_padding", f"WITH t AS (SELECT {KEYS}, {X} x, 60-row_number() OVER ({W} DESC) place FROM {{pb}}), g AS (SELECT DISTINCT {KEYS}, place FROM {{pb}}, range(60) r(place)) SELECT {KEYS}, L(place) place, x FROM g LEFT JOIN t USING ({KEYS}, place)")
def _(spark, d):
    return C.left_padded(sparse(spark, d), 60).select(*K, "place", F.col(X).alias("x"))


@add("c19_validation_split")
def _(spark, d):
    return C.validation_marked(sparse(spark, d)).select(*K, "dt", "is_train")


@add("c20_complete_training_rows", f"SELECT {KEYS}, dt, {X} x FROM {{pa}} WHERE seq_price IS NOT NULL AND pro_price IS NOT NULL AND avg_t IS NOT NULL AND is_train=1")
def _(spark, d):
    return out(dense(spark, d).where("is_train = 1").dropna(subset=["seq_price", "pro_price", "avg_t"]))


HOURS = PanelSpec(keys=("wh_id", "sku"), date="ts_hour", target="cnt")
