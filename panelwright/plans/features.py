"""Queries of the feature, routing and price operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.operators import features as N
from panelwright.operators import rolling as R
from panelwright.operators.spec import PanelSpec
from panelwright.plans.registry import add
from panelwright.sources.panels import dense, hourly, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
P = "PARTITION BY bu_id, wh_id, sku_id"
X = "arranged_cnt"


@add("t1_history_mean", f"WITH a AS (SELECT *, (avg({X}) OVER ({W} ROWS 6 PRECEDING)+avg({X}) OVER ({W} ROWS 14 PRECEDING)+avg({X}) OVER ({W} ROWS 29 PRECEDING))/3 h FROM {{pa}}) SELECT {KEYS}, dt, R(coalesce(lag(h) OVER ({W}), h)) history_mean FROM a")
def _(spark, d):
    return R.history_mean(dense(spark, d)).select(*K, "dt", "history_mean")


@add("t2_history_mean_by_promotion", f"WITH p AS (SELECT *, CASE WHEN seq_num>0 THEN 1 ELSE 0 END promo FROM {{pa}}), a AS (SELECT *, .7*avg({X}) OVER (PARTITION BY {KEYS}, promo ORDER BY dt ROWS 6 PRECEDING)+.2*avg({X}) OVER (PARTITION BY {KEYS}, promo ORDER BY dt ROWS 14 PRECEDING)+.1*avg({X}) OVER (PARTITION BY {KEYS}, promo ORDER BY dt ROWS 29 PRECEDING) h FROM p) SELECT {KEYS}, dt, R(coalesce(lag(h) OVER (PARTITION BY {KEYS}, promo ORDER BY dt), h)) history_mean FROM a")
def _(spark, d):
    spec = PanelSpec(keys=(*K, "promo"))
    df = dense(spark, d).withColumn("promo", (F.col("seq_num") > 0).cast("int"))
    return R.history_mean(df, weights=(0.7, 0.2, 0.1), spec=spec).select(*K, "dt", "history_mean")


@add("t3_extrapolated_means", f"WITH RECURSIVE t AS (SELECT {KEYS}, list({X} ORDER BY dt) l FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM {{pa}}) WHERE rn<=30 GROUP BY ALL), r AS (SELECT {KEYS}, 0 step, l, 0.0::DOUBLE v FROM t UNION ALL SELECT {KEYS}, step+1, list_append(l, (list_avg(l[-7:])+list_avg(l[-15:])+list_avg(l[-30:]))/3), (list_avg(l[-7:])+list_avg(l[-15:])+list_avg(l[-30:]))/3 FROM r WHERE step<20) SELECT {KEYS}, L(step) step, R(v) AS value FROM r WHERE step>0")
def _(spark, d):
    return R.extrapolated(dense(spark, d), 20)


@add("t4_t5_festival_scaled_means", f"WITH a AS (SELECT *, avg(CASE WHEN festival_name='无' THEN {X} END) OVER ({W} ROWS 2 PRECEDING) m FROM {{pa}}), b AS (SELECT *, last_value(m IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING) f FROM a) SELECT {KEYS}, dt, R(CASE WHEN festival_name<>'无' THEN coalesce(f,{X})*1.5 ELSE coalesce(f,{X}) END) v FROM b")
def _(spark, d):
    df = dense(spark, d).withColumn("plain", F.when(F.col("festival_name") == "无", F.col(X)))
    df = R.filled(R.rolling(df, [3], ["mean"], col="plain", least=1), ["mean_3"], order=("forward",))
    v = F.coalesce("mean_3", X)
    return df.select(*K, "dt", F.when(F.col("festival_name") != "无", v * 1.5).otherwise(v).alias("v"))


@add("t6_f4_horizon_statistics", f"WITH a AS (SELECT *, coalesce(lag({X},20) OVER ({W}), first({X}) OVER ({W} ROWS UNBOUNDED PRECEDING)) y FROM {{pa}}) SELECT {KEYS}, dt, R(avg(y) OVER ({W} ROWS UNBOUNDED PRECEDING)) known_mean, R(avg(y) OVER ({W} ROWS 6 PRECEDING)) known_mean_7, R(max(y) OVER ({W} ROWS 6 PRECEDING)) known_max_7, R(min(y) OVER ({W} ROWS 13 PRECEDING)) known_min_14 FROM a")
def _(spark, d):
    return N.horizon_statistics(dense(spark, d), 20).select(*K, "dt", "known_mean", "known_mean_7", "known_max_7", "known_min_14")


@add("t7_g16_training_matrix", f"WITH a AS (SELECT {KEYS}, dt, {X} y, " + ", ".join(f"lag({X},{i}) OVER ({W}) lag_{i}" for i in range(1, 15)) + " FROM {pa}) SELECT * FROM a WHERE lag_14 IS NOT NULL")
def _(spark, d):
    return R.lags(dense(spark, d), list(range(1, 15))).where("lag_14 is not null").select(*K, "dt", F.col(X).alias("y"), *[f"lag_{i}" for i in range(1, 15)])


@add("t8_trimmed_recent_mean", f"WITH a AS (SELECT *, list({X}) OVER ({W} ROWS 29 PRECEDING) l FROM {{pa}}), b AS (SELECT *, list_sort(l) s FROM a WHERE len(l)=30) SELECT {KEYS}, dt, R((list_sum(s)-s[1]-s[30])/28) trimmed FROM b")
def _(spark, d):
    df = R.rolling(dense(spark, d), [30], ["sum", "min", "max"]).where("sum_30 is not null")
    return df.select(*K, "dt", ((F.col("sum_30") - F.col("min_30") - F.col("max_30")) / 28).alias("trimmed"))


@add("t11_t12_intraday_rows", "WITH h AS (SELECT wh_id, sku, dt, c.cut cut_hour, sum(cnt) FILTER (hour<c.cut) current_sum, sum(cnt) FILTER (hour>=c.cut) y FROM {ph}, range(12,23) c(cut) GROUP BY ALL) SELECT wh_id, sku, dt, L(cut_hour) cut_hour, current_sum, y, lag(y) OVER (PARTITION BY wh_id, sku, cut_hour ORDER BY dt) y_lag1 FROM h WHERE current_sum>0 AND y>0")
def _(spark, d):
    day = hourly(spark, d).groupBy("wh_id", "sku", "dt").agg(F.map_from_entries(F.collect_list(F.struct("hour", "cnt"))).alias("m"))
    rows = day.select("wh_id", "sku", "dt", "m", F.explode(F.sequence(F.lit(12), F.lit(22))).alias("cut_hour"))
    total = lambda keep: F.aggregate(F.map_values(F.map_filter("m", keep)), F.lit(0.0), lambda a, x: a + x)
    rows = rows.withColumns({"current_sum": total(lambda h, _: h < F.col("cut_hour")), "y": total(lambda h, _: h >= F.col("cut_hour"))}).where("current_sum > 0 and y > 0").drop("m")
    return R.lags(rows, [1], PanelSpec(("wh_id", "sku", "cut_hour"), "dt", "y")).withColumnRenamed("lag_1", "y_lag1")


@add("t13_t14_gates_and_bands", f"WITH a AS (SELECT *, row_number() OVER ({W} DESC) rn FROM {{pb}} WHERE dt>=DATE '2001-05-02') SELECT {KEYS}, R(median({X})) med, L(floor(avg({X}) FILTER (rn<=7)/5)) band FROM a GROUP BY ALL HAVING median({X}) BETWEEN 10 AND 40")
def _(spark, d):
    recent = sparse(spark, d).where("dt >= '2001-05-02'")
    med = recent.groupBy(*K).agg(F.percentile(X, F.lit(0.5)).alias("med")).where("med between 10 and 40")
    band = R.last_rows(recent, 7).groupBy(*K).agg(F.floor(F.avg(X) / 5).alias("band"))
    return med.join(band, K)


@add("n1_seasonal_index", f"SELECT {KEYS}, dt, " + ", ".join(f"R(avg(CASE WHEN is_train=1 THEN {X} END) OVER (PARTITION BY {a}, {b})/avg(CASE WHEN is_train=1 THEN {X} END) OVER (PARTITION BY {a})) idx_{a}_{b}" for a in ("cat1", "cat2") for b in ("day_abbr", "month")) + " FROM {pa}")
def _(spark, d):
    df = N.seasonal_index(dense(spark, d), ["cat1", "cat2"], ["day_abbr", "month"], train=F.col("is_train") == 1)
    return df.select(*K, "dt", *[f"idx_{a}_{b}" for a in ("cat1", "cat2") for b in ("day_abbr", "month")])


@add("n2_daily_total_index", f"WITH a AS (SELECT cat2, day_abbr, dt, sum({X}) t FROM {{pa}} GROUP BY ALL) SELECT cat2, L(day_abbr) day_abbr, R(avg(t)/max(w)) idx FROM a JOIN (SELECT cat2, avg(t) w FROM a GROUP BY cat2) USING (cat2) GROUP BY ALL")
def _(spark, d):
    return N.daily_total_index(dense(spark, d), ["cat2"], "day_abbr")


@add("n3_n4_j16_festival_index", f"WITH d AS (SELECT cat1, dt, festival_name f, sum({X}) t FROM {{pa}} GROUP BY ALL), r AS (SELECT cat1, f, year(dt) y, min(dt) a, max(dt) b FROM d WHERE f<>'无' GROUP BY ALL), m AS (SELECT r.cat1, r.f, y, avg(t) m FROM r JOIN d ON d.cat1=r.cat1 AND d.f='无' AND d.dt BETWEEN a-15 AND b+15 GROUP BY ALL), s AS (SELECT cat1, f, sum(m) base FROM m GROUP BY ALL) SELECT cat1, f festival_name, R(avg(t)/max(base)) idx FROM d JOIN s USING (cat1, f) GROUP BY ALL")
def _(spark, d):
    return N.festival_index(dense(spark, d), ["cat1"])


@add("n5_weekday_ratio", f"WITH r AS (SELECT cat2, isodow(dt)-1 weekday, avg({X})+0.01 m FROM {{pa}} WHERE dt IN (SELECT DISTINCT dt FROM {{pa}} ORDER BY dt DESC LIMIT 45) GROUP BY ALL), s AS (SELECT *, m/sum(m) OVER (PARTITION BY cat2) ratio FROM r) SELECT cat2, L(weekday) weekday, R(coalesce(ratio, 1/7.0::DOUBLE)) ratio FROM (SELECT DISTINCT cat2, w weekday FROM {{pa}}, range(7) t(w)) LEFT JOIN s USING (cat2, weekday)")
def _(spark, d):
    return N.weekday_ratio(dense(spark, d))


@add("n6_buyer_indices", "WITH l AS (SELECT wh_id, day_abbr, 'new_byrs' buyer, new_byrs v FROM {pa} UNION ALL SELECT wh_id, day_abbr, 'old_byrs', old_byrs FROM {pa}) SELECT wh_id, L(day_abbr) day_abbr, buyer, R(avg(v)/max(w)) idx FROM l JOIN (SELECT wh_id, buyer, avg(v) w FROM l GROUP BY ALL) USING (wh_id, buyer) GROUP BY ALL")
def _(spark, d):
    return N.buyer_indices(dense(spark, d), ["new_byrs", "old_byrs"], "day_abbr", ["wh_id"])


@add("b1_volume_band", f"WITH ds AS (SELECT cat1, dt d, min(dt) OVER (PARTITION BY cat1) f FROM (SELECT DISTINCT cat1, dt FROM {{pa}})), m AS (SELECT ds.cat1, sku_id, d, avg({X}) m FROM ds JOIN {{pa}} p ON p.cat1=ds.cat1 AND p.dt BETWEEN d-6 AND d WHERE d>=f+6 GROUP BY ALL), b AS (SELECT *, min(m) OVER w lo, max(m) OVER w hi FROM m WINDOW w AS (PARTITION BY cat1, d)) SELECT cat1, sku_id, d dt, L(CASE WHEN hi=lo THEN 2 ELSE 4-least(greatest(ceil((m-lo)/((hi-lo)/4)),1),4) END) band FROM b")
def _(spark, d):
    return N.volume_band(dense(spark, d), ["cat1"])


@add("f1_f2_promotion_statistics", f"SELECT {KEYS}, dt, R(max(r) OVER (PARTITION BY dt, cat2)) r_max, R(avg(r) OVER (PARTITION BY dt, cat2)) r_mean, L(sum(seq_num) OVER (PARTITION BY dt, cat1)) seq_num_cat1 FROM (SELECT *, (price-seq_price)/price r FROM {{pa}})")
def _(spark, d):
    df = N.promotion_counts(dense(spark, d).withColumn("r", (F.col("price") - F.col("seq_price")) / F.col("price")), ["cat1"], ["seq_num"])
    stats = N.discount_statistics(df, ["dt", "cat2"], ["r"])
    return df.join(stats, ["dt", "cat2"]).select(*K, "dt", "r_max", "r_mean", "seq_num_cat1")


@add("f3_f8_price_means_and_differences", f"WITH a AS (SELECT *, avg(w_price) OVER ({W} ROWS 6 PRECEDING) m FROM {{pa}}) SELECT {KEYS}, dt, R(w_price-coalesce(lag(m) OVER ({W}), m)) off_mean, R(coalesce(price-lag(price) OVER ({W}),0)) price_diff FROM a")
def _(spark, d):
    df = R.history_mean(dense(spark, d), (7,), (1.0,), col="w_price", name="m")
    diff = F.coalesce(F.col("price") - F.lag("price").over(PanelSpec().series()), F.lit(0.0))
    return df.select(*K, "dt", (F.col("w_price") - F.col("m")).alias("off_mean"), diff.alias("price_diff"))


_ED = f"WITH s AS (SELECT {KEYS}, cat2, dt, CASE WHEN count(*) OVER w=7 THEN avg(price) OVER w END p, avg({X}) OVER w q FROM {{pa}} WINDOW w AS ({W} ROWS 6 PRECEDING)), d AS (SELECT *, lead(p) OVER ({W})-p dp, lead(q) OVER ({W})-q dq FROM s WHERE p IS NOT NULL), e AS (SELECT *, -(dq/q)/(dp/p) e FROM d WHERE dp IS NOT NULL AND abs(dp)>1e-9), f AS (SELECT {KEYS}, quantile_cont(e,0.25) q1, quantile_cont(e,0.75) q3 FROM e GROUP BY ALL), g AS (SELECT {KEYS}, avg(e) ed FROM e JOIN f USING ({KEYS}) WHERE e BETWEEN q1-1.5*(q3-q1)-1e-9 AND q3+1.5*(q3-q1)+1e-9 GROUP BY ALL), h AS (SELECT {KEYS}, cat2, coalesce(ed,0) ed FROM (SELECT DISTINCT {KEYS}, cat2 FROM {{pa}}) LEFT JOIN g USING ({KEYS}))"


@add("e2_elasticity", _ED + f" SELECT {KEYS}, R(ed) ed FROM h")
def _(spark, d):
    return N.elasticity(dense(spark, d))


@add("e2_winsorised_elasticity", _ED + ", i AS (SELECT quantile_cont(ed,0.25) a, quantile_cont(ed,0.75) b FROM h), j AS (SELECT h.*, least(greatest(ed, a-1.5*(b-a)), b+1.5*(b-a)) e2 FROM h, i) SELECT sku_id, R(CASE WHEN e2>0 THEN e2 ELSE coalesce(avg(CASE WHEN e2>0 THEN e2 END) OVER (PARTITION BY cat2),1) END) ed FROM j")
def _(spark, d):
    pa = dense(spark, d)
    return N.winsorised_elasticity(N.elasticity(pa), pa.select(*K, "cat2").distinct()).select("sku_id", "ed")


@add("e3_ratio_elasticity", f"WITH d AS (SELECT {KEYS}, dt, lead(price) OVER ({W})/price-1 rp, lead({X}) OVER ({W})/{X}-1 rq FROM {{pa}}), f AS (SELECT {KEYS}, quantile_cont(rp,0.25) a, quantile_cont(rp,0.75) b FROM d GROUP BY ALL), g AS (SELECT d.*, (row_number() OVER (PARTITION BY {KEYS} ORDER BY rp, dt)-1)//5 g FROM d JOIN f USING ({KEYS}) WHERE rp BETWEEN a-1.5*(b-a)-1e-9 AND b+1.5*(b-a)+1e-9), h AS (SELECT {KEYS}, g, avg(rp) x, avg(rq) y FROM g GROUP BY ALL) SELECT {KEYS}, R(-regr_slope(y, x)) ratio_ed FROM h GROUP BY ALL")
def _(spark, d):
    return N.ratio_elasticity(dense(spark, d))


@add("e4_quadratic_elasticity")
def _(spark, d):
    return N.quadratic_elasticity(dense(spark, d).withColumn("price", F.col("price") / 1000))


@add("e5_f5_predicted_volume", f"SELECT {KEYS}, dt, R(greatest(0, lag({X}) OVER ({W})*(1-(price-lag(price) OVER ({W}))/lag(price) OVER ({W})*1.3))) ed_volume FROM {{pa}}")
def _(spark, d):
    df = N.predicted_volume(dense(spark, d).withColumn("ed", F.lit(1.3)))
    return df.select(*K, "dt", F.when(F.lag("dt").over(PanelSpec().series()).isNotNull(), F.col("ed_volume")).otherwise(0.0).alias("ed_volume"))


@add("e1_reference_price", f"WITH a AS (SELECT *, arranged_amt/{X} p FROM {{pa}}), b AS (SELECT *, avg(p) OVER ({W} ROWS 29 PRECEDING) m, (row_number() OVER ({W})-1)//3 b FROM a), c AS (SELECT *, CASE WHEN abs(p-m)/m>0.05 THEN m ELSE p END net FROM b) SELECT {KEYS}, dt, R(min(net) OVER (PARTITION BY {KEYS}, b)) ref_price FROM c")
def _(spark, d):
    return N.reference_price(dense(spark, d)).select(*K, "dt", "ref_price")


@add("f6_label_encodings", f"WITH r AS (SELECT cat1, cat2, row_number() OVER (PARTITION BY cat1 ORDER BY d, cat2)-1 seen FROM (SELECT cat1, cat2, min(dt) d FROM {{pb}} GROUP BY ALL)) SELECT {KEYS}, dt, L(dense_rank() OVER (ORDER BY cat2)-1) code, L(seen) seen FROM {{pb}} JOIN r USING (cat1, cat2)")
def _(spark, d):
    df = N.first_seen_encoded(N.label_encoded(sparse(spark, d), "cat2", "code"), "cat1", "cat2", "seen")
    return df.select(*K, "dt", "code", "seen")


@add("f7_poisson_demand", f"WITH a AS (SELECT {KEYS}, least(avg({X})/6, 7) lam FROM {{pb}} GROUP BY ALL), k AS (SELECT *, k, sum(exp(-lam)*pow(lam,k)/gamma(k+1)) OVER (PARTITION BY sku_id ORDER BY k) c FROM a, range(0,41) t(k)) SELECT {KEYS}, L(min(k) FILTER (c>0.85)) k FROM k GROUP BY ALL")
def _(spark, d):
    return N.poisson_quantile(sparse(spark, d).groupBy(*K).agg((F.avg(X) / 6).alias("rate")), "rate").select(*K, "k")


@add("r1_long_tail", f"WITH a AS (SELECT *, CASE WHEN count(*) OVER w=7 THEN sum({X}) OVER w END s FROM {{pb}} WINDOW w AS ({W} ROWS 6 PRECEDING)) SELECT {KEYS}, L(CASE WHEN count(*)>=7 THEN CASE WHEN avg(s)<7 THEN 1 ELSE 0 END WHEN sum({X})<count(*) THEN 1 ELSE 0 END) is_long_tail FROM a GROUP BY ALL")
def _(spark, d):
    return N.long_tail(sparse(spark, d))


@add("r2_router", f"WITH a AS (SELECT *, {X}-20 x, row_number() OVER ({W} DESC) rn FROM {{pb}}), g AS (SELECT {KEYS}, avg(x) m, count(*) FILTER (x>0) pos, count(*) n FROM a WHERE rn<=14 GROUP BY ALL) SELECT {KEYS}, CASE WHEN m<=0 OR pos<=0 THEN 'no_sell' WHEN n<14 THEN 'very_long_tail' WHEN m<=0.5 OR pos<=1 THEN 'very_long_tail' WHEN m<=10 OR pos<=3 THEN 'long_tail' ELSE 'normal' END route FROM g")
def _(spark, d):
    return N.routed(sparse(spark, d).withColumn(X, F.col(X) - 20))


@add("r3_w6_equal_buckets", f"WITH a AS (SELECT {KEYS}, sum({X}) s FROM {{pb}} GROUP BY ALL) SELECT {KEYS}, L((row_number() OVER (PARTITION BY bu_id ORDER BY s, {KEYS})-1)//300+1) bucket FROM a")
def _(spark, d):
    s = sparse(spark, d).groupBy(*K).agg(F.sum(X).alias("s"))
    return N.equal_buckets(s, "s", 300, K, within=["bu_id"]).select(*K, "bucket")


@add("r4_eligibility", f"WITH a AS (SELECT *, avg({X}) OVER ({W} ROWS 20 PRECEDING) m21, count(*) OVER ({W} ROWS 20 PRECEDING) c21, sum({X}) OVER ({W} ROWS 6 PRECEDING) s7, row_number() OVER ({W} DESC) rn FROM {{pb}}) SELECT {KEYS}, R(m21) m21 FROM a WHERE rn=1 AND m21 BETWEEN 20 AND 30 AND c21>=14 AND s7>0")
def _(spark, d):
    from pyspark.sql import Window

    df = R.rolling(R.rolling(sparse(spark, d), [21], ["mean"], least=14), [7], ["sum"], least=1)
    df = df.withColumn("rn", F.row_number().over(Window.partitionBy(*K).orderBy(F.desc("dt"))))
    return df.where("rn = 1 and mean_21 between 20 and 30 and sum_7 > 0").select(*K, F.col("mean_21").alias("m21"))


@add("sales_drop_cases", f"WITH a AS (SELECT *, lag({X},7) OVER ({W}) pred FROM {{pb}}), b AS (SELECT *, CASE WHEN {X}=0 AND pred>=1 THEN pred WHEN {X}=0 AND pred<1 THEN 0 ELSE abs(pred-{X})/{X} END ape FROM a), c AS (SELECT *, avg(ape) OVER ({W} ROWS 2 PRECEDING) ape_3, avg({X}) OVER ({W} ROWS 2 PRECEDING) mean_3, avg({X}) OVER ({W} ROWS BETWEEN 9 PRECEDING AND 3 PRECEDING) mean_4_10, count(*) OVER ({P}) n_rows, row_number() OVER ({W} DESC) rn FROM b) SELECT {KEYS}, dt, R(ape_3) ape_3, R(mean_3) mean_3, R(mean_4_10) mean_4_10, n_rows FROM c WHERE rn=1 AND ape_3>=0.5 AND 0.5*(mean_4_10+1)>mean_3+1 AND n_rows>10")
def _(spark, d):
    df = R.lags(sparse(spark, d), [7]).withColumnRenamed("lag_7", "pred_t0")
    return N.sales_drop_cases(df).select(*K, "dt", "ape_3", "mean_3", "mean_4_10", "n_rows")
