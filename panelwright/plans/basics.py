"""Queries of scans, projections, dates, joins, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import forecast as G
from panelwright.operators import rolling as R
from panelwright.operators.spec import SERIES
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import dense, hourly, sparse, table

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
P = "PARTITION BY bu_id, wh_id, sku_id"


@add("s2_s3_date_range_scan", "SELECT l_orderkey, L(l_linenumber) l_linenumber, l_quantity FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' AND NOT (l_shipdate BETWEEN TIMESTAMP '1997-02-01' AND TIMESTAMP '1997-04-15')")
def _(spark, d):
    return files.date_range(table(spark, d, "lineitem"), "l_shipdate", "1996-01-01", "1998-12-31", excluded=("1997-02-01", "1997-04-15")).select("l_orderkey", "l_linenumber", "l_quantity")


@add("s6_predicate_lists", "SELECT l_orderkey, L(l_linenumber) l_linenumber FROM lineitem WHERE l_returnflag IN ('A','R') AND l_linestatus = 'F'")
def _(spark, d):
    return table(spark, d, "lineitem").where(S.in_lists(l_returnflag=["A", "R"], l_linestatus="F", l_tax=None)).select("l_orderkey", "l_linenumber")


@add("s7_u1_tagged_union", "SELECT 'orders' tag, o_orderkey k FROM orders UNION ALL SELECT 'lines', l_orderkey FROM lineitem")
def _(spark, d):
    return G.union_tagged({"orders": table(spark, d, "orders").select(F.col("o_orderkey").alias("k")), "lines": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))}, "tag")


for _fmt in ("orc", "parquet", "csv"):

    @add(f"s8_s12_{_fmt}_partitioned_sink", "SELECT cat1, sku_id, sum(arranged_cnt) total FROM {pa} GROUP BY ALL")
    def _(spark, d, fmt=_fmt):
        out = dense(spark, d).groupBy("cat1", "sku_id").agg(F.sum("arranged_cnt").alias("total"))
        return files.write_and_read(out, fmt, ["cat1"])


@add("p2_key_text", "SELECT bu_id||'_'||wh_id||'_'||sku_id AS unique_id, L(sku_id) sku_back FROM {pa} GROUP BY ALL")
def _(spark, d):
    k = dense(spark, d).select(S.key_text(*K).alias("unique_id")).distinct()
    return k.select("unique_id", F.split("unique_id", "_")[2].cast("long").alias("sku_back"))


@add("p3_arithmetic_projection", "SELECT L(s_suppkey) id, s_name||' '||s_nationkey AS name, L(s_nationkey*21) steps_to_desk FROM supplier")
def _(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.concat_ws(" ", "s_name", "s_nationkey").alias("name"), (F.col("s_nationkey") * 21).alias("steps_to_desk"))


@add("p4_v1_absolute_percentage_error", f"SELECT {KEYS}, dt, R(CASE WHEN a=0 AND p>=1 THEN p WHEN a=0 AND p<1 THEN 0 ELSE abs(p-a)/a END) ape FROM (SELECT {KEYS}, dt, CASE WHEN arranged_cnt<5 THEN 0 ELSE arranged_cnt END a, lag(arranged_cnt,7) OVER ({W}) p FROM {{pb}})")
def _(spark, d):
    df = R.lags(sparse(spark, d), [7]).withColumn("a", F.when(F.col("arranged_cnt") < 5, 0.0).otherwise(F.col("arranged_cnt")))
    return df.select(*K, "dt", S.absolute_percentage_error("a", "lag_7").alias("ape"))


@add("p5_clamp", f"SELECT {KEYS}, dt, R(greatest(least(arranged_cnt, 3*m), m/3)) v FROM (SELECT *, avg(arranged_cnt) OVER ({P}) m FROM {{pa}})")
def _(spark, d):
    return dense(spark, d).withColumn("m", F.avg("arranged_cnt").over(SERIES.whole())).select(*K, "dt", S.clamp_to_mean("arranged_cnt", "m").alias("v"))


@add("p6_p7_filter_and_fill", f"SELECT {KEYS}, dt, R(coalesce(seq_price,0)) seq_price, R(coalesce(avg_t,-1)) avg_t FROM {{pa}} WHERE arranged_cnt>3 OR is_outstock=0")
def _(spark, d):
    return dense(spark, d).where("arranged_cnt > 3 or is_outstock = 0").fillna({"seq_price": 0.0, "avg_t": -1.0}).select(*K, "dt", "seq_price", "avg_t")


@add("p8_p12_p13_nulls_and_flags", f"SELECT {KEYS}, dt, nullif(festival_name,'无') f, R(CASE WHEN abs(avg_t)<=100 THEN avg_t END) t, L(CASE WHEN festival_name<>'无' THEN 1 ELSE 0 END) flag FROM {{pa}}")
def _(spark, d):
    df = dense(spark, d).withColumn("f", S.empty_to_null(F.when(F.col("festival_name") == S.NONE_NAME, "").otherwise(F.col("festival_name"))))
    return df.select(*K, "dt", "f", S.range_or_null("avg_t").alias("t"), (F.col("festival_name") != S.NONE_NAME).cast("int").alias("flag"))


@add("p9_p16_row_extremes_and_rebates", f"SELECT {KEYS}, dt, R(least(price, coalesce(seq_price,price), coalesce(pro_price,price))) least_price, R((price-seq_price)/price) seq_rebate, R((price-pro_price)/price) pro_rebate, R((price-w_price)/price) real_rebate, L(seq_num+pro_num+csu_redu_num) total_num, (pro_num<>0 OR seq_num<>0 OR csu_redu_num<>0) promo FROM {{pa}}")
def _(spark, d):
    return dense(spark, d).select(*K, "dt", F.least("price", "seq_price", "pro_price").alias("least_price"), S.rebate("price", "seq_price").alias("seq_rebate"), S.rebate("price", "pro_price").alias("pro_rebate"), S.rebate("price", "w_price").alias("real_rebate"), (F.col("seq_num") + F.col("pro_num") + F.col("csu_redu_num")).alias("total_num"), S.any_promotion("pro_num", "seq_num", "csu_redu_num").alias("promo"))


@add("p17_p18_round_and_retype", "SELECT CAST(p_size AS VARCHAR) s, try_cast(substr(p_brand,7) AS BIGINT) b, R(p_retailprice) r FROM part")
def _(spark, d):
    return table(spark, d, "part").select(F.col("p_size").cast("string").alias("s"), F.substring("p_brand", 7, 10).try_cast("long").alias("b"), F.round("p_retailprice", 5).alias("r"))


@add("p19_infinite_to_mean", f"SELECT {KEYS}, dt, R(coalesce(x, avg(x) OVER (PARTITION BY bu_id))) x FROM (SELECT *, CASE WHEN seq_num>0 THEN arranged_cnt/seq_num END x FROM {{pa}})")
def _(spark, d):
    x = S.finite_or_null(F.when(F.col("seq_num") > 0, F.col("arranged_cnt") / F.col("seq_num")).otherwise(float("inf")))
    df = dense(spark, d).withColumn("x", x)
    return df.join(df.groupBy("bu_id").agg(F.avg("x").alias("m")), "bu_id").select(*K, "dt", F.coalesce("x", "m").alias("x"))


@add("p21_recode", "SELECT o_orderkey, L(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END) code FROM orders")
def _(spark, d):
    codes = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
    return table(spark, d, "orders").select("o_orderkey", F.try_element_at(F.create_map(*[F.lit(v) for kv in codes.items() for v in kv]), F.col("o_orderpriority")).alias("code"))


@add("p20_a6_json_series")
def _(spark, d):
    return dense(spark, d).where("dt >= '2001-05-01'").groupBy(*K).agg(S.to_json_series("dt", "arranged_cnt").alias("daily_fc_cnt"))


@add("p22_jitter")
def _(spark, d):
    return sparse(spark, d).select(*K, "dt", F.greatest("arranged_cnt", S.jitter(*K, "dt")).alias("v"), S.jitter(*K, "dt").alias("j"))


@add("d1_d5_date_parts", "SELECT k, dt, L(year(dt)*100+weekofyear(dt)) yr_wk, L(month(dt)) m, L(isodow(dt)-1) dow, L(day(dt)) dom, L(dayofyear(dt)) doy, L(ceil(day(dt)/7.0)) wom, L(ceil(dayofyear(dt)/7.0)) woy, L(dt - DATE '2021-01-01') gap, dt + 7 AS next_week FROM (SELECT o_orderkey k, CAST(o_orderdate AS DATE) dt FROM orders)")
def _(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.to_date(F.date_format("o_orderdate", "yyyyMMdd"), "yyyyMMdd").alias("dt"))
    return o.select("k", "dt", S.year_week("dt").alias("yr_wk"), F.month("dt").alias("m"), F.weekday("dt").alias("dow"), F.dayofmonth("dt").alias("dom"), F.dayofyear("dt").alias("doy"), S.week_of_month("dt").alias("wom"), S.week_of_year_by_days("dt").alias("woy"), S.day_number("dt").alias("gap"), F.date_add("dt", 7).alias("next_week"))


@add("d6_d10_calendar_flags", f"SELECT {KEYS}, dt, L(CASE WHEN festival_name<>'无' THEN 1 ELSE 0 END) is_holiday, L(CASE WHEN isodow(dt)>5 THEN 1 ELSE 0 END) is_weekend, L(CASE WHEN isodow(dt + 1)<=5 THEN 1 ELSE 0 END) next_is_workday, L(isodow(dt)) day_of_week FROM {{pa}}")
def _(spark, d):
    return dense(spark, d).select(*K, "dt", (F.col("festival_name") != S.NONE_NAME).cast("int").alias("is_holiday"), (F.weekday("dt") >= 5).cast("int").alias("is_weekend"), (F.weekday(F.date_add("dt", 1)) < 5).cast("int").alias("next_is_workday"), (F.weekday("dt") + 1).alias("day_of_week"))


@add("d7_weekday_times_median_lag", f"SELECT {KEYS}, dt, " + ", ".join(f"L(CASE WHEN isodow(dt)-1={i} THEN trunc(m) ELSE 0 END) w{i}" for i in range(7)) + f" FROM (SELECT *, CASE WHEN count(arranged_cnt) OVER ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING)=14 THEN quantile_cont(arranged_cnt,0.5) OVER ({W} ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) END m FROM {{pa}}) WHERE m IS NOT NULL")
def _(spark, d):
    df = R.rolling(dense(spark, d), [14], ["median"], shift=1).where("median_14_shift_1 is not null")
    return df.select(*K, "dt", *[F.when(F.weekday("dt") == i, F.col("median_14_shift_1").cast("long")).otherwise(0).alias(f"w{i}") for i in range(7)])


@add("d8_d9_festival_labels", f"SELECT {KEYS}, dt, CASE WHEN month(dt)=9 AND day(dt)=30 THEN 'eve' WHEN month(dt)=12 AND day(dt)=31 THEN 'year_end' ELSE regexp_replace(festival_name, ',[^,]*$', '') END f FROM {{pa}}")
def _(spark, d):
    return dense(spark, d).select(*K, "dt", S.date_label("dt", S.last_name_dropped("festival_name"), {(9, 30): "eve", (12, 31): "year_end"}).alias("f"))


@add("j1_j2_dimension_joins", "SELECT l_orderkey, L(l_linenumber) n, p_brand, s_name FROM lineitem JOIN part ON l_partkey=p_partkey LEFT JOIN supplier ON l_suppkey=s_suppkey WHERE p_size>10")
def _(spark, d):
    out = table(spark, d, "lineitem").join(table(spark, d, "part").where("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"))
    return out.join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left").select("l_orderkey", F.col("l_linenumber").alias("n"), "p_brand", "s_name")


@add("j3_j6_two_key_joins", f"SELECT a.sku_id, a.dt, a.arranged_cnt x, b.arranged_cnt y FROM {{pa}} a JOIN (SELECT sku_id, dt, sum(arranged_cnt) arranged_cnt FROM {{pb}} GROUP BY ALL) b ON a.sku_id=b.sku_id AND a.dt=b.dt")
def _(spark, d):
    b = sparse(spark, d).groupBy("sku_id", "dt").agg(F.sum("arranged_cnt").alias("y"))
    return dense(spark, d).select("sku_id", "dt", F.col("arranged_cnt").alias("x")).join(b, ["sku_id", "dt"])


@add("j4_j5_j7_semi_joins", f"SELECT {KEYS}, dt, arranged_cnt FROM {{pb}} WHERE sku_id IN (SELECT sku_id FROM {{pb}} GROUP BY sku_id HAVING avg(arranged_cnt)>27) AND cat1 IN (SELECT DISTINCT p_type FROM part WHERE p_size<20)")
def _(spark, d):
    pb = sparse(spark, d)
    good = pb.groupBy("sku_id").agg(F.avg("arranged_cnt").alias("m")).where("m > 27")
    kinds = table(spark, d, "part").where("p_size < 20").select(F.col("p_type").alias("cat1")).distinct()
    return pb.join(good, "sku_id", "left_semi").join(kinds, "cat1", "left_semi").select(*K, "dt", "arranged_cnt")


@add("j8_j9_anti_and_outer", "SELECT L(coalesce(a.sku_id, b.sku_id)) sku_id, a.sku_id IS NOT NULL in_a, b.sku_id IS NOT NULL in_b FROM (SELECT DISTINCT sku_id FROM {pb} WHERE dt<DATE '1996-01-01' AND sku_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity=50)) a FULL JOIN (SELECT DISTINCT sku_id FROM {pb} WHERE dt>=DATE '2001-01-01') b ON a.sku_id=b.sku_id")
def _(spark, d):
    pb = sparse(spark, d)
    full = table(spark, d, "lineitem").where("l_quantity = 50").select(F.col("l_partkey").alias("sku_id"))
    a = pb.where("dt < '1996-01-01'").select("sku_id").distinct().join(full, "sku_id", "left_anti").withColumn("in_a", F.lit(True))
    b = pb.where("dt >= '2001-01-01'").select("sku_id").distinct().withColumn("in_b", F.lit(True))
    return a.join(b, "sku_id", "outer").select("sku_id", F.coalesce("in_a", F.lit(False)).alias("in_a"), F.coalesce("in_b", F.lit(False)).alias("in_b"))


@add("j10_u6_train_test_alignment", f"SELECT {KEYS}, dt FROM (SELECT *, max(is_train) OVER ({P}) a, min(is_train) OVER ({P}) b FROM {{pb}}) WHERE a=1 AND b=0")
def _(spark, d):
    w = SERIES.whole()
    return sparse(spark, d).withColumns({"a": F.max("is_train").over(w), "b": F.min("is_train").over(w)}).where("a = 1 and b = 0").select(*K, "dt")


@add("j12_a8_two_level_means", "SELECT cat2, dt, R(t) total, R(avg(t) OVER (PARTITION BY cat2)) mean_total FROM (SELECT cat2, dt, sum(arranged_cnt) t FROM {pa} GROUP BY ALL)")
def _(spark, d):
    t = dense(spark, d).groupBy("cat2", "dt").agg(F.sum("arranged_cnt").alias("total"))
    return t.withColumn("mean_total", F.avg("total").over(Window.partitionBy("cat2")))


@add("j13_j14_grid_join", "SELECT g.cat1, L(g.m) m, coalesce(x.c, 0) c, L(coalesce(x.n, 0)) n FROM (SELECT * FROM (SELECT DISTINCT cat1 FROM {pa}) CROSS JOIN range(1,13) r(m)) g LEFT JOIN (SELECT cat1, month m, sum(arranged_cnt) c, count(*) n FROM {pa} WHERE day_abbr=0 AND dt<DATE '1995-06-01' GROUP BY ALL) x ON g.cat1=x.cat1 AND g.m=x.m")
def _(spark, d):
    pa = dense(spark, d)
    grid = pa.select("cat1").distinct().select("cat1", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    x = pa.where("day_abbr = 0 and dt < '1995-06-01'").groupBy("cat1", F.col("month").alias("m")).agg(F.sum("arranged_cnt").alias("c"), F.count("*").alias("n"))
    return grid.join(x, ["cat1", "m"], "left").fillna(0, ["c", "n"])


@add("j15_t10_day_lags", f"SELECT {KEYS}, dt, " + ", ".join(f"coalesce(max(arranged_cnt) OVER ({W} RANGE BETWEEN INTERVAL {k} DAYS PRECEDING AND INTERVAL {k} DAYS PRECEDING),0) prev_{k}" for k in range(1, 8)) + " FROM {pa}")
def _(spark, d):
    return R.day_lags(dense(spark, d), list(range(1, 8))).select(*K, "dt", *[f"prev_{k}" for k in range(1, 8)])


@add("j17_last_row_join", f"SELECT {KEYS}, dt, last_cnt FROM (SELECT * FROM {{pa}} WHERE is_train=0) JOIN (SELECT {KEYS}, arg_max(arranged_cnt, dt) last_cnt FROM {{pa}} WHERE is_train=1 GROUP BY ALL) USING ({KEYS})")
def _(spark, d):
    pa = dense(spark, d)
    last = pa.where("is_train = 1").groupBy(*K).agg(F.max_by("arranged_cnt", "dt").alias("last_cnt"))
    return pa.where("is_train = 0").join(last, K).select(*K, "dt", "last_cnt")


@add("a1_a5_group_aggregates", "SELECT cat1, R(sum(arranged_amt)) s, R(avg(price)) a, R(max(price)) mx, R(min(price)) mn, count(*) n, count(DISTINCT sku_id) series, max(count(*)) OVER () most FROM {pa} GROUP BY cat1 HAVING avg(arranged_cnt)>5")
def _(spark, d):
    g = dense(spark, d).groupBy("cat1").agg(F.sum("arranged_amt").alias("s"), F.avg("price").alias("a"), F.max("price").alias("mx"), F.min("price").alias("mn"), F.count("*").alias("n"), F.countDistinct("sku_id").alias("series"), F.avg("arranged_cnt").alias("m")).where("m > 5").drop("m")
    return g.crossJoin(g.agg(F.max("n").alias("most")))  # one row


@add("a3_first_by_order", "SELECT l_partkey, arg_min(l_orderkey, (l_shipdate, l_orderkey, l_linenumber)) k FROM lineitem GROUP BY ALL")
def _(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.min(F.struct("l_shipdate", "l_orderkey", "l_linenumber")).alias("m")).select("l_partkey", F.col("m.l_orderkey").alias("k"))


@add("a7_hour_pivot", "SELECT wh_id, sku, dt, " + ", ".join(f"coalesce(sum(cnt) FILTER (hour={h}),0) h{h}" for h in range(23)) + " FROM {ph} GROUP BY wh_id, sku, dt")
def _(spark, d):
    p = hourly(spark, d).groupBy("wh_id", "sku", "dt").pivot("hour", list(range(23))).agg(F.sum("cnt"))
    return p.fillna(0).withColumnsRenamed({str(h): f"h{h}" for h in range(23)})


@add("a9_a10_quantiles", f"SELECT {KEYS}, R(quantile_cont(arranged_cnt,0.25)) q1, R(quantile_cont(arranged_cnt,0.75)) q3, R(list_sort(list(arranged_cnt))[1+CAST(round_even((count(*)-1)*0.9::DOUBLE,0) AS INT)]) near90 FROM {{pa}} GROUP BY ALL")
def _(spark, d):
    a = F.sort_array(F.collect_list("arranged_cnt"))
    g = dense(spark, d).groupBy(*K).agg(F.percentile("arranged_cnt", F.lit(0.25)).alias("q1"), F.percentile("arranged_cnt", F.lit(0.75)).alias("q3"), a.alias("a"))
    return g.select(*K, "q1", "q3", F.get("a", F.bround((F.size("a") - 1) * 0.9).cast("int")).alias("near90"))


@add("a11_a12_harmonic_mean", f"SELECT {KEYS}, R(coalesce(pow(count(*) FILTER (x>0),2)/(count(*)*sum(1/x) FILTER (x>0)),0)) h FROM (SELECT *, arranged_cnt-10 x FROM {{pb}}) GROUP BY ALL")
def _(spark, d):
    x = F.col("arranged_cnt") - 10
    g = sparse(spark, d).groupBy(*K).agg(F.pow(F.count(F.when(x > 0, 1)), F.lit(2)).alias("a"), F.count("*").alias("n"), F.sum(F.when(x > 0, 1 / x)).alias("b"))
    return g.select(*K, F.coalesce(F.col("a") / (F.col("n") * F.col("b")), F.lit(0.0)).alias("h"))


@add("a13_a14_size_and_recency", f"SELECT {KEYS}, n, L(c) n_all FROM (SELECT {KEYS}, count(*) c, sum(arranged_cnt) FILTER (dt BETWEEN DATE '2001-05-02' AND DATE '2001-05-31') n FROM {{pb}} GROUP BY ALL) WHERE c>=20 AND coalesce(n,0)<>0")
def _(spark, d):
    g = sparse(spark, d).groupBy(*K).agg(F.count("*").alias("n_all"), F.sum(F.when(F.col("dt").between("2001-05-02", "2001-05-31"), F.col("arranged_cnt"))).alias("n"))
    return g.where("n_all >= 20 and coalesce(n, 0) <> 0")


@add("a15_recent_means", f"SELECT {KEYS}, R(avg(arranged_cnt) FILTER (rn<=28)) m28, R(avg(arranged_cnt) FILTER (rn<=14)) m14, R(avg(arranged_cnt) FILTER (rn<=6)) m6 FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM {{pb}}) GROUP BY ALL")
def _(spark, d):
    df = sparse(spark, d).withColumn("rn", F.row_number().over(Window.partitionBy(*K).orderBy(F.desc("dt"))))
    return df.groupBy(*K).agg(*[F.avg(F.when(F.col("rn") <= n, F.col("arranged_cnt"))).alias(f"m{n}") for n in (28, 14, 6)])


@add("w1_w4_r5_window_frames", f"SELECT {KEYS}, dt, R(avg(arranged_cnt) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) m3, R(avg(arranged_cnt) OVER ({W} ROWS BETWEEN 9 PRECEDING AND 3 PRECEDING)) m4_10, count(*) OVER ({P}) n FROM {{pb}}")
def _(spark, d):
    x = "arranged_cnt"
    return sparse(spark, d).select(*K, "dt", F.avg(x).over(SERIES.trailing(3)).alias("m3"), F.avg(x).over(SERIES.rows(-9, -3)).alias("m4_10"), F.count("*").over(SERIES.whole()).alias("n"))


@add("w5_w7_k4_ranks", f"SELECT {KEYS}, dt, arranged_cnt, L(rk) rk, L(code) code FROM (SELECT *, rank() OVER ({P} ORDER BY arranged_cnt DESC) rk, dense_rank() OVER (ORDER BY cat2)-1 code FROM {{pb}}) WHERE rk<=3")
def _(spark, d):
    from panelwright.operators.features import label_encoded

    pb = label_encoded(sparse(spark, d), "cat2", "code")
    return pb.withColumn("rk", F.rank().over(Window.partitionBy(*K).orderBy(F.desc("arranged_cnt")))).where("rk <= 3").select(*K, "dt", "arranged_cnt", "rk", "code")


@add("w8_w10_latest_statistics", f"SELECT {KEYS}, R(max(s)) total, R(arg_max(m21, dt)) latest_m21, R(arg_max(med21, dt)) latest_med21 FROM (SELECT *, sum(arranged_cnt) OVER ({P}) s, avg(arranged_cnt) OVER ({W} ROWS 20 PRECEDING) m21, quantile_cont(arranged_cnt,0.5) OVER ({W} ROWS 20 PRECEDING) med21 FROM {{pb}}) GROUP BY ALL")
def _(spark, d):
    df = R.rolling(sparse(spark, d), [21], ["mean", "median"], least=1)
    return df.groupBy(*K).agg(F.sum("arranged_cnt").alias("total"), F.max_by("mean_21", "dt").alias("latest_m21"), F.max_by("median_21", "dt").alias("latest_med21"))


@add("w11_rolling_statistics", f"SELECT {KEYS}, dt, " + ", ".join(f"R(CASE WHEN count(*) OVER ({W} ROWS {n - 1} PRECEDING)>={n} THEN {f}(arranged_cnt) OVER ({W} ROWS {n - 1} PRECEDING) END) {a}_{n}" for n in (7, 28) for a, f in (("mean", "avg"), ("max", "max"), ("min", "min"), ("std", "stddev_samp"))) + " FROM {pa}")
def _(spark, d):
    stats = ["mean", "max", "min", "std"]
    return R.rolling(dense(spark, d), [7, 28], stats).select(*K, "dt", *[f"{a}_{n}" for n in (7, 28) for a in stats])


@add("w12_w20_t7_lags_and_differences", f"SELECT {KEYS}, dt, lag(arranged_cnt,1) OVER ({W}) lag_1, lag(arranged_cnt,14) OVER ({W}) lag_14, arranged_cnt-lag(arranged_cnt,1) OVER ({W}) diff FROM {{pa}}")
def _(spark, d):
    return R.lags(dense(spark, d), [1, 14]).select(*K, "dt", "lag_1", "lag_14", (F.col("arranged_cnt") - F.col("lag_1")).alias("diff"))


@add("w13_t9_lagged_rolling", f"SELECT {KEYS}, dt, " + ", ".join(f"R(CASE WHEN count(*) OVER ({W} ROWS BETWEEN {s + n - 1} PRECEDING AND {s} PRECEDING)>={n} THEN avg(arranged_cnt) OVER ({W} ROWS BETWEEN {s + n - 1} PRECEDING AND {s} PRECEDING) END) mean_{n}_shift_{s}" for s in (1, 7) for n in (3, 7, 14, 28)) + " FROM {pa}")
def _(spark, d):
    df = dense(spark, d)
    for s in (1, 7):
        df = R.rolling(df, [3, 7, 14, 28], ["mean"], shift=s)
    return df.select(*K, "dt", *[f"mean_{n}_shift_{s}" for s in (1, 7) for n in (3, 7, 14, 28)])


@add("w14_w16_expanding_and_centered", f"SELECT {KEYS}, dt, R(avg(arranged_cnt) OVER ({W} ROWS UNBOUNDED PRECEDING)) expanding_mean, R(CASE WHEN count(*) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)=14 THEN avg(arranged_cnt) OVER ({W} ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING) END) centered_14 FROM {{pa}}")
def _(spark, d):
    return R.centered_mean(R.expanding_mean(dense(spark, d)), 14).select(*K, "dt", "expanding_mean", "centered_14")


@add("w15_exponential_means", f"SELECT {KEYS}, dt, R(list_reduce(list_prepend(0.0::DOUBLE, l), lambda a, x: a*0.5+x)/((1-pow(0.5::DOUBLE,len(l)))/0.5)) ewm_3 FROM (SELECT *, list(arranged_cnt) OVER ({W} ROWS 39 PRECEDING) l FROM {{pa}})")
def _(spark, d):
    return R.ewm(dense(spark, d), [3]).select(*K, "dt", "ewm_3")


@add("w17_w18_fills", f"SELECT {KEYS}, dt, R(coalesce(seq_price, first_value(seq_price IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(seq_price IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING), 0)) seq_price FROM {{pa}}")
def _(spark, d):
    return R.filled(dense(spark, d), ["seq_price"], constant=0.0).select(*K, "dt", "seq_price")


@add("w19_streaks", f"WITH a AS (SELECT *, CASE WHEN is_outstock=lag(is_outstock) OVER ({W}) THEN 0 ELSE 1 END ch FROM {{pa}}), b AS (SELECT *, sum(ch) OVER ({W}) g FROM a) SELECT {KEYS}, dt, L(row_number() OVER (PARTITION BY {KEYS}, g ORDER BY dt)-1) streak FROM b")
def _(spark, d):
    return R.streaks(dense(spark, d), col="is_outstock").select(*K, "dt", "streak")


@add("w21_w22_chunks", f"WITH a AS (SELECT *, row_number() OVER ({W})-1 i, count(*) OVER ({P}) n FROM {{pb}}), b AS (SELECT *, CAST(ceil(n/3.0) AS BIGINT) k FROM a) SELECT {KEYS}, dt, L(CASE WHEN i<(n%k)*(n//k+1) THEN i//(n//k+1) ELSE n%k+(i-(n%k)*(n//k+1))//(n//k) END) chunk, L(i//5) block FROM b")
def _(spark, d):
    df = R.near_equal_chunks(sparse(spark, d), 3)
    return df.select(*K, "dt", "chunk", F.floor((F.row_number().over(SERIES.series()) - 1) / 5).alias("block"))


@add("k6_last_dates", "SELECT DISTINCT dt FROM {pa} ORDER BY dt DESC LIMIT 45")
def _(spark, d):
    return dense(spark, d).select("dt").distinct().orderBy(F.desc("dt")).limit(45)


@add("u2_u6_set_operations", "(SELECT l_partkey k FROM lineitem WHERE l_quantity>45 UNION SELECT l_suppkey FROM lineitem WHERE l_quantity<3) INTERSECT SELECT l_partkey FROM lineitem WHERE l_discount=0.1::DOUBLE")
def _(spark, d):
    li = table(spark, d, "lineitem")
    u = li.where("l_quantity > 45").select(F.col("l_partkey").alias("k")).union(li.where("l_quantity < 3").select("l_suppkey")).distinct()
    return u.intersect(li.where(F.col("l_discount") == 0.1).select("l_partkey"))


@add("u5_r6_fallback_union", "SELECT sku_id, R(coalesce(a, b)) pred FROM (SELECT sku_id, avg(arranged_cnt) FILTER (dt>=DATE '2001-05-15') a, avg(arranged_cnt) b FROM {pb} GROUP BY sku_id)")
def _(spark, d):
    pb = sparse(spark, d)
    main = pb.where("dt >= '2001-05-15'").groupBy("sku_id").agg(F.avg("arranged_cnt").alias("pred"))
    return G.with_fallback(main, pb.groupBy("sku_id").agg(F.avg("arranged_cnt").alias("pred")), ["sku_id"])
