"""Queries that carry operators to their full definition: fallbacks, recursions, calendars, sinks, whole feature rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import cleaning as C
from panelwright.operators import features as N
from panelwright.operators import forecast as G
from panelwright.operators import intraday as I
from panelwright.operators import recent as Q
from panelwright.operators import rolling as R
from panelwright.operators.spec import PanelSpec
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import FORECAST_DATE, dense, hourly, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
X = "arranged_cnt"
LAST = f"(SELECT *, row_number() OVER ({W} DESC) rn FROM {{pb}})"
ORIGIN = f"DATE '{FORECAST_DATE}'"


def _fi(dim: str, frm: str) -> str:
    """The festival index by dim, as SQL."""
    return f"""(WITH d AS (SELECT {dim}, dt, festival_name f, sum({X}) t FROM {frm} GROUP BY ALL), r AS (SELECT {dim}, f, year(dt) y, min(dt) a, max(dt) b FROM d WHERE f<>'无' GROUP BY ALL),
 m AS (SELECT r.{dim}, r.f, y, avg(t) m FROM r JOIN d ON d.{dim}=r.{dim} AND d.f='无' AND d.dt BETWEEN a-15 AND b+15 GROUP BY ALL), s AS (SELECT {dim}, f, sum(m) base FROM m GROUP BY ALL)
 SELECT {dim}, f festival_name, avg(t)/max(base) idx FROM d JOIN s USING ({dim}, f) GROUP BY ALL)"""


_YEAR = "(SELECT * FROM {pb} WHERE dt BETWEEN DATE '1995-01-01' AND DATE '1995-12-31')"


@add("n4_index_fallback", f"SELECT cat1, cat2, festival_name, R(coalesce(b.idx, a.idx, 1)) idx FROM (SELECT DISTINCT cat1, cat2, festival_name FROM {_YEAR}) LEFT JOIN {_fi('cat1', _YEAR)} a USING (cat1, festival_name) LEFT JOIN {_fi('cat2', _YEAR)} b USING (cat2, festival_name)")
def _(spark, d):
    df = sparse(spark, d).where("dt between '1995-01-01' and '1995-12-31'")
    # day totals of both dimensions come from one aggregate, written out once
    days = files.write_and_read(df.groupBy("cat1", "cat2", "dt", "festival_name").agg(F.sum(X).alias(X)), "parquet", [])
    rows = days.select("cat1", "cat2", "festival_name").distinct()
    return N.index_with_fallback(rows, [(N.festival_index(days, [c]), [c, "festival_name"]) for c in ("cat2", "cat1")])


@add("j14_outer_merge", "WITH a AS (SELECT dt, cat2, sum(seq_num) seq FROM {pa} WHERE seq_num>0 GROUP BY ALL), b AS (SELECT dt, cat2, sum(pro_num) pro FROM {pa} WHERE pro_num>0 GROUP BY ALL) SELECT dt, cat2, L(seq) seq, L(pro) pro FROM a FULL JOIN b USING (dt, cat2)")
def _(spark, d):
    rows = dense(spark, d).where("seq_num > 0 or pro_num > 0")  # one aggregate with both measures instead of two and an outer join
    return rows.groupBy("dt", "cat2").agg(*[F.sum(F.when(F.col(f"{m}_num") > 0, F.col(f"{m}_num"))).alias(m) for m in ("seq", "pro")])


@add("k1_multi_column_sort", f"SELECT cat1, {KEYS}, dt, {X} FROM {{pa}} ORDER BY cat1, dt DESC, {KEYS}")
def _(spark, d):
    return dense(spark, d).select("cat1", *K, "dt", X).orderBy("cat1", F.desc("dt"), *K)


@add("k2_day_and_hour_sort", "SELECT wh_id, sku, dt, L(hour) AS hour, cnt FROM {ph} ORDER BY dt, hour, wh_id, sku")
def _(spark, d):
    return hourly(spark, d).select("wh_id", "sku", "dt", "hour", "cnt").orderBy("dt", "hour", "wh_id", "sku")


@add("s11_text_sink", "SELECT s_suppkey||'|'||s_name AS value FROM supplier")
def _(spark, d):
    lines = spark.read.parquet(f"{d}/supplier.parquet").select(F.concat_ws("|", "s_suppkey", "s_name").alias("value"))
    return files.text_round_trip(lines)


@add("s8_file_count_sink", f"SELECT 10 n_files, L(count(*)) n_rows, sum({X}) total FROM {{pa}}")
def _(spark, d):
    back = files.write_and_read(dense(spark, d).select(*K, "dt", X), "orc", [], n_files=10)
    return back.agg(F.countDistinct("file").alias("n_files"), F.count("*").alias("n_rows"), F.sum(X).alias("total"))


@add("s13_two_day_split_sink", f"SELECT t.dt, t.tag, L(count(*)) n_rows, sum({X}) total FROM {{pa}} JOIN (VALUES ({ORIGIN}, 't0'), ({ORIGIN}+1, 't1')) t(dt, tag) USING (dt) GROUP BY ALL")
def _(spark, d):
    days = {"t0": FORECAST_DATE, "t1": "2001-06-02"}
    frames = {tag: dense(spark, d).where(F.col("dt") == F.lit(day).cast("date")).select(*K, "dt", X) for tag, day in days.items()}
    back = files.write_and_read(G.union_tagged(frames, "tag"), "orc", ["dt"])
    return back.groupBy("dt", "tag").agg(F.count("*").alias("n_rows"), F.sum(X).alias("total"))


_TRIM = f"""WITH a AS (SELECT {KEYS}, dt, list({X}) OVER ({W} ROWS 29 PRECEDING) l FROM {{pa}}), b AS (SELECT *, list_position(l, list_max(l)) i FROM a), c AS (SELECT *, list_concat(l[1:i-1], l[i+1:len(l)]) m FROM b),
 e AS (SELECT *, list_position(m, list_min(m)) j FROM c), t AS (SELECT *, CASE WHEN len(m)=0 THEN m ELSE list_concat(m[1:j-1], m[j+1:len(m)]) END t, list_position(l[greatest(len(l)-9,1):greatest(len(l)-4,0)], list_max(l[greatest(len(l)-9,1):greatest(len(l)-4,0)])) k, l[greatest(len(l)-9,1):greatest(len(l)-4,0)] far, l[greatest(len(l)-2,1):len(l)] near FROM e)"""


def _ago(first: int, last: int) -> str:
    return f"coalesce(list_avg(t[greatest(len(t)-{first - 1},1):greatest(len(t)-{last},0)]),0)"


@add("w23_t8_trimmed_weighted_mean", _TRIM + f" SELECT {KEYS}, dt, R(.3*{_ago(3, 0)}+.3*{_ago(7, 0)}+.2*{_ago(14, 7)}+.1*{_ago(21, 14)}+.1*{_ago(28, 21)}) trimmed, R(CASE WHEN len(far)>1 THEN .5*(.2*near[1]+.3*near[2]+.5*near[3])+.5*list_avg(list_concat(far[1:k-1], far[k+1:len(far)])) ELSE 0 END) latest FROM t")
def _(spark, d):
    df = dense(spark, d).select(*K, "dt", X)
    return Q.rolling_apply(df, 30, {"trimmed": Q.trimmed_of_rows, "latest": Q.latest_of_rows}).select(*K, "dt", "trimmed", "latest")


@add("t8_carried_on", f"WITH RECURSIVE t AS (SELECT {KEYS}, list({X} ORDER BY dt) l FROM {LAST} WHERE rn<=3 GROUP BY ALL HAVING count(*)=3), r AS (SELECT {KEYS}, 0 step, l, 0.0::DOUBLE v FROM t UNION ALL SELECT {KEYS}, step+1, list_append(l, .2*l[-3]+.3*l[-2]+.5*l[-1]), .2*l[-3]+.3*l[-2]+.5*l[-1] FROM r WHERE step<6) SELECT {KEYS}, L(step) step, R(v) AS value FROM r WHERE step>0")
def _(spark, d):
    ahead = Q.last_apply(sparse(spark, d), 30, lambda a: Q.carried_on(a, (0.2, 0.3, 0.5), 6), "ahead")
    return ahead.select(*K, F.posexplode("ahead").alias("step", "value")).withColumn("step", F.col("step") + 1)


_HOLIDAYS = [f"{y}-{md}" for y in range(1992, 2003) for md in ("01-01", "01-02", "01-03", "05-01", "10-01", "10-02", "10-03", "12-25")]
_SWAPS = ["1995-12-31", "1996-04-28", "1996-09-29", "1997-05-04", "1997-09-28", "1998-04-26", "1998-10-10", "1999-04-25", "2000-04-29", "2000-10-08"]
_IN = lambda days: ", ".join(f"DATE '{x}'" for x in days)
_WORK = lambda x: f"(isodow({x})<=5 AND {x} NOT IN ({_IN(_HOLIDAYS)}) OR {x} IN ({_IN(_SWAPS)}))"


@add("d6_holiday_calendar", f"SELECT k, dt, L(dt IN ({_IN(_HOLIDAYS)})) is_holiday, L({_WORK('dt')}) is_workday, L(dt IN ({_IN(_HOLIDAYS)}) OR dt + 1 IN ({_IN(_HOLIDAYS)})) holiday_or_eve, L({_WORK('(dt + 1)')}) next_is_workday FROM (SELECT o_orderkey k, CAST(o_orderdate AS DATE) dt FROM orders)")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("dt"))
    days = [(x, "holiday") for x in _HOLIDAYS] + [(x, "swap") for x in _SWAPS]
    return N.calendar_flags(orders, spark.createDataFrame(days, "day string, kind string"))


@add("t13_activity_gate", f"SELECT {KEYS}, R(median(t)) med FROM (SELECT {KEYS}, dt, sum({X}) t FROM {{pb}} WHERE dt BETWEEN {ORIGIN}-8 AND {ORIGIN}-1 GROUP BY ALL) GROUP BY ALL HAVING median(t) BETWEEN 10 AND 40")
def _(spark, d):
    return I.active_series(sparse(spark, d), FORECAST_DATE, 10, 40)


_DAY = "SELECT wh_id, sku, dt, " + ", ".join(f"coalesce(sum(cnt) FILTER (hour={h}),0) h{h:02d}" for h in range(23)) + ", sum(amt)/sum(cnt) p FROM {ph} WHERE hour<=22 GROUP BY ALL"
_CUT = "(" + "+".join(f"CASE WHEN c.cut_hour>{h} THEN h{h:02d} ELSE 0 END" for h in range(23)) + ")"
_REST = "(" + "+".join(f"CASE WHEN c.cut_hour<={h} THEN h{h:02d} ELSE 0 END" for h in range(23)) + ")"
_G = "PARTITION BY wh_id, sku, cut_hour ORDER BY dt"
INTRADAY_SQL = f"""(WITH day AS ({_DAY}), r AS (SELECT day.*, c.cut_hour, {_CUT} current_sum, {_REST} y FROM day, range(12,23) c(cut_hour)), k AS (SELECT * FROM r WHERE current_sum>0 AND y>0),
 f AS (SELECT *, {', '.join(f'lag(y,{i}) OVER ({_G}) y_lag{i}' for i in range(1, 8))}, avg(y) OVER w y_mean, stddev_samp(y) OVER w y_std, median(y) OVER w y_median, min(y) OVER w y_min, max(y) OVER w y_max, p/avg(p) OVER w-1 price_growth FROM k WINDOW w AS ({_G} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
 SELECT *, month(dt) AS month, isodow(dt)-1 dow, day(dt) dom FROM f WHERE y_lag7 IS NOT NULL AND price_growth IS NOT NULL)"""
_NAMES = [f"y_lag{i}" for i in range(1, 8)] + ["y_mean", "y_std", "y_median", "y_min", "y_max", "price_growth"]


@add("t11_intraday_features", f"SELECT wh_id, sku, dt, L(cut_hour) cut_hour, current_sum, y, {', '.join(f'h{h:02d}' for h in range(23))}, {', '.join(f'R({c}) {c}' for c in _NAMES)}, L(month) AS month, L(dow) dow, L(dom) dom FROM {INTRADAY_SQL}")
def _(spark, d):
    return I.intraday_rows(hourly(spark, d), ["wh_id", "sku"])


@add("t12_hours_by_models", "SELECT wh_id, sku, L(cut_hour) cut_hour, model FROM (SELECT DISTINCT wh_id, sku FROM {ph}), range(12,23) c(cut_hour), (VALUES ('mean'), ('trees')) m(model)")
def _(spark, d):
    return I.expanded(hourly(spark, d).select("wh_id", "sku").distinct(), range(12, 23), ["mean", "trees"])


_FIVE = {"last": (1, 1), "m7": (7, 7), "m14": (14, 14), "m28": (28, 28), "ever": (None, None)}


@add("f5_five_elastic_volumes", f"WITH a AS (SELECT *, {', '.join(f'avg({c}) OVER ({W} ROWS BETWEEN ' + (f'{n} PRECEDING' if n else 'UNBOUNDED PRECEDING') + f' AND 1 PRECEDING) {t}_{m}' for m, (n, _) in _FIVE.items() for c, t in (('w_price', 'p'), (X, 'q')))} FROM {{pa}}) SELECT {KEYS}, dt, {', '.join(f'R(CASE WHEN q_{m} IS NULL THEN 0 ELSE greatest(0, q_{m}*(1-(w_price-p_{m})/p_{m}*1.3)) END) v_{m}' for m in _FIVE)} FROM a")
def _(spark, d):
    spec, df = PanelSpec(), dense(spark, d).withColumn("ed", F.lit(1.3))
    frames = {m: spec.rows(-n if n else -(1 << 31), -1) for m, (n, _) in _FIVE.items()}
    df = df.withColumns({f"{t}_{m}": F.avg(c).over(w) for m, w in frames.items() for c, t in (("w_price", "p"), (X, "q"))})
    df = N.elastic_volumes(df, {f"v_{m}": (f"p_{m}", f"q_{m}") for m in _FIVE})
    return df.select(*K, "dt", *[f"v_{m}" for m in _FIVE])


@add("e1_nearest_reference_price", f"WITH a AS (SELECT *, arranged_amt/{X} p FROM {{pa}}), b AS (SELECT *, avg(p) OVER ({W} ROWS 29 PRECEDING) m, (row_number() OVER ({W})-1)//3 b FROM a), c AS (SELECT *, CASE WHEN abs(p-m)/m>0.05 THEN m ELSE p END net FROM b), d AS (SELECT {KEYS}, dt, p, R(min(net) OVER (PARTITION BY {KEYS}, b)) ref FROM c), n AS (SELECT *, count(*) OVER (PARTITION BY {KEYS}, ref) n, row_number() OVER (PARTITION BY {KEYS}, ref ORDER BY dt)-1 i FROM d), k AS (SELECT *, CAST(ceil(n/3.0) AS BIGINT) k FROM n), g AS (SELECT *, CASE WHEN i<(n%k)*(n//k+1) THEN i//(n//k+1) ELSE n%k+(i-(n%k)*(n//k+1))//(n//k) END chunk FROM k) SELECT {KEYS}, ref ref_price, L(chunk) chunk, arg_min(dt, round(abs(p-ref),6)*1e9 + (dt - DATE '1990-01-01')) dt, R(arg_min(p, round(abs(p-ref),6)*1e9 + (dt - DATE '1990-01-01'))) nearest FROM g GROUP BY {KEYS}, ref, chunk")
def _(spark, d):
    df = N.reference_price(dense(spark, d)).withColumn("ref_price", F.floor(F.col("ref_price") * 10000 + 0.5000001) / 10000.0)
    return N.nearest_price(df.withColumn("p", F.col("arranged_amt") / F.col(X)), price="p").select(*K, "ref_price", "chunk", "dt", "nearest")


@add("f6_frequency_encoding", "WITH c AS (SELECT cat1, row_number() OVER (ORDER BY count(*) DESC, cat1)-1 code FROM {pb} GROUP BY cat1) SELECT bu_id, wh_id, sku_id, dt, L(code) code FROM {pb} JOIN c USING (cat1)")
def _(spark, d):
    return N.frequency_encoded(sparse(spark, d), "cat1", "code").select(*K, "dt", "code")


def _h(by: str, ws: tuple[str, str, str]) -> str:
    w = f"PARTITION BY {by} ORDER BY dt"
    return "+".join(f"{k}*avg({X}) OVER ({w} ROWS {n} PRECEDING)" for k, n in zip(ws, (6, 14, 29), strict=True))


_PW = f"PARTITION BY {KEYS}, promo ORDER BY dt"


@add("t2_promotion_history_mean", f"WITH p AS (SELECT *, CASE WHEN seq_num>0 THEN 1 ELSE 0 END promo FROM {{pb}}), a AS (SELECT *, {_h(KEYS + ', promo', ('.7', '.2', '.1'))} o, {_h(KEYS, ('1/3', '1/3', '1/3'))} g, max(is_train) OVER (PARTITION BY {KEYS}, promo) tr FROM p) SELECT {KEYS}, dt, R(CASE WHEN tr=1 THEN coalesce(lag(o) OVER ({_PW}), o) ELSE coalesce(lag(g) OVER ({W}), g) END) history_mean FROM a")
def _(spark, d):
    df = sparse(spark, d).withColumn("promo", (F.col("seq_num") > 0).cast("int"))
    return N.promotion_history_mean(df, "promo").select(*K, "dt", "history_mean")


@add("t5_festival_correction", f"WITH a AS (SELECT *, avg(CASE WHEN festival_name='无' THEN {X} END) OVER ({W} ROWS 2 PRECEDING) m FROM {{pa}}), b AS (SELECT *, coalesce(last_value(m IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING), {X}) f FROM a) SELECT {KEYS}, dt, R(CASE WHEN festival_name<>'无' THEN f*coalesce(i.idx,1) ELSE f END) v FROM b LEFT JOIN {_fi('cat1', '{pa}')} i USING (cat1, festival_name)")
def _(spark, d):
    df = dense(spark, d)
    index = N.festival_index(df, ["cat1"])
    rows = df.withColumn("plain", F.when(F.col("festival_name") == "无", F.col(X)))
    rows = R.filled(R.rolling(rows, [3], ["mean"], col="plain", least=1), ["mean_3"], order=("forward",))
    rows = N.index_with_fallback(rows, [(index, ["cat1", "festival_name"])])
    v = F.coalesce("mean_3", X)
    return rows.select(*K, "dt", F.when(F.col("festival_name") != "无", v * F.col("idx")).otherwise(v).alias("v"))


@add("g5_recent_mean_of_short_series", f"WITH r AS (SELECT * FROM {LAST} WHERE dt>=DATE '2000-09-01'), a AS (SELECT *, quantile_cont({X},0.96) OVER (PARTITION BY {KEYS}) q, quantile_cont({X},0.8) OVER (PARTITION BY {KEYS}) b, count(*) OVER (PARTITION BY {KEYS}) n FROM r) SELECT {KEYS}, R(CASE WHEN max(n)<7 THEN avg(CASE WHEN {X}>q THEN b ELSE {X} END) ELSE avg(CASE WHEN {X}>q THEN b ELSE {X} END) FILTER (rn<=4) END) pred FROM a GROUP BY ALL")
def _(spark, d):
    return Q.capped_recent_mean(C.quantile_capped(sparse(spark, d).where("dt >= '2000-09-01'")))


_SES = "list_reduce(list({x} ORDER BY dt), lambda l, x: 0.71*x+0.29*l)".format(x=X)


@add("g10_g12_recursive_first_order", f"""WITH p AS (SELECT * FROM {{pa}} WHERE dt<{ORIGIN}), m AS (SELECT cat1, regr_slope(y, x) b, regr_intercept(y, x) a FROM (SELECT cat1, {X} y, lag({X}) OVER ({W}) x FROM p) WHERE x IS NOT NULL GROUP BY cat1),
 t AS (SELECT {KEYS}, cat1, {_SES} ses, arg_max({X}, dt) y0, L({ORIGIN} - max(dt)) missing FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM p) WHERE rn<=31 GROUP BY ALL),
 v AS (SELECT *, CASE WHEN missing>31 THEN NULL WHEN missing<=7 AND b IS NOT NULL THEN 'linear' ELSE 'ses' END AS model FROM t LEFT JOIN m USING (cat1))
 SELECT {KEYS}, {ORIGIN} + CAST(s AS INT) AS dt, model, R(CASE WHEN model='linear' THEN greatest(pow(b,missing)*y0 + a*(pow(b,missing)-1)/(b-1), 0) WHEN model='ses' THEN greatest(ses, 0) END) pred FROM v, range(20) r(s)""")
def _(spark, d):
    return Q.recursive_first_order(dense(spark, d), FORECAST_DATE, "cat1")


_DET = "(r0*(r0*r0-r1*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r1-r0*r2))"


@add("g9_g15_pooled_arma", f"""WITH d AS (SELECT {KEYS}, cat1, dt, {X} y, {X}-lag({X}) OVER ({W}) d FROM {{pa}}), l AS (SELECT *, lag(d,1) OVER ({W}) l1, lag(d,2) OVER ({W}) l2, lag(d,3) OVER ({W}) l3 FROM d),
 r AS (SELECT cat1, sum(d*d) r0, sum(d*l1) r1, sum(d*l2) r2, sum(d*l3) r3 FROM l GROUP BY cat1),
 f AS (SELECT cat1, (r1*(r0*r0-r1*r1)-r1*(r2*r0-r1*r3)+r2*(r2*r1-r0*r3))/{_DET} phi1, (r0*(r2*r0-r3*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r3-r2*r2))/{_DET} phi2, (r0*(r0*r3-r1*r2)-r1*(r1*r3-r2*r2)+r1*(r1*r1-r0*r2))/{_DET} phi3 FROM r),
 e AS (SELECT *, d-phi1*l1-phi2*l2-phi3*l3 e FROM l JOIN f USING (cat1)), g AS (SELECT *, lag(e) OVER ({W}) e1 FROM e), h AS (SELECT cat1, sum(e*e1)/sum(e1*e1) theta FROM g WHERE e1 IS NOT NULL GROUP BY cat1)
 SELECT {KEYS}, cat1, R(phi1) phi1, R(phi2) phi2, R(phi3) phi3, R(theta) theta, R(greatest(y+phi1*d+phi2*l1+phi3*l2+theta*e, 0)) pred FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM g) JOIN h USING (cat1) WHERE rn=1""")
def _(spark, d):
    return Q.pooled_arma(dense(spark, d), "cat1")


_RUN = "SELECT cat1, sqrt(avg((a-p)*(a-p))) rmse, sum(abs(a-p))/sum(a) wmape, avg(CASE WHEN greatest(a,p)>0 THEN least(a,p)/greatest(a,p) END) accuracy FROM (SELECT cat1, {x} a, lag({x},{k}) OVER ({w}) p FROM {{pa}}) WHERE p IS NOT NULL GROUP BY cat1"


@add("v5_mean_scores_over_runs", f"SELECT cat1, R(avg(rmse)) rmse, R(avg(wmape)) wmape, R(avg(accuracy)) accuracy, L(count(*)) runs FROM ({' UNION ALL '.join(_RUN.format(x=X, k=k, w=W) for k in (1, 7, 14))}) GROUP BY cat1")
def _(spark, d):
    rows = R.lags(dense(spark, d), [1, 7, 14])
    runs = reduce(DataFrame.unionByName, [G.scores(rows.dropna(subset=[f"lag_{k}"]), ["cat1"], X, f"lag_{k}") for k in (1, 7, 14)])
    return runs.groupBy("cat1").agg(*[F.avg(m).alias(m) for m in ("rmse", "wmape", "accuracy")], F.count("*").alias("runs"))


@add("r6_routed_forecasts", f"""WITH g AS (SELECT {KEYS}, avg({X}-20) FILTER (rn<=14) m, count(*) FILTER (rn<=14 AND {X}>20) pos, count(*) FILTER (rn<=14) n, {_SES} FILTER (rn<=31) ses, avg({X}) FILTER (rn<=6) tail FROM {LAST} GROUP BY ALL),
 r AS (SELECT *, CASE WHEN m<=0 OR pos<=0 THEN 'no_sell' WHEN n<14 OR m<=0.5 OR pos<=1 THEN 'very_long_tail' WHEN m<=10 OR pos<=3 THEN 'long_tail' ELSE 'normal' END route FROM g)
 SELECT {KEYS}, route, R(CASE route WHEN 'no_sell' THEN 0 WHEN 'normal' THEN greatest(ses,0) ELSE tail END) pred FROM r""".replace(f"{_SES} FILTER (rn<=31)", f"list_reduce(list({X} ORDER BY dt) FILTER (rn<=31), lambda l, x: 0.71*x+0.29*l)"))
def _(spark, d):
    pb = sparse(spark, d)
    route = N.routed(pb.withColumn(X, F.col(X) - 20))
    of = lambda *names: route.where(F.col("route").isin(*names)).select(*K)
    main = G.ses_forecast(pb.join(of("normal"), K, "left_semi"))
    tail = G.recent_mean(pb.join(of("long_tail", "very_long_tail"), K, "left_semi"), 6)
    none = of("no_sell").withColumn("pred", F.lit(0.0))
    return route.join(G.with_fallback(G.with_fallback(main, tail, K), none, K), K)


@add("p20_series_as_json", f"SELECT {KEYS}, '{{' || string_agg('\"' || strftime(dt, '%Y%m%d') || '\":' || CAST(CAST({X} AS BIGINT) AS VARCHAR), ',' ORDER BY dt) || '}}' AS daily FROM {{pa}} WHERE dt>=DATE '2001-05-25' GROUP BY {KEYS}")
def _(spark, d):
    rows = dense(spark, d).where("dt >= '2001-05-25'").withColumn("n", F.col(X).cast("long"))
    return rows.groupBy(*K).agg(S.to_json_series("dt", "n").alias("daily"))
