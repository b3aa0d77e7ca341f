"""Whole recipes: chains of operators as the jobs run them, from a panel to features or forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import boosting
from panelwright.operators import cleaning as C
from panelwright.operators import features as N
from panelwright.operators import forecast as G
from panelwright.operators import intraday as I
from panelwright.operators import recent as Q
from panelwright.operators import rolling as R
from panelwright.operators.spec import PanelSpec
from panelwright.plans.complete import INTRADAY_SQL
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import FORECAST_DATE, dense, hourly, sparse

K, KEYS = ["bu_id", "wh_id", "sku_id"], "bu_id, wh_id, sku_id"
W = "PARTITION BY bu_id, wh_id, sku_id ORDER BY dt"
X = "arranged_cnt"
SPEC = PanelSpec()
LAST = f"(SELECT *, row_number() OVER ({W} DESC) rn FROM {{pb}})"


#: Days in which a series must have sold something, rows that it needs in all or in the days to forecast, codes of festivals.
RECENT, ALL_ROWS, TEST_ROWS = ("2001-05-02", "2001-05-31"), 60, 3
FESTIVALS = {"newyear": 1, "xmas": 2, "mid,may": 3}


def trained():
    return F.col("is_train") == 1


def cut(df: DataFrame, *done: DataFrame) -> DataFrame:
    """df by way of a table in the shared folder: a frame that is joined with statistics of itself again and again would
    otherwise double its lineage each time, and a lost executor would cost all earlier work. Then the tables of earlier cuts
    that no later step reads are deleted, so that a recipe of any length holds two or three."""
    out = files.write_and_read(df, "parquet", [])
    for old in done:
        files.drop_written(old)
    return out


def promoted(df: DataFrame) -> DataFrame:
    return df.withColumn("promo", (F.col("seq_num") > 0).cast("int"))


def cleaned(df: DataFrame) -> DataFrame:
    """Stock-outs, prices, temperatures and promotions, as every feature job does them."""
    df = C.temperature_repaired(C.price_repaired(C.stockout_corrected(df)))
    return promoted(C.future_price_from_train(df))


def banded(df: DataFrame, within: list[str]) -> DataFrame:
    return cut(N.with_volume_band(df, within), df)


def buyers_by(df: DataFrame, by: str) -> DataFrame:
    """(wh_id, by, new_idx, old_idx): buyer counts against their warehouse's mean."""
    idx = N.buyer_indices(df, ["new_byrs", "old_byrs"], by, ["wh_id"]).groupBy("wh_id", by).pivot("buyer", ["new_byrs", "old_byrs"]).agg(F.first("idx"))
    return files.written_small(idx.withColumnsRenamed({"new_byrs": "new_idx", "old_byrs": "old_idx"}))


def indexed(df: DataFrame, table: DataFrame, on: list[str], name: str) -> DataFrame:
    return N.index_with_fallback(df, [(files.written_small(table), on)], name=name)


def boosted(rows: DataFrame, features: list[str], label: str, cohort: str, train, keep: list[str], depth: int = 4, rounds: int = 5) -> DataFrame:
    """(keep, cohort, pred): gradient-boosted trees for all cohorts at once, at least 0; a twentieth of the training rows,
    by a hash of the keys, says after how many rounds a cohort stops.

    A cohort without training rows has no forecasts. Rows with null features are dropped.
    """
    rows = cut(rows.dropna(subset=features).select(*dict.fromkeys([*keep, cohort, *features, label]), F.coalesce(train, F.lit(False)).alias("__train")))
    marked = F.pmod(F.xxhash64(*keep), F.lit(20)) == 0
    model = boosting.fit(rows.where("__train"), features, label, cohort, marked, rounds=rounds, depth=depth, written=True)
    out = boosting.predict(rows.where(~F.col("__train")), model)
    return out.select(*keep, cohort, F.greatest("pred", F.lit(0.0)).alias("pred"))


@add("z1_promotion_fallback_forecast", f"""WITH a AS (SELECT *, lag({X},7) OVER ({W}) pred FROM {{pb}}), b AS (SELECT *, CASE WHEN {X}=0 AND pred>=1 THEN pred WHEN {X}=0 AND pred<1 THEN 0 ELSE abs(pred-{X})/{X} END ape FROM a),
 c AS (SELECT *, avg(ape) OVER ({W} ROWS 2 PRECEDING) ape_3, avg({X}) OVER ({W} ROWS 2 PRECEDING) mean_3, avg({X}) OVER ({W} ROWS BETWEEN 9 PRECEDING AND 3 PRECEDING) mean_4_10, count(*) OVER (PARTITION BY {KEYS}) n_rows, row_number() OVER ({W} DESC) rn, list({X}) OVER ({W} ROWS 29 PRECEDING) l FROM b),
 k AS (SELECT {KEYS}, l, list_position(l, list_max(l)) i FROM c WHERE rn=1 AND ape_3>=0.5 AND 0.5*(mean_4_10+1)>mean_3+1 AND n_rows>10), m AS (SELECT *, list_concat(l[1:i-1], l[i+1:len(l)]) m FROM k), n AS (SELECT *, list_position(m, list_min(m)) j FROM m), t AS (SELECT {KEYS}, list_concat(m[1:j-1], m[j+1:len(m)]) t FROM n),
 v AS (SELECT {KEYS}, .3*list_avg(t[greatest(len(t)-2,1):])+.3*list_avg(t[greatest(len(t)-6,1):])+.2*coalesce(list_avg(t[greatest(len(t)-13,1):greatest(len(t)-7,0)]),0)+.1*coalesce(list_avg(t[greatest(len(t)-20,1):greatest(len(t)-14,0)]),0)+.1*coalesce(list_avg(t[greatest(len(t)-27,1):greatest(len(t)-21,0)]),0) v FROM t)
 SELECT {KEYS}, DATE '{FORECAST_DATE}' + CAST(s AS INT) AS dt, R(v) pred, R(20*v) total_fc FROM v, range(20) r(s)""")
def _(spark, d):
    pb = sparse(spark, d)
    cases = N.sales_drop_cases(R.lags(pb, [7]).withColumnRenamed("lag_7", "pred_t0")).select(*K)
    value = Q.last_apply(pb.join(cases, K, "left_semi"), 30, Q.trimmed_recent, "pred")
    first = F.to_date(F.lit(FORECAST_DATE))
    return value.select(*K, F.explode(F.sequence(first, F.date_add(first, 19))).alias("dt"), "pred", (20 * F.col("pred")).alias("total_fc"))


@add("z3_drinks_features")
def _(spark, d):
    # cleaned where the lines were dealt to
    known = N.sized_and_recent(dense(spark, d), TEST_ROWS, *RECENT, counted=~trained())
    df = N.without_long_tail(R.filled(cleaned(known), ["seq_price"], constant=0.0), trained())
    df = C.window_outliers(df, kind="promo").where("outlier = 0")
    table = cut(df.select(*K, "dt", X, "is_train", "cat1", "cat2", "day_abbr", "month", "promo", "price", "w_price", "new_byrs", "old_byrs"))
    buyers = buyers_by(table, "day_abbr")
    table = cut(N.with_volume_band(table.drop("new_byrs", "old_byrs"), ["cat1"], deal=True), table)
    # then rows move once by series, for the join with elasticities and all windows
    df = table.join(cut(N.elasticity(table)), K)
    df = N.promotion_history_mean(df, "promo")
    df = R.history_mean(df, (7,), (1.0,), col="w_price", name="price_mean")
    df = df.withColumns({"price_off_mean": F.col("price") - F.col("price_mean"), "w_price_off_mean": F.col("w_price") - F.col("price_mean")})
    df = N.predicted_volume(N.horizon_statistics(df, 20))
    df = N.seasonal_index(df, ["cat1", "cat2"], ["day_abbr", "month"], train=trained(), table=table)
    df = indexed(df, N.weekday_ratio(table).select("cat2", F.col("weekday").alias("day_abbr"), F.col("ratio").alias("idx")), ["cat2", "day_abbr"], "weekday_ratio")
    df = df.join(buyers, ["wh_id", "day_abbr"], "left")
    df = N.label_encoded(C.validation_marked(df), "cat2", "cat2_code", table)
    return df.select(*K, "dt", "is_train", X, "band", "history_mean", "price_mean", "price_off_mean", "w_price_off_mean", "known_mean_7", "idx_cat1_month", "idx_cat2_day_abbr", "weekday_ratio", "ed_volume", "new_idx", "old_idx", "cat2_code")


@add("z4_pricing_strategy_features")
def _(spark, d):
    df = promoted(C.temperature_repaired(C.price_repaired(dense(spark, d).where("price <> 0"))))
    df = cut(df.select(*K, "dt", X, "cat1", "cat2", "day_abbr", "festival_name", "price", "w_price", "seq_price", "promo"))
    df = cut(C.window_outliers(df, kind="promo").where("outlier = 0").drop("outlier"), df)
    table = df = banded(df, ["cat1"])
    df = indexed(df, N.daily_total_index(df, ["cat2"], "day_abbr"), ["cat2", "day_abbr"], "weekday_index")
    df = cut(df, table)
    table = df = cut(N.index_with_fallback(df, [(N.festival_index(df, [c]), [c, "festival_name"]) for c in ("cat2", "cat1")], name="festival_index"), df)
    df = df.withColumns({"seq_rebate": S.rebate("price", "seq_price"), "real_rebate": S.rebate("price", "w_price")})
    df = cut(df.join(N.discount_statistics(df, ["dt", "cat2"], ["seq_rebate"]), ["dt", "cat2"], "left"), table)
    table = df
    df = R.history_mean(df, (7,), (1.0,), col="w_price", name="price_mean")
    ed = N.elasticity(df).join(N.ratio_elasticity(df), K, "left")
    df = cut(N.horizon_statistics(N.predicted_volume(df.join(ed, K)), 2), table)
    df = N.elastic_volumes(df, {"v_known": ("price_mean", "known_mean_7")})
    df = N.first_seen_encoded(df, "cat1", "cat2", "cat2_code")
    out = df.select(*K, "dt", X, "band", "weekday_index", "festival_index", "seq_rebate_max", "price_mean", "ratio_ed", "ed_volume", "v_known", "cat2_code", *[F.round(c, 5).alias(c) for c in ("real_rebate", "ed")])
    days = out.where(F.col("dt").isin(*[F.lit(x).cast("date") for x in (FORECAST_DATE, "2001-06-02")]))
    return files.write_and_read(days, "orc", ["dt"])


_Q = "PARTITION BY bu_id, wh_id, sku_id, promo ORDER BY dt"
_Z5 = f"""WITH a AS (SELECT *, count(*) OVER p n_rows, sum({X}) FILTER (dt BETWEEN DATE '{RECENT[0]}' AND DATE '{RECENT[1]}') OVER p sold FROM {{pa}} WINDOW p AS (PARTITION BY {KEYS})),
 b AS (SELECT * EXCLUDE (seq_price), CASE WHEN seq_num>0 THEN 1 ELSE 0 END promo, coalesce(seq_price, first_value(seq_price IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(seq_price IGNORE NULLS) OVER ({W} ROWS UNBOUNDED PRECEDING), 0) seq_price FROM a WHERE n_rows>={ALL_ROWS} AND coalesce(sold,0)<>0),
 m AS (SELECT *, CASE WHEN row_number() OVER ({_Q})>=7 THEN avg({X}) OVER ({_Q} ROWS 6 PRECEDING) END m7, (avg({X}) OVER ({W} ROWS 6 PRECEDING)+avg({X}) OVER ({W} ROWS 14 PRECEDING)+avg({X}) OVER ({W} ROWS 29 PRECEDING))/3 h FROM b),
 o AS (SELECT *, CASE WHEN coalesce({X}>2.5*min(m7) OVER q, false) OR coalesce({X}<0.2*max(m7) OVER q, false) THEN 1 ELSE 0 END outlier FROM m WINDOW q AS ({_Q} ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
 d AS (SELECT cat1, dt, festival_name f, sum({X}) t FROM o GROUP BY ALL), r AS (SELECT cat1, f, year(dt) y, min(dt) a, max(dt) b FROM d WHERE f<>'无' GROUP BY ALL), g AS (SELECT r.cat1, r.f, y, avg(t) m FROM r JOIN d ON d.cat1=r.cat1 AND d.f='无' AND d.dt BETWEEN a-15 AND b+15 GROUP BY ALL),
 s AS (SELECT cat1, f, sum(m) base FROM g GROUP BY ALL), i AS (SELECT cat1, f festival_name, avg(t)/max(base) idx FROM d JOIN s USING (cat1, f) GROUP BY ALL)
 SELECT {KEYS}, dt, R({X}) {X}, L(outlier) outlier, R(coalesce(lag(h) OVER ({W}), h)) history_mean, R(seq_price) seq_price,
 {", ".join(f"R(avg(CASE WHEN is_train=1 THEN {X} END) OVER (PARTITION BY cat2, {c})/avg(CASE WHEN is_train=1 THEN {X} END) OVER (PARTITION BY cat2)) idx_cat2_{c}" for c in ("day_abbr", "month"))},
 R(avg(new_byrs) OVER v/avg(new_byrs) OVER (PARTITION BY wh_id)) new_idx, R(avg(old_byrs) OVER v/avg(old_byrs) OVER (PARTITION BY wh_id)) old_idx, R(coalesce(idx,1)) festival_index,
 L(CASE festival_name {" ".join(f"WHEN '{k}' THEN {n}" for k, n in FESTIVALS.items())} END) festival_code, L(dense_rank() OVER (ORDER BY cat1)-1) cat1_code FROM o LEFT JOIN i USING (cat1, festival_name) WINDOW v AS (PARTITION BY wh_id, day_abbr)"""


@add("z5_augmentation_features", _Z5)
def _(spark, d):
    df = N.sized_and_recent(dense(spark, d), ALL_ROWS, *RECENT)
    df = df.select(*K, "dt", X, "cat1", "cat2", "day_abbr", "month", "festival_name", "seq_num", "seq_price", "new_byrs", "old_byrs", "is_train")
    table = df = cut(C.window_outliers(R.filled(promoted(df), ["seq_price"], constant=0.0), kind="promo"))
    df = N.seasonal_index(R.history_mean(df), ["cat2"], ["day_abbr", "month"], train=trained())
    df = cut(df.join(buyers_by(df, "day_abbr"), ["wh_id", "day_abbr"], "left"), table)
    df = indexed(df, N.festival_index(df, ["cat1"]), ["cat1", "festival_name"], "festival_index")
    df = N.label_encoded(df.withColumn("festival_code", S.recode("festival_name", FESTIVALS)), "cat1", "cat1_code")
    return df.select(*K, "dt", X, "outlier", "history_mean", "seq_price", "idx_cat2_day_abbr", "idx_cat2_month", "new_idx", "old_idx", "festival_index", "festival_code", "cat1_code")


@add("z6_reference_price_recipe", f"WITH g AS (SELECT {KEYS}, dt, sum({X}) c, sum(arranged_amt) m FROM {{pa}} GROUP BY ALL), a AS (SELECT *, m/c p FROM g), b AS (SELECT *, avg(p) OVER ({W} ROWS 29 PRECEDING) mm, (row_number() OVER ({W})-1)//3 b FROM a), e AS (SELECT *, CASE WHEN abs(p-mm)/mm>0.05 THEN mm ELSE p END net FROM b) SELECT {KEYS}, dt, R(p) price, R(min(net) OVER (PARTITION BY {KEYS}, b)) ref_price FROM e")
def _(spark, d):
    sums = dense(spark, d).groupBy(*K, "dt").agg(F.sum(X).alias(X), F.sum("arranged_amt").alias("arranged_amt"))
    return N.reference_price(sums).select(*K, "dt", (F.col("arranged_amt") / F.col(X)).alias("price"), "ref_price")


@add("z6_perceived_price", f"""WITH g AS (SELECT {KEYS}, dt, sum({X}) c, sum(arranged_amt) m FROM {{pa}} GROUP BY ALL), a AS (SELECT *, m/c p FROM g), b AS (SELECT *, avg(p) OVER ({W} ROWS 29 PRECEDING) mm, (row_number() OVER ({W})-1)//3 b FROM a), e AS (SELECT *, CASE WHEN abs(p-mm)/mm>0.05 THEN mm ELSE p END net FROM b),
 f AS (SELECT {KEYS}, dt, p, R(min(net) OVER (PARTITION BY {KEYS}, b)) ref FROM e), n AS (SELECT *, count(*) OVER (PARTITION BY {KEYS}, ref) n, row_number() OVER (PARTITION BY {KEYS}, ref ORDER BY dt)-1 i FROM f), k AS (SELECT *, CAST(ceil(n/3.0) AS BIGINT) k FROM n),
 h AS (SELECT *, CASE WHEN i<(n%k)*(n//k+1) THEN i//(n//k+1) ELSE n%k+(i-(n%k)*(n//k+1))//(n//k) END chunk FROM k)
 SELECT {KEYS}, dt, R(p) price, ref ref_price, R(first_value(p) OVER (PARTITION BY {KEYS}, ref, chunk ORDER BY round(abs(p-ref),6), dt)) perceived FROM h""")
def _(spark, d):
    sums = dense(spark, d).groupBy(*K, "dt").agg(F.sum(X).alias(X), F.sum("arranged_amt").alias("arranged_amt"))
    df = N.reference_price(sums).withColumns({"ref_price": F.floor(F.col("ref_price") * 10000 + 0.5000001) / 10000.0, "price": F.col("arranged_amt") / F.col(X)})
    return N.perceived_price(df).select(*K, "dt", "price", "ref_price", "perceived")


@add("z7_long_tail_holt_winters")
def _(spark, d):
    pb = sparse(spark, d)
    tail = pb.join(N.long_tail(pb.withColumn(X, F.col(X) / 20)).where("is_long_tail = 1"), K, "left_semi")
    padded = C.left_padded(tail, 60).fillna(0.0, [X]).withColumn("dt", F.date_add(F.lit("2001-01-01").cast("date"), F.col("place").cast("int")))
    ahead = G.holt_winters(padded, steps=20)
    day = F.date_add(F.lit(FORECAST_DATE).cast("date"), (F.col("step") - 1).cast("int"))
    return ahead.withColumn("dt", day).groupBy(*K).agg(F.sum("value").alias("total_fc"), S.to_json_series("dt", F.round("value", 3)).alias("daily_fc"))


@add("z9_linear_baseline")
def _(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    pb = sparse(spark, d).select(*K, "dt", "cat2", "is_train", X)
    tail = N.long_tail(pb.withColumn(X, F.col(X) / 20)).where("is_long_tail = 1").select(*K)
    lags = [f"lag_{i}" for i in range(1, 15)]
    # written once: the fit passes over the training rows twice, the forecasts over the others
    rows = cut(R.lags(pb.join(tail, K, "left_anti"), list(range(1, 15))).dropna(subset=lags).select(*K, "is_train", X, *lags))
    rows = VectorAssembler(inputCols=lags, outputCol="f").transform(rows)
    model = LinearRegression(featuresCol="f", labelCol=X, solver="normal").fit(rows.where(trained()))
    main = model.transform(rows.where(~trained())).groupBy(*K).agg(F.avg(F.greatest("prediction", F.lit(0.0))).alias("pred"))
    return G.with_fallback(main, G.long_tail_rule(pb, F.col("cat2") < "Brand#3"), K)


BLOCK = [f"{stat}_{n}_shift_{i}" for i in (1, 7) for n in (3, 7, 14) for stat in ("mean", "std")]


def tree_rows(pb: DataFrame) -> DataFrame:
    """Rows of the series that are no long tail, with lags, the block of shifted rolling statistics, festival-scaled and
    weighted history means, and the series' recent band."""
    tail = N.long_tail(pb.withColumn(X, F.col(X) / 20)).where("is_long_tail = 1").select(*K)
    rows = cut(pb.join(tail, K, "left_anti"))
    rows = indexed(rows, N.festival_index(rows, ["cat1"]), ["cat1", "festival_name"], "festival_index")
    rows = N.festival_scaled_mean(R.lags(rows, [1, 7]), "festival_index")
    rows = R.history_mean(rows, (7, 14, 21), name="history_mean_21")
    for i in (1, 7):
        rows = R.rolling(rows, [3, 7, 14], ["mean", "std"], least=2, shift=i)
    return rows.join(N.recent_band(rows, FORECAST_DATE), K, "left").withColumn("recent_band", F.coalesce("recent_band", F.lit(0)))


_SHIFTED = ", ".join(f"CASE WHEN count({X}) OVER w{n}_{i}>=2 THEN {f} OVER w{n}_{i} END {s}_{n}_shift_{i}" for i in (1, 7) for n in (3, 7, 14) for s, f in (("mean", f"avg({X})"), ("std", f"stddev_samp({X})")))
_FRAMES = ", ".join(f"w{n}_{i} AS ({W} ROWS BETWEEN {i + n - 1} PRECEDING AND {i} PRECEDING)" for i in (1, 7) for n in (3, 7, 14))
_Z10 = f"""WITH w AS (SELECT {KEYS}, count(*) OVER (PARTITION BY {KEYS}) n, sum({X}/20) OVER ({W} ROWS 6 PRECEDING) s7, row_number() OVER ({W}) rn, {X}/20 x FROM {{pb}} WHERE dt>=DATE '1999-01-01'),
 k AS (SELECT {KEYS} FROM w GROUP BY ALL HAVING NOT (CASE WHEN max(n)>=7 THEN avg(s7) FILTER (rn>=7)<7 ELSE sum(x)<max(n) END)), p AS (SELECT * FROM {{pb}} SEMI JOIN k USING ({KEYS}) WHERE dt>=DATE '1999-01-01'),
 d AS (SELECT cat1, dt, festival_name f, sum({X}) t FROM p GROUP BY ALL), r AS (SELECT cat1, f, year(dt) y, min(dt) a, max(dt) b FROM d WHERE f<>'无' GROUP BY ALL), g AS (SELECT r.cat1, r.f, y, avg(t) m FROM r JOIN d ON d.cat1=r.cat1 AND d.f='无' AND d.dt BETWEEN a-15 AND b+15 GROUP BY ALL),
 s AS (SELECT cat1, f, sum(m) base FROM g GROUP BY ALL), i AS (SELECT cat1, f festival_name, avg(t)/max(base) idx FROM d JOIN s USING (cat1, f) GROUP BY ALL),
 m AS (SELECT *, CASE WHEN festival_name='无' THEN avg({X}) OVER (PARTITION BY {KEYS}, festival_name='无' ORDER BY dt ROWS 2 PRECEDING) END m3, (avg({X}) OVER ({W} ROWS 6 PRECEDING)+avg({X}) OVER ({W} ROWS 13 PRECEDING)+avg({X}) OVER ({W} ROWS 20 PRECEDING))/3 h FROM p LEFT JOIN i USING (cat1, festival_name)),
 q AS (SELECT *, lag({X}, 1) OVER ({W}) lag_1, lag({X}, 7) OVER ({W}) lag_7, coalesce(lag(h) OVER ({W}), h) history_mean_21, coalesce(last_value(m3 IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {X})*CASE WHEN festival_name='无' THEN 1 ELSE coalesce(idx,1) END festival_scaled_mean, {_SHIFTED} FROM m WINDOW {_FRAMES}),
 t AS (SELECT {KEYS}, floor(avg({X}) FILTER (rn<=7)/5) b FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM p WHERE dt>=DATE '{FORECAST_DATE}'-30 AND dt<DATE '{FORECAST_DATE}') GROUP BY ALL)
 SELECT {KEYS}, dt, R(lag_1) lag_1, R(lag_7) lag_7, R(history_mean_21) history_mean_21, R(festival_scaled_mean) festival_scaled_mean, {", ".join(f"R({c}) {c}" for c in BLOCK)}, L(coalesce(b,0)) recent_band FROM q LEFT JOIN t USING ({KEYS})"""


@add("z10_tree_features", _Z10)
def _(spark, d):
    rows = tree_rows(sparse(spark, d).where("dt >= '1999-01-01'"))
    return rows.select(*K, "dt", "lag_1", "lag_7", "history_mean_21", "festival_scaled_mean", *BLOCK, "recent_band")


@add("z10_trees_with_fallback")
def _(spark, d):
    pb = sparse(spark, d).where("dt >= '1999-01-01'").withColumn("day_no", S.day_number("dt"))
    rows = C.threshold_damped(tree_rows(pb)).withColumn("cohort", F.lit(0))
    names = ["price", "day_abbr", "month", "day_no", "lag_1", "lag_7", "history_mean_21", "festival_scaled_mean", *BLOCK, "recent_band"]
    main = boosted(rows, names, X, "cohort", trained(), [*K, "dt"])
    main = main.groupBy(*K).agg(F.avg("pred").alias("pred"))
    return G.with_fallback(main, G.long_tail_rule(pb, F.col("cat2") < "Brand#3"), K)


@add("z11_hourly_static_features")
def _(spark, d):
    # clipped where the lines' deal still serves; then every statistic is of one table, and its rows move once, for all windows
    df = C.window_clipped(promoted(C.price_repaired(dense(spark, d))), kind="promo")
    table = cut(df.select(*K, "dt", X, "cat1", "cat2", "day_abbr", "month", "festival_name", "avg_t", "seq_num", "is_train"))
    days = cut(table.groupBy("cat1", "cat2", "dt", "day_abbr", "festival_name").agg(F.sum(X).alias(X), F.sum("seq_num").alias("seq_num")))
    df = N.with_volume_band(C.temperature_repaired(table), ["cat1"], deal=True)
    df = N.horizon_statistics(R.rolling(df, [3, 7, 14], ["mean"], least=1), 1)
    df = indexed(df, N.daily_total_index(days, ["cat2"], "day_abbr"), ["cat2", "day_abbr"], "weekday_index")
    festivals = [(files.written_small(N.festival_index(days, [c])), [c, "festival_name"]) for c in ("cat2", "cat1")]
    df = N.index_with_fallback(df, festivals, name="festival_index")
    df = df.join(files.written_small(days.groupBy("dt", "cat1").agg(F.sum("seq_num").alias("seq_num_cat1"))), ["dt", "cat1"])
    df = N.frequency_encoded(C.validation_marked(df), "cat2", "cat2_code", table)
    return df.select(*K, "dt", "is_train", X, "band", "weekday_index", "festival_index", "mean_3", "mean_7", "mean_14", "known_mean_7", "seq_num_cat1", "cat2_code")


@add("z12_trees_by_bucket")
def _(spark, d):
    pb = sparse(spark, d).where("dt >= '2000-06-01'")
    level = pb.where(trained()).groupBy(*K).agg(F.avg(X).alias("level"))
    bucket = N.equal_buckets(level, "level", 1 + level.count() // 2, K).select(*K, "bucket")
    lags = R.day_lags(pb, [1, 2, 7])
    rows = lags.withColumns({"d1": F.col("prev_1") - F.col("prev_2")}).join(bucket, K)
    out = boosted(rows, ["price", "day_abbr", "prev_1", "prev_2", "prev_7", "d1"], X, "bucket", trained(), [*K, "dt"])
    return out.groupBy(*K, "bucket").agg(S.to_json_series("dt", F.round("pred", 3)).alias("daily_fc"))


@add("z13_long_tail_smoothing", f"WITH s AS (SELECT {KEYS} FROM {{pb}} GROUP BY ALL HAVING sum({X})>0 AND max(dt)>=DATE '2001-03-01'), t AS (SELECT bu_id||'_'||wh_id||'_'||sku_id AS unique_id, {X} x, dt, row_number() OVER ({W} DESC) rn FROM {{pb}} JOIN s USING ({KEYS}) WHERE is_train=1) SELECT unique_id, R(greatest(list_reduce(list(x ORDER BY dt), lambda l, v: 0.4*v+0.6*l),0)) pred FROM t WHERE rn<=31 GROUP BY unique_id")
def _(spark, d):
    pb = sparse(spark, d)
    alive = pb.groupBy(*K).agg(F.sum(X).alias("s"), F.max("dt").alias("m")).where("s > 0 and m >= '2001-03-01'").select(*K)
    rows = pb.where(trained()).join(alive, K, "left_semi")
    return G.ses_forecast(rows, alpha=0.4).select(S.key_text(*K).alias("unique_id"), "pred")


def arma_pools(spark, d) -> tuple[DataFrame, DataFrame]:
    """(panel, pools): what pooled ARMA needs of the panel, and (keys, bucket) of the long-tail series, 500 a bucket by recent
    volume. Eligible series, a row each, are written once, as ranking reads them three times."""
    pb = sparse(spark, d).select(*K, "dt", X)
    eligible = R.last_rows(R.rolling(pb, [21], ["mean"], least=1), 1).where("mean_21 between 15 and 30").select(*K, "mean_21")
    return pb, N.equal_buckets(cut(eligible), "mean_21", 500, K).select(*K, "bucket")


_A, _D = "{pb}", "(r0*(r0*r0-r1*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r1-r0*r2))"


@add("z14_long_tail_pooled_arma", f"""WITH e AS (SELECT *, avg({X}) OVER ({W} ROWS 20 PRECEDING) m21, row_number() OVER ({W} DESC) rn FROM {{pb}}), k AS (SELECT {KEYS}, m21, (row_number() OVER (ORDER BY m21, {KEYS})-1)//500+1 bucket FROM e WHERE rn=1 AND m21 BETWEEN 15 AND 30),
 q AS (SELECT p.bu_id, p.wh_id, p.sku_id, dt, bucket, CASE WHEN {X}>quantile_cont({X},0.96) OVER s THEN quantile_cont({X},0.8) OVER s ELSE {X} END y FROM {{pb}} p JOIN k USING ({KEYS}) WINDOW s AS (PARTITION BY p.sku_id)),
 d AS (SELECT *, y-lag(y) OVER ({W}) d FROM q), l AS (SELECT *, lag(d,1) OVER ({W}) l1, lag(d,2) OVER ({W}) l2, lag(d,3) OVER ({W}) l3 FROM d), r AS (SELECT bucket, sum(d*d) r0, sum(d*l1) r1, sum(d*l2) r2, sum(d*l3) r3 FROM l GROUP BY bucket),
 f AS (SELECT bucket, (r1*(r0*r0-r1*r1)-r1*(r2*r0-r1*r3)+r2*(r2*r1-r0*r3))/{_D} phi1, (r0*(r2*r0-r3*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r3-r2*r2))/{_D} phi2, (r0*(r0*r3-r1*r2)-r1*(r1*r3-r2*r2)+r1*(r1*r1-r0*r2))/{_D} phi3 FROM r),
 g AS (SELECT *, d-phi1*l1-phi2*l2-phi3*l3 e FROM l JOIN f USING (bucket)), h AS (SELECT *, lag(e) OVER ({W}) e1 FROM g), t AS (SELECT bucket, sum(e*e1)/sum(e1*e1) theta FROM h WHERE e1 IS NOT NULL GROUP BY bucket)
 SELECT {KEYS}, L(bucket) bucket, R(greatest(y+phi1*d+phi2*l1+phi3*l2+theta*e, 0)) pred FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM h) JOIN t USING (bucket) WHERE rn=1""")
def _(spark, d):
    pb, bucket = arma_pools(spark, d)
    return Q.pooled_arma(C.quantile_capped(pb.join(bucket, K)), "bucket").select(*K, "bucket", "pred")


_ARMA = f"""WITH RECURSIVE w AS (SELECT *, avg({X}) OVER ({W} ROWS 20 PRECEDING) m21, row_number() OVER ({W} DESC) rn FROM {{pb}}), k AS (SELECT {KEYS}, (row_number() OVER (ORDER BY m21, {KEYS})-1)//500+1 bucket FROM w WHERE rn=1 AND m21 BETWEEN 15 AND 30),
 q AS (SELECT p.bu_id, p.wh_id, p.sku_id, dt, bucket, CASE WHEN {X}>quantile_cont({X},0.96) OVER s THEN quantile_cont({X},0.8) OVER s ELSE {X} END y FROM {{pb}} p JOIN k USING ({KEYS}) WINDOW s AS (PARTITION BY p.sku_id)),
 d AS (SELECT *, y-lag(y) OVER ({W}) d FROM q), l AS (SELECT *, lag(d,1) OVER ({W}) l1, lag(d,2) OVER ({W}) l2, lag(d,3) OVER ({W}) l3 FROM d), r AS (SELECT bucket, sum(d*d) r0, sum(d*l1) r1, sum(d*l2) r2, sum(d*l3) r3 FROM l GROUP BY bucket),
 f AS (SELECT bucket, (r1*(r0*r0-r1*r1)-r1*(r2*r0-r1*r3)+r2*(r2*r1-r0*r3))/{_D} phi1, (r0*(r2*r0-r3*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r3-r2*r2))/{_D} phi2, (r0*(r0*r3-r1*r2)-r1*(r1*r3-r2*r2)+r1*(r1*r1-r0*r2))/{_D} phi3 FROM r),
 h AS (SELECT *, lag(e) OVER ({W}) e1 FROM (SELECT *, d-phi1*l1-phi2*l2-phi3*l3 e FROM l JOIN f USING (bucket))), t AS (SELECT bucket, sum(e*e1)/sum(e1*e1) theta FROM h WHERE e1 IS NOT NULL GROUP BY bucket),
 u AS (SELECT *, y-e+theta*e1 o, row_number() OVER ({W} DESC) rn FROM h JOIN t USING (bucket)),
 z AS (SELECT {KEYS}, bucket, any_value(phi1) phi1, any_value(phi2) phi2, any_value(phi3) phi3, any_value(theta) theta, arg_max(e, dt) e, list(y ORDER BY dt) ys, list(o ORDER BY dt) outs FROM u WHERE rn<=7 GROUP BY ALL),
 n AS (SELECT {KEYS}, bucket, phi1, phi2, phi3, theta, 0 step, ys, e, outs, 0.0::DOUBLE v FROM z UNION ALL
  SELECT {KEYS}, bucket, phi1, phi2, phi3, theta, step, list_append(ys, v), v-g, outs, v FROM (SELECT * EXCLUDE (m), CASE WHEN m<=0 THEN 0.001+0.009*(('0x'||md5(concat_ws(':', {KEYS}, step))[1:7])::BIGINT/268435456.0::DOUBLE) ELSE m END v FROM (SELECT *, list_avg([outs[-1], outs[-2], outs[-3], outs[-7]]) m FROM
   (SELECT {KEYS}, bucket, phi1, phi2, phi3, theta, step, ys, g, list_append(outs, g+theta*e) outs FROM (SELECT * EXCLUDE (step, v), step+1 step, ys[-1]+phi1*(ys[-1]-ys[-2])+phi2*(ys[-2]-ys[-3])+phi3*(ys[-3]-ys[-4]) g FROM n WHERE step<7)))))"""


def arma_ahead(spark, d) -> DataFrame:
    """(keys, bucket, step, pred): seven days of the long-tail series, in buckets of 500 by recent volume, values capped."""
    pb, bucket = arma_pools(spark, d)
    return Q.pooled_arma_forecast(C.quantile_capped(pb.join(bucket, K)), "bucket")


@add("g9_pooled_arma_seven_days", f"{_ARMA} SELECT {KEYS}, L(bucket) bucket, L(step) step, R(v) pred FROM n WHERE step>0")
def _(spark, d):
    return arma_ahead(spark, d)


@add("z14_long_tail_arma_series", f"{_ARMA} SELECT bu_id||'_'||wh_id||'_'||sku_id unique_id, '{{' || string_agg('\"' || strftime(DATE '{FORECAST_DATE}' + CAST(step-1 AS INT), '%Y%m%d') || '\":' || CAST(CAST(floor(v*100+0.5000001) AS BIGINT) AS VARCHAR), ',' ORDER BY step) || '}}' daily_fc FROM n WHERE step>0 AND v IS NOT NULL GROUP BY ALL")
def _(spark, d):
    day = F.date_add(F.lit(FORECAST_DATE).cast("date"), (F.col("step") - 1).cast("int"))
    rows = arma_ahead(spark, d).where("pred is not null").select(S.key_text(*K).alias("unique_id"), day.alias("dt"), F.floor(F.col("pred") * 100 + 0.5000001).alias("n"))
    return rows.groupBy("unique_id").agg(S.to_json_series("dt", "n").alias("daily_fc"))


def hourly_forecasts(rows: DataFrame) -> DataFrame:
    """Trees a cut-off hour on intraday rows; the last tenth of days is forecast."""
    names = ["current_sum", "y_lag1", "y_lag7", "y_mean", "y_max", "price_growth", "dow"]
    first = rows.agg(F.percentile_approx(F.datediff("dt", F.lit("1970-01-01")), 0.9)).first()[0]
    train = F.datediff("dt", F.lit("1970-01-01")) < (first or 0)
    return boosted(rows, names, "y", "cut_hour", train, ["wh_id", "sku", "dt"], depth=3, rounds=3)


@add("z16_intraday_trees")
def _(spark, d):
    return hourly_forecasts(I.intraday_rows(hourly(spark, d), ["wh_id", "sku"], cuts=(12, 16, 20)))


@add("z17_intraday_trees_of_active_series")
def _(spark, d):
    spec = PanelSpec(("wh_id", "sku"), "dt", "cnt")
    ph = hourly(spark, d)
    last = ph.agg(F.max("dt")).first()[0]
    active = I.active_series(ph, str(last), 1, 1e9, spec).select("wh_id", "sku")
    return hourly_forecasts(I.intraday_rows(ph.join(active, ["wh_id", "sku"], "left_semi"), ["wh_id", "sku"], cuts=(14, 18)))


@add("z17_activity_of_intraday_rows", f"SELECT wh_id, sku, L(cut_hour) cut_hour, L(count(*)) n_days, R(avg(y)) mean_y FROM {INTRADAY_SQL} GROUP BY wh_id, sku, cut_hour")
def _(spark, d):
    rows = I.intraday_rows(hourly(spark, d), ["wh_id", "sku"])
    return rows.groupBy("wh_id", "sku", "cut_hour").agg(F.count("*").alias("n_days"), F.avg("y").alias("mean_y"))


REGIONS = ["AMERICA", "ASIA", "EUROPE"]


@add("z18_regional_models")
def _(spark, d):
    df = cut(dense(spark, d).where(S.in_lists(cat1=REGIONS, cat2=None)).select(*K, "dt", X, "cat1", "price", "day_abbr", "month", "is_train"))
    known = df.groupBy(*K).agg(F.avg(F.when(trained(), F.col(X))).alias("m"))
    rows = N.horizon_statistics(df, 20).withColumn("region", F.col("cat1"))
    trees = boosted(rows, ["price", "day_abbr", "month", "known_mean", "known_mean_7", "known_max_7", "known_min_14"], X, "region", trained(), [*K, "dt"], depth=3, rounds=3)
    linear = G.recursive_linear(df, FORECAST_DATE, ("bu_id", "wh_id")).where(F.col("dt") == F.to_date(F.lit(FORECAST_DATE)))
    models = {
        "two_means": G.two_means(df.where(trained())),
        "ses": G.ses_fitted(df.where(trained())).select(*K, "pred"),
        "linear": linear.select(*K, "pred"),
        "trees": trees.groupBy(*K).agg(F.avg("pred").alias("pred")),
    }
    return G.union_tagged(models, "model").join(known, K).select(*K, "model", S.clamp_to_mean("pred", "m").alias("pred"))
