"""The pricing-strategy features as a whole: cleaning, indices, bands, means, elasticities, volumes, buyers, codes and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators import cleaning as C
from panelwright.operators import features as N
from panelwright.operators import rolling as R
from panelwright.operators.elasticity import curve_elasticity, elastic_predictions, positive_or_category, price_curves
from panelwright.operators.spec import SERIES
from panelwright.plans.features import _ED
from panelwright.plans.models import _E4, _RATIO, _SEC
from panelwright.plans.recipes import RECENT, TEST_ROWS, K, KEYS, W, X, cut, trained
from panelwright.plans.registry import add
from panelwright.sources import files
from panelwright.sources.panels import dense

#: Rows between a day and the last one known of it, as two days are forecast at once; statistics whose volume is foretold.
AHEAD = 2
STATISTICS = ("all", "ewm", "mean", "max", "min")
BUYERS = ("new_idx_day_abbr", "old_idx_day_abbr", "new_idx_month", "old_idx_month")
COLUMNS = [
    *("is_train", X, "band", "weekday_ratio", "idx_day_abbr", "idx_month", "festival_index", "history_mean", "seq_rebate_max", "seq_rebate_mean", "real_rebate"),
    *("ed", "ratio_ed", "sec_ed", "v_ed", "v_ratio", "v_sec", "v_mean_sec"),
    *(f"v_{n}" for n in STATISTICS), *BUYERS, "cat2_code",
]


#: What later steps read of the cleaned rows.
READ = [*K, "dt", X, "is_train", "cat1", "cat2", "day_abbr", "month", "festival_name", "price", "w_price", "seq_price", "csu_redu_num", "new_byrs", "old_byrs"]


def cleaned_rows(df: DataFrame) -> DataFrame:
    """All rows that count for the indices, those to make features of marked as kept. Series need rows to forecast, recent
    sales and training rows that are no outliers; training rows far from their windows' means, by promotion state, only count
    for the indices. All of it is worked out where the panel's lines were dealt to."""
    df = N.sized_and_recent(df.where("price <> 0"), TEST_ROWS, *RECENT, counted=~trained())
    df = C.price_repaired(df).withColumn("w_price", F.col("w_price") / 1000)
    promo = (F.col("seq_num") != 0) | (F.col("pro_num") != 0) | (F.col("csu_redu_num") != 0)
    rows = C.window_outliers(df.withColumn("kind", F.concat("is_train", promo.cast("int"))), kind="kind", short_mean=True)
    good = (F.col("is_train") == 0) | (F.col("outlier") == 0)
    both = (F.max(F.when(good, F.col("is_train"))).over(SERIES.whole()) == 1) & (F.min(F.when(good, F.col("is_train"))).over(SERIES.whole()) == 0)
    step = F.when(~trained(), F.sum(1 - F.col("is_train")).over(SERIES.series()))
    return cut(rows.withColumns({"kept": good & both, "step": step}).select(*READ, "kept", "step"))


def index_tables(known: DataFrame) -> tuple[dict, dict]:
    """(indices, buyers), small tables all: by name the weekday shares, daily-total indices and festival indices of the
    category, then of the wider one; by weekday and month the buyers against their warehouse's mean."""
    small = files.written_small
    shares = N.weekday_ratio(known).select("cat2", F.col("weekday").alias("day_abbr"), F.col("ratio").alias("idx"))
    days = cut(known.groupBy("cat1", "cat2", "dt", "day_abbr", "month", "festival_name").agg(F.sum(X).alias(X)))
    indices = {"weekday_ratio": [(small(shares), ["cat2", "day_abbr"])]}
    for c in ("day_abbr", "month"):
        indices[f"idx_{c}"] = [(small(N.daily_total_index(days, [g], c)), [g, c]) for g in ("cat2", "cat1")]
    indices["festival_index"] = [(small(N.festival_index(days, [g])), [g, "festival_name"]) for g in ("cat2", "cat1")]
    buyers = {}
    for c in ("day_abbr", "month"):
        idx = N.buyer_indices(known, ["new_byrs", "old_byrs"], c, ["wh_id"]).groupBy("wh_id", c).pivot("buyer", ["new_byrs", "old_byrs"]).agg(F.first("idx"))
        buyers[c] = small(idx.withColumnsRenamed({"new_byrs": f"new_idx_{c}", "old_byrs": f"old_idx_{c}"}))
    files.drop_written(days)
    return indices, buyers


def with_indices(df: DataFrame, indices: dict, buyers: dict, rebates: DataFrame) -> DataFrame:
    """Columns of small tables; where no category has an index it is 1."""
    for name, tables in indices.items():
        df = N.index_with_fallback(df, tables, name=name)
    for c, idx in buyers.items():
        df = df.join(idx, ["wh_id", c], "left")
    return df.join(rebates, ["dt", "cat2"], "left")


def with_means(df: DataFrame) -> DataFrame:
    """Bands of the training rows, carried on; history means; rebates."""
    df = R.filled(N.with_volume_band(df, ["cat1"], deal=True, counted=trained()), ["band"], constant=3)
    return R.history_mean(df).withColumn("real_rebate", S.rebate("price", F.col("w_price") * 1000))


def series_values(df: DataFrame) -> DataFrame:
    """A row a series: two elasticities of the training rows, and the history means of the days ahead by step."""
    train, cats = df.where(trained()), df.select(*K, "cat2").distinct()
    ed = N.winsorised_elasticity(N.elasticity(train), cats).select(*K, "ed")
    ratio = positive_or_category(N.ratio_elasticity(train), "ratio_ed", cats).select(*K, "ratio_ed")
    steps = F.map_from_entries(F.collect_list(F.struct(F.col("step").cast("long").alias("step"), "value")))
    ahead = R.extrapolated(train, AHEAD).groupBy(*K).agg(steps.alias("__ahead"))
    return cut(ed.join(ratio, K).join(ahead, K, "left"))


def with_elasticities(df: DataFrame) -> DataFrame:
    """Three elasticities of the training rows, four volumes from the last known one, five from statistics of two rows ago;
    history means extrapolated over the days ahead. Rows move once by series, for the joins and all windows."""
    table, values = df, series_values(df)
    curves = price_curves(df.where(trained() & (F.col("csu_redu_num") == 0)))
    df = curve_elasticity(df.drop("price", "csu_redu_num"), curves)
    files.drop_written(table)
    df = df.join(values, K).withColumn("history_mean", F.when(trained(), F.col("history_mean")).otherwise(F.col("__ahead")[F.col("step")])).drop("__ahead")
    df = df.withColumn("mean_sec_ed", F.avg("sec_ed").over(SERIES.whole()))
    df = elastic_predictions(df, {"v_ed": "ed", "v_ratio": "ratio_ed", "v_sec": "sec_ed", "v_mean_sec": "mean_sec_ed"})
    for c, tag in ((X, "q"), ("w_price", "p")):
        s, old = SERIES.series(), F.col(c).cast("double")
        df = df.withColumn(f"{tag}_old", F.coalesce(F.lag(old, AHEAD).over(s), F.first(old).over(s)))
        w = SERIES.trailing(14)
        df = df.withColumns({f"{tag}_all": F.avg(f"{tag}_old").over(SERIES.rows(Window.unboundedPreceding, 0)), **{f"{tag}_{n}": f(f"{tag}_old").over(w) for n, f in (("mean", F.avg), ("max", F.max), ("min", F.min))}})
        df = R.ewm_exact(df, 7, col=f"{tag}_old", name=f"{tag}_ewm")
    pairs = {f"v_{n}": (f"p_{n}", f"q_{n}") for n in STATISTICS}
    return N.elastic_volumes(df, pairs)


def _index(dim: str, c: str) -> str:
    return f"(SELECT {dim}, {c}, avg(t)/max(w) i FROM (SELECT {dim}, {c}, dt, sum({X}) t FROM known GROUP BY ALL) JOIN (SELECT {dim}, avg(t) w FROM (SELECT {dim}, dt, sum({X}) t FROM known GROUP BY ALL) GROUP BY ALL) USING ({dim}) GROUP BY ALL)"


def _festival(dim: str) -> str:
    return f"(WITH e AS (SELECT {dim}, dt, festival_name f, sum({X}) t FROM known GROUP BY ALL), r AS (SELECT {dim}, f, year(dt) y, min(dt) a, max(dt) b FROM e WHERE f<>'无' GROUP BY ALL), m AS (SELECT r.{dim}, r.f, y, avg(t) m FROM r JOIN e ON e.{dim}=r.{dim} AND e.f='无' AND e.dt BETWEEN a-15 AND b+15 GROUP BY ALL), s AS (SELECT {dim}, f, sum(m) base FROM m GROUP BY ALL) SELECT {dim}, f festival_name, avg(t)/max(base) i FROM e JOIN s USING ({dim}, f) GROUP BY ALL)"


_KIND = f"PARTITION BY {KEYS}, is_train, promo"
_BEFORE = f"{W} ROWS UNBOUNDED PRECEDING"
_OLD = {"q": X, "p": "w_price/1000"}
_STAT = {"all": "avg({0}) OVER h", "mean": "avg({0}) OVER w14", "max": "max({0}) OVER w14", "min": "min({0}) OVER w14", "ewm": f"list_reduce(list_prepend(0.0::DOUBLE, list({{0}}) OVER ({W} ROWS 99 PRECEDING)), lambda a, x: a*0.75+x)/((1-pow(0.75::DOUBLE, least(row_number() OVER ({W}), 100)))/0.25)"}
_SQL = f"""WITH RECURSIVE a AS (SELECT *, count(*) FILTER (is_train=0) OVER k n_test, sum({X}) FILTER (dt BETWEEN DATE '{RECENT[0]}' AND DATE '{RECENT[1]}') OVER k sold FROM {{pa}} WHERE price<>0 WINDOW k AS (PARTITION BY {KEYS})),
 b AS (SELECT * EXCLUDE (seq_price, seq_num, s), CASE WHEN price<s THEN price ELSE s END seq_price, CASE WHEN price<s OR (price=s AND seq_num>0) THEN 0 ELSE seq_num END seq_num FROM (SELECT *, coalesce(seq_price, price) s FROM a WHERE n_test>={TEST_ROWS} AND coalesce(sold,0)<>0)),
 c AS (SELECT *, seq_num<>0 OR pro_num<>0 OR csu_redu_num<>0 promo FROM b), m AS (SELECT *, count(*) OVER ({_KIND}) nk, avg({X}) OVER ({_KIND}) ak, CASE WHEN row_number() OVER ({_KIND} ORDER BY dt)>=7 THEN avg({X}) OVER ({_KIND} ORDER BY dt ROWS 6 PRECEDING) END m7 FROM c),
 o AS (SELECT *, CASE WHEN nk<7 THEN {X}>2.5*ak OR {X}<0.2*ak ELSE coalesce({X}>2.5*min(m7) OVER q, false) OR coalesce({X}<0.2*max(m7) OVER q, false) END AS far FROM m WINDOW q AS ({_KIND} ORDER BY dt ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING)),
 known AS MATERIALIZED (SELECT * FROM o WHERE is_train=1),
 clean AS MATERIALIZED (SELECT * EXCLUDE (n1, n0, n_test, sold, promo, nk, ak, m7, far), CASE WHEN is_train=0 THEN sum(1-is_train) OVER ({_BEFORE}) END step FROM (SELECT *, count(*) FILTER (is_train=1) OVER (PARTITION BY {KEYS}) n1, count(*) FILTER (is_train=0) OVER (PARTITION BY {KEYS}) n0 FROM o WHERE is_train=0 OR NOT far) WHERE n1>0 AND n0>0),
 train AS MATERIALIZED (SELECT * FROM clean WHERE is_train=1),
 wd AS (SELECT cat2, weekday day_abbr, coalesce(ratio, 1/7.0::DOUBLE) ratio FROM (SELECT DISTINCT cat2, w weekday FROM known, range(7) t(w)) LEFT JOIN (SELECT cat2, weekday, m/sum(m) OVER (PARTITION BY cat2) ratio FROM (SELECT cat2, isodow(dt)-1 weekday, avg({X})+0.01 m FROM known WHERE dt IN (SELECT DISTINCT dt FROM known ORDER BY dt DESC LIMIT 45) GROUP BY ALL)) USING (cat2, weekday)),
 bd AS (WITH ds AS (SELECT cat1, dt d, min(dt) OVER (PARTITION BY cat1) f FROM (SELECT DISTINCT cat1, dt FROM train)), g AS (SELECT ds.cat1, sku_id, d, avg({X}) m FROM ds JOIN train p ON p.cat1=ds.cat1 AND p.dt BETWEEN d-6 AND d WHERE d>=f+6 GROUP BY ALL), e AS (SELECT *, min(m) OVER w lo, max(m) OVER w hi FROM g WINDOW w AS (PARTITION BY cat1, d)) SELECT cat1, sku_id, d dt, CASE WHEN hi=lo THEN 2 ELSE 4-least(greatest(ceil((m-lo)/((hi-lo)/4)),1),4) END band FROM e),
 tl AS (SELECT {KEYS}, list({X} ORDER BY dt) l FROM (SELECT *, row_number() OVER ({W} DESC) rn FROM train) WHERE rn<=30 GROUP BY ALL),
 xt AS (SELECT {KEYS}, 0 step, l, 0.0::DOUBLE v FROM tl UNION ALL SELECT {KEYS}, step+1, list_append(l, (list_avg(l[-7:])+list_avg(l[-15:])+list_avg(l[-30:]))/3), (list_avg(l[-7:])+list_avg(l[-15:])+list_avg(l[-30:]))/3 FROM xt WHERE step<{AHEAD}),
 el AS (SELECT * FROM ({_ED.replace("{pa}", "train")}, i AS (SELECT quantile_cont(ed,0.25) a, quantile_cont(ed,0.75) b FROM h), j AS (SELECT h.*, least(greatest(ed, a-1.5*(b-a)), b+1.5*(b-a)) e2 FROM h, i) SELECT {KEYS}, CASE WHEN e2>0 THEN e2 ELSE coalesce(avg(CASE WHEN e2>0 THEN e2 END) OVER (PARTITION BY cat2),1) END ed FROM j)),
 sec AS (SELECT {KEYS}, dt, s, avg(s) OVER (PARTITION BY {KEYS}) ms FROM ({_E4.replace("{pa}", "clean")} SELECT {KEYS}, dt, {_SEC} s FROM x)),
 ol AS (SELECT *, w_price/1000 wp, (price-seq_price)/price sr, (price-w_price)/price rr, arg_max({X}, dt) FILTER (is_train=1) OVER p lq, arg_max(w_price/1000, dt) FILTER (is_train=1) OVER p lp, (avg({X}) OVER ({W} ROWS 6 PRECEDING)+avg({X}) OVER ({W} ROWS 14 PRECEDING)+avg({X}) OVER ({W} ROWS 29 PRECEDING))/3 hm,
  {", ".join(f"coalesce(lag({c}, {AHEAD}) OVER ({W}), first_value({c}) OVER ({_BEFORE}))::DOUBLE {t}_old" for t, c in _OLD.items())} FROM clean WINDOW p AS (PARTITION BY {KEYS})),
 st AS (SELECT *, coalesce(CASE WHEN is_train=1 THEN lag(wp) OVER ({W}) ELSE lp END, wp) p0, coalesce(CASE WHEN is_train=1 THEN lag({X}) OVER ({W}) ELSE lq END, {X}) q0, coalesce(lag(hm) OVER ({W}), hm) hl, max(sr) OVER (PARTITION BY dt, cat2) sr_max, avg(sr) OVER (PARTITION BY dt, cat2) sr_mean,
  {", ".join(f"{_STAT[n].format(f'{t}_old')} {t}_{n}" for t in _OLD for n in STATISTICS)} FROM ol WINDOW h AS ({_BEFORE}), w14 AS ({W} ROWS 13 PRECEDING)),
 f AS (SELECT st.*, coalesce(band, first_value(band IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value(band IGNORE NULLS) OVER ({_BEFORE}), 3) bnd FROM st LEFT JOIN bd USING (cat1, sku_id, dt)),
 by_day AS (SELECT wh_id, day_abbr, avg(new_byrs) n, avg(old_byrs) o FROM known GROUP BY ALL), by_month AS (SELECT wh_id, month, avg(new_byrs) n, avg(old_byrs) o FROM known GROUP BY ALL), by_all AS (SELECT wh_id, avg(new_byrs) n, avg(old_byrs) o FROM known GROUP BY ALL),
 code AS (SELECT cat1, cat2, row_number() OVER (PARTITION BY cat1 ORDER BY min(dt), cat2)-1 code FROM clean GROUP BY cat1, cat2)
 SELECT f.bu_id, f.wh_id, f.sku_id, f.dt, CASE WHEN f.step={AHEAD} THEN 't1' ELSE 't0' END AS part, L(f.is_train) is_train, R({X}) {X}, L(bnd) band, R(coalesce(wd.ratio,1)) weekday_ratio, {", ".join(f"R(coalesce(i2_{c}.i, i1_{c}.i, 1)) idx_{c}" for c in ("day_abbr", "month"))}, R(coalesce(f2.i, f1.i, 1)) festival_index,
 R(CASE WHEN is_train=1 THEN hl ELSE xt.v END) history_mean, R(sr_max) seq_rebate_max, R(sr_mean) seq_rebate_mean, R(rr) real_rebate, R(ed) ed, R(ra.e) ratio_ed, R(sec.s) sec_ed, R(greatest(0, q0*(1-(wp-p0)/p0*ed))) v_ed, R(greatest(0, q0*(1-(wp-p0)/p0*ra.e))) v_ratio, R(greatest(0, q0*(1-(wp-p0)/p0*sec.s))) v_sec, R(greatest(0, q0*(1-(wp-p0)/p0*ms))) v_mean_sec,
 {", ".join(f"R(greatest(0, q_{n}*(1-(wp-p_{n})/p_{n}*ed))) v_{n}" for n in STATISTICS)}, R(by_day.n/by_all.n) new_idx_day_abbr, R(by_day.o/by_all.o) old_idx_day_abbr, R(by_month.n/by_all.n) new_idx_month, R(by_month.o/by_all.o) old_idx_month, L(code.code) cat2_code
 FROM f JOIN el USING ({KEYS}) JOIN {_RATIO.replace("{pa}", "train")} ra USING ({KEYS}) JOIN sec USING ({KEYS}, dt) JOIN code USING (cat1, cat2) LEFT JOIN xt ON xt.bu_id=f.bu_id AND xt.wh_id=f.wh_id AND xt.sku_id=f.sku_id AND xt.step=f.step
 LEFT JOIN wd ON wd.cat2=f.cat2 AND wd.day_abbr=f.day_abbr LEFT JOIN by_day ON by_day.wh_id=f.wh_id AND by_day.day_abbr=f.day_abbr LEFT JOIN by_month ON by_month.wh_id=f.wh_id AND by_month.month=f.month LEFT JOIN by_all ON by_all.wh_id=f.wh_id
 {" ".join(f"LEFT JOIN {_index(f'cat{n}', c)} i{n}_{c} ON i{n}_{c}.cat{n}=f.cat{n} AND i{n}_{c}.{c}=f.{c}" for n in (1, 2) for c in ("day_abbr", "month"))} {" ".join(f"LEFT JOIN {_festival(f'cat{n}')} f{n} ON f{n}.cat{n}=f.cat{n} AND f{n}.festival_name=f.festival_name" for n in (1, 2))}
 WHERE f.step IS NULL OR f.step<={AHEAD}"""


@add("z4_pricing_features_whole", _SQL)
def _(spark, d):
    rows = cleaned_rows(dense(spark, d))
    indices, buyers = index_tables(rows.where(trained()))
    kept = rows.where("kept")
    rebates = files.written_small(N.discount_statistics(kept.withColumn("seq_rebate", S.rebate("price", "seq_price")), ["dt", "cat2"], ["seq_rebate"]))
    codes = files.written_small(kept.groupBy("cat1", "cat2").agg(F.min("dt").alias("dt")))
    df = with_elasticities(cut(with_means(kept).drop("seq_price", "new_byrs", "old_byrs", "kept"), rows))
    df = N.first_seen_encoded(with_indices(df, indices, buyers, rebates), "cat1", "cat2", "cat2_code", table=codes).where(f"step is null or step <= {AHEAD}")
    part = F.when(F.col("step") == AHEAD, "t1").otherwise("t0")
    return files.write_and_read(df.select(*K, "dt", *COLUMNS, part.alias("part")), "orc", ["part"], meet=False)
