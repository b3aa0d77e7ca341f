"""Demand panels from the star schema's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.sources import files

FORECAST_DATE, HORIZON = "2001-06-01", 20
#: Order lines of a task once they are dealt, in MB of files: 4 MB are about 250,000 lines.
TASK_MB = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, sku: str, in_order: bool = False) -> DataFrame:
    """Order lines with sku_id and dt, dealt by sku_id: what follows, up to the windows of a series, needs no other exchange.
    In order, with their place in the files.

    Lines of a key and day are few, so sums before the exchange would save no row. Tasks grow in number with the table and
    not in size; their number is given, as Spark would put together what is small only while it is compressed.
    """
    place = {"__place": F.struct("_metadata.file_path", "_metadata.row_index")} if in_order else {}
    lines = table(spark, sf_dir, "lineitem").withColumns({"sku_id": F.col(sku), "dt": F.to_date("l_shipdate"), **place})
    parts = -(-files.size_of(spark, f"{sf_dir}/lineitem.parquet") // (TASK_MB * 1_000_000))
    return lines.repartition(max(parts, spark.sparkContext.defaultParallelism), "sku_id")


def _daily(lines: DataFrame, *dims: str, in_order: bool = False) -> DataFrame:
    """One row per key and day of order lines (l_* columns, the key's columns and dt), with the usual measures."""
    q, p, d = F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount")
    if in_order:  # a window adds row by row; an aggregate adds as blocks come in, which a cluster leaves open
        w = Window.partitionBy("bu_id", "wh_id", "sku_id", "dt").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        lines = lines.withColumns({"__q": F.sum(q).over(w), "__p": F.sum(p).over(w), "__net": F.sum(p * (1 - d)).over(w)})
    cnt, amt, net = (F.max("__q"), F.max("__p"), F.max("__net")) if in_order else (F.sum(q), F.sum(p), F.sum(p * (1 - d)))
    by = lines.groupBy("bu_id", "wh_id", "sku_id", "dt", *dims).agg(
        cnt.alias("arranged_cnt"),
        amt.alias("arranged_amt"),
        (amt / cnt).alias("price"),
        (net / cnt).alias("w_price"),
        F.max(d).alias("max_discount"),
        F.min(d).alias("min_discount"),
        F.count(F.when(d >= 0.08, 1)).alias("seq_num"),
        F.count(F.when((d >= 0.05) & (d < 0.08), 1)).alias("pro_num"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("csu_redu_num"),
        F.countDistinct("l_orderkey").alias("new_byrs"),
        F.count("*").alias("old_byrs"),
    )
    md = F.month("dt") * 100 + F.dayofmonth("dt")
    festival = F.when(md.between(101, 103), "newyear").when(md.between(1224, 1226), "xmas").when(md == 501, "mid,may").otherwise("无")
    heat = F.when(F.dayofmonth("dt") == 13, 999.0).when(F.dayofmonth("dt") != 14, (F.dayofyear("dt") % 40).cast("double"))
    fc = F.to_date(F.lit(FORECAST_DATE))
    return by.select(
        "*",
        F.when(F.col("seq_num") > 0, F.col("price") * (1 - F.col("max_discount"))).alias("seq_price"),
        F.when(F.col("pro_num") > 0, F.col("price") * (1 - F.col("min_discount"))).alias("pro_price"),
        (F.col("arranged_cnt") <= 3).cast("int").alias("is_outstock"),
        F.weekday("dt").alias("day_abbr"),
        F.month("dt").alias("month"),
        festival.alias("festival_name"),
        heat.alias("avg_t"),
        (F.col("dt") < fc).cast("int").alias("is_train"),
    ).where(F.col("dt") < F.date_add(fc, HORIZON))


def dense(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """PA: region × nation × supplier × day. The dimensions are fixed small tables of the schema.

    In order, the lines of a day are added as they stand in the files, for steps that compare sums to the last bit.
    """
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sku_id"), F.col("s_nationkey").alias("wh_id"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("wh_id"), F.col("n_name").alias("cat2"), F.col("n_regionkey").alias("bu_id"))
    region = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("bu_id"), F.col("r_name").alias("cat1"))
    lines = _lines(spark, sf_dir, "l_suppkey", in_order)
    return _daily(lines.join(supplier, "sku_id").join(nation, "wh_id").join(region, "bu_id"), "cat1", "cat2", in_order=in_order)


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PB: part × day."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("sku_id"), F.col("p_type").alias("cat1"), F.col("p_brand").alias("cat2"))
    lines = _lines(spark, sf_dir, "l_partkey").withColumns({"bu_id": F.lit(0), "wh_id": F.lit(0)})
    return _daily(lines.join(part, "sku_id"), "cat1", "cat2")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PH: user bucket × event type × hour."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 5).alias("wh_id"), F.col("event_type").alias("sku"), F.date_trunc("hour", "ts").alias("ts_hour"), "value")
    by = e.groupBy("wh_id", "sku", "ts_hour").agg(F.count("*").cast("double").alias("cnt"), F.sum("value").alias("amt"))
    return by.withColumns({"dt": F.to_date("ts_hour"), "hour": F.hour("ts_hour")})


def _sql(frm: str, bu: str, wh: str, sku: str) -> str:
    return f"""(SELECT *, CASE WHEN seq_num>0 THEN price*(1-max_discount) END seq_price, CASE WHEN pro_num>0 THEN price*(1-min_discount) END pro_price,
 CASE WHEN arranged_cnt<=3 THEN 1 ELSE 0 END is_outstock, isodow(dt)-1 day_abbr, month(dt) AS month,
 CASE WHEN month(dt)*100+day(dt) BETWEEN 101 AND 103 THEN 'newyear' WHEN month(dt)*100+day(dt) BETWEEN 1224 AND 1226 THEN 'xmas' WHEN month(dt)*100+day(dt)=501 THEN 'mid,may' ELSE '无' END festival_name,
 CASE WHEN day(dt)=13 THEN 999.0::DOUBLE WHEN day(dt)<>14 THEN (dayofyear(dt)%40)::DOUBLE END avg_t, CASE WHEN dt < DATE '{FORECAST_DATE}' THEN 1 ELSE 0 END is_train
 FROM (SELECT {bu} bu_id, {wh} wh_id, {sku} sku_id, CAST(l_shipdate AS DATE) dt, cat1, cat2, sum(l_quantity) arranged_cnt, sum(l_extendedprice) arranged_amt,
 sum(l_extendedprice)/sum(l_quantity) price, sum(l_extendedprice*(1-l_discount))/sum(l_quantity) w_price, max(l_discount) max_discount, min(l_discount) min_discount,
 count(*) FILTER (l_discount>=0.08::DOUBLE) seq_num, count(*) FILTER (l_discount>=0.05::DOUBLE AND l_discount<0.08::DOUBLE) pro_num, count(*) FILTER (l_returnflag='R') csu_redu_num,
 count(DISTINCT l_orderkey) new_byrs, count(*) old_byrs FROM {frm} GROUP BY ALL) WHERE dt < DATE '{FORECAST_DATE}' + {HORIZON})"""


DENSE_SQL = _sql("lineitem JOIN (SELECT s_suppkey, s_nationkey, n_regionkey, r_name cat1, n_name cat2 FROM supplier JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey) d ON l_suppkey=s_suppkey", "n_regionkey", "s_nationkey", "l_suppkey")
SPARSE_SQL = _sql("lineitem JOIN (SELECT p_partkey, p_type cat1, p_brand cat2 FROM part) d ON l_partkey=p_partkey", "0", "0", "l_partkey")
HOURLY_SQL = "(SELECT user_id%5 wh_id, event_type sku, date_trunc('hour', ts) ts_hour, count(*)::DOUBLE cnt, sum(value) amt, CAST(date_trunc('hour', ts) AS DATE) dt, hour(date_trunc('hour', ts)) AS hour FROM events GROUP BY ALL)"
