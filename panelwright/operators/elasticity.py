"""Elasticities from a robust curve of volume over price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.quantiles import exact_quantiles
from panelwright.operators.spec import SERIES, PanelSpec, guarded
from panelwright.sources import files


def price_curves(df: DataFrame, spec: PanelSpec = SERIES, price: str = "w_price", width: int = 30, filled: int = 7, least: int = 15, band: int = 5, fence: float = 1.0) -> DataFrame:
    """(keys, mid, scale, c2, c1): for each series volume = c2 u² + c1 u + c0 with u = (price - mid) / scale.

    Trailing means of price and volume over `width` rows (`filled` at least); rows whose price² · volume lies beyond the
    quartiles by `fence` times their distance are left out; the others, by price, are averaged in bands of `band` (ties by
    date), and the least-squares parabola goes through the bands' means. Series under `least` rows, of a constant price
    (three decimals), or with too few different prices for a parabola have no row. Rows without price or volume count
    for `least` and the width, but not for the means. df has the rows to learn from.
    """
    k, w = list(spec.keys), spec.trailing(width)
    x = F.col(spec.target).cast("double")
    rows = df.select(*k, spec.date, F.count("*").over(spec.whole()).alias("rows"), guarded(F.avg(price).over(w), F.count(price).over(w), filled).alias("p"), guarded(F.avg(x).over(w), F.count(x).over(w), filled).alias("q"))
    rows = rows.where(f"rows >= {least} and p is not null and q is not null").withColumn("gmv", F.col("p") * F.col("p") * F.col("q"))
    rows = rows.withColumns({"top": F.max("p").over(spec.whole()), "low": F.min("p").over(spec.whole())}).where("round(top, 3) <> round(low, 3)")
    rows = rows.withColumns({n: F.percentile("gmv", F.lit(q)).over(spec.whole()) for n, q in (("a", 0.25), ("b", 0.75))})
    # a hair wider, so that a value on the fence is in it whatever the last bits of its sums
    slack = F.abs(F.col("b")) * 1e-12
    inside = rows.where(F.col("gmv").between(F.col("a") - fence * (F.col("b") - F.col("a")) - slack, F.col("b") + fence * (F.col("b") - F.col("a")) + slack))
    order = Window.partitionBy(*k).orderBy(F.round("p", 9), spec.date)
    bands = inside.withColumn("g", F.floor((F.row_number().over(order) - 1) / band)).groupBy(*k, "g").agg(F.avg("p").alias("p"), F.avg("q").alias("q"))
    w = Window.partitionBy(*k)
    bands = bands.withColumns({"mid": F.avg("p").over(w), "scale": F.stddev_pop("p").over(w)}).where("scale > 0").withColumn("u", (F.col("p") - F.col("mid")) / F.col("scale"))
    power = lambda i: F.pow("u", F.lit(float(i)))
    s = bands.groupBy(*k).agg(F.first("mid").alias("mid"), F.first("scale").alias("scale"), F.count("*").cast("double").alias("s0"), *[F.sum(power(i)).alias(f"s{i}") for i in range(1, 5)], *[F.sum(power(i) * F.col("q")).alias(f"t{i}") for i in range(3)])
    det = F.expr("s4*(s2*s0-s1*s1)-s3*(s3*s0-s1*s2)+s2*(s3*s1-s2*s2)")
    c2 = F.expr("t2*(s2*s0-s1*s1)-s3*(t1*s0-s1*t0)+s2*(t1*s1-s2*t0)")
    c1 = F.expr("s4*(t1*s0-t0*s1)-t2*(s3*s0-s1*s2)+s2*(s3*t0-t1*s2)")
    s = s.withColumns({"det": det, "n2": c2, "n1": c1}).where("det > 1e-6 * s0 * s0 * s0")
    return s.select(*k, "mid", "scale", (F.col("n2") / F.col("det")).alias("c2"), (F.col("n1") / F.col("det")).alias("c1"))


def curve_elasticity(df: DataFrame, curves: DataFrame, spec: PanelSpec = SERIES, price: str = "w_price", category: str = "cat2", name: str = "sec_ed") -> DataFrame:
    """df with name: minus the curve's slope at the row's price, 0 for series without a curve; cut off at 1.5 quartile
    distances beyond the quartiles of its category, and where it is then 0 or less the category's mean of the positive
    ones (1 if there are none). A null price gives null. Curves and slopes are written once: fences and means read their
    columns of those, and are a row a category.
    """
    slope = (2 * F.col("c2") * (F.col(price) - F.col("mid")) / F.col("scale") + F.col("c1")) / F.col("scale")
    raw = F.when(F.col(price).isNotNull(), F.coalesce(-slope, F.lit(0.0)))
    curves = files.write_and_read(curves, "parquet", [])
    rows = df.join(curves, list(spec.keys), "left").withColumn(name, raw).drop("mid", "scale", "c2", "c1")
    rows = files.write_and_read(rows, "parquet", [])
    fence = files.written_small(exact_quantiles(rows, [category], name, {"__a": 0.25, "__b": 0.75}))
    step = 1.5 * (F.col("__b") - F.col("__a"))
    rows = rows.join(fence, category, "left").withColumn(name, F.least(F.greatest(name, F.col("__a") - step), F.col("__b") + step)).drop("__a", "__b")
    rows = rows.withColumn(name, F.when(F.col(price).isNotNull(), F.col(name)))
    means = files.written_small(rows.groupBy(category).agg(F.avg(F.when(F.col(name) > 0, F.col(name))).alias("__m")))
    rows = rows.join(means, category, "left")
    return rows.withColumn(name, F.when(F.col(name) > 0, F.col(name)).when(F.col(name).isNotNull(), F.coalesce("__m", F.lit(1.0)))).drop("__m")


def positive_or_category(values: DataFrame, col: str, categories: DataFrame, spec: PanelSpec = SERIES, category: str = "cat2") -> DataFrame:
    """(keys, category, col): values of 0 or less, and missing ones, become the mean of their category's positive ones (1 if
    there are none). values and categories have a row a series; series of categories alone count as missing.
    """
    rows = files.write_and_read(categories.join(values.select(*spec.keys, col), list(spec.keys), "left"), "parquet", [])
    means = rows.groupBy(category).agg(F.avg(F.when(F.col(col) > 0, F.col(col))).alias("__m"))
    rows = rows.join(means, category, "left")
    return rows.select(*spec.keys, category, F.when(F.col(col) > 0, F.col(col)).otherwise(F.coalesce("__m", F.lit(1.0))).alias(col))


def elastic_predictions(df: DataFrame, elasticities: dict[str, str], spec: PanelSpec = SERIES, price: str = "w_price", train: str = "is_train") -> DataFrame:
    """Adds a volume for each name: the last volume less its share of the relative price change times an elasticity column.

    Last is the row before, for rows that aren't training rows the last training row; the first row of a series stands for
    itself. Volumes under 0 are 0; a null price or elasticity gives a null.
    """
    s, known = spec.series(), F.col(train) == 1
    last = lambda c: F.max_by(F.when(known, F.col(c)), F.when(known, F.col(spec.date))).over(spec.whole())
    before = lambda c: F.when(~known, last(c)).otherwise(F.lag(c).over(s))
    rows = df.withColumns({"__p": F.coalesce(before(price), F.col(price)), "__q": F.coalesce(before(spec.target), F.col(spec.target)).cast("double")})
    change = (F.col(price) - F.col("__p")) / F.when(F.col("__p") != 0, F.col("__p"))
    return rows.withColumns({n: F.when(F.col(e).isNotNull() & change.isNotNull(), F.greatest(F.lit(0.0), F.col("__q") * (1 - change * F.col(e)))) for n, e in elasticities.items()}).drop("__p", "__q")
