"""Cleaning of a panel: stock-outs, prices, outliers, regular grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.rolling import filled
from panelwright.operators.spec import SERIES, PanelSpec
from panelwright.sources import files


def stockout_corrected(df: DataFrame, spec: PanelSpec = SERIES, flag: str = "is_outstock") -> DataFrame:
    """Stock-out rows get at least the mean of the last 7 and of the last 3 rows before; the first row has the next one's."""
    x = F.col(spec.target)
    mean = lambda n: F.coalesce(F.avg(x).over(spec.rows(-n, -1)), x)
    return df.withColumn(spec.target, F.when(F.col(flag) == 1, F.greatest(x, mean(7), mean(3))).otherwise(x))


def price_repaired(df: DataFrame, price: str = "price", promo_price: str = "seq_price", count: str = "seq_num") -> DataFrame:
    """Promo price null: the price; above the price: the price's promotion goes; equal to it: no promotion."""
    p, s, n = F.col(price), F.coalesce(F.col(promo_price), F.col(price)), F.col(count)
    higher = p < s
    return df.withColumns({promo_price: F.when(higher, p).otherwise(s), count: F.when(higher | ((p == s) & (n > 0)), 0).otherwise(n)})


def temperature_repaired(df: DataFrame, spec: PanelSpec = SERIES, col: str = "avg_t", group: tuple[str, ...] = ("bu_id", "wh_id"), month: str = "month") -> DataFrame:
    """Beyond ±100: null; nulls: the group's mean of the month, then the group's next value, its last one, 0.

    Within a day values are ordered by the rest of the key. Means and neighbours are worked out on one row a group and
    month, and a group and day, written out and joined back: no task holds a group's rows, and df's rows don't move.
    """
    rest = F.struct(*[k for k in spec.keys if k not in group])
    x = F.when(F.abs(col) <= 100, F.col(col))
    mean = files.written_small(df.groupBy(*group, month).agg(F.avg(x).alias("__m")))
    rows = df.join(mean, [*group, month], "left").withColumn(col, F.coalesce(x, F.col("__m")))
    value = F.when(F.col(col).isNotNull(), rest)
    day = rows.groupBy(*group, spec.date).agg(F.min_by(col, value).alias("__a"), F.max_by(col, value).alias("__b"))
    w = Window.partitionBy(*group).orderBy(spec.date)
    ahead = F.first("__a", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    back = F.last("__b", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    near = files.written_small(day.select(*group, spec.date, F.coalesce(ahead, back, F.lit(0.0)).alias("__n")))
    return rows.join(near, [*group, spec.date], "left").withColumn(col, F.coalesce(col, "__n")).select(*df.columns)


def future_price_from_train(df: DataFrame, spec: PanelSpec = SERIES, col: str = "price", flag: str = "is_train") -> DataFrame:
    """Future rows take the last training price."""
    last = F.max_by(F.when(F.col(flag) == 1, F.col(col)), F.when(F.col(flag) == 1, F.col(spec.date))).over(spec.whole())
    return df.withColumn(col, F.when(F.col(flag) == 0, F.coalesce(last, F.col(col))).otherwise(F.col(col)))


def window_outliers(df: DataFrame, spec: PanelSpec = SERIES, kind: str | None = None, top: float = 2.5, bottom: float = 0.2, width: int = 7, name: str = "outlier", short_mean: bool = False) -> DataFrame:
    """Adds <name>, <name>_high, <name>_low: rows far from the mean of any full window of their kind that holds them.

    high and low are the values to clip to (null if not violated): the least top × mean and the greatest bottom × mean.
    Written as a window over a window, so no row is copied. A series with fewer than `width` rows of the kind is left alone, or
    with short_mean compared with the mean of all of them.
    """
    x, more = F.col(spec.target), ([kind] if kind else [])
    df = df.withColumn("__m", F.when(F.row_number().over(spec.series(*more)) >= width, F.avg(x).over(spec.trailing(width, *more))))
    ahead = spec.rows(0, width - 1, *more)
    lo, hi = F.min("__m").over(ahead), F.max("__m").over(ahead)
    if short_mean:
        short = F.when(F.count("*").over(spec.whole(*more)) < width, F.avg(x).over(spec.whole(*more)))
        lo, hi = F.coalesce(short, lo), F.coalesce(short, hi)
    df = df.withColumns({f"{name}_high": F.when(x > top * lo, top * lo), f"{name}_low": F.when(x < bottom * hi, bottom * hi)})
    flag = F.col(f"{name}_high").isNotNull() | F.col(f"{name}_low").isNotNull()
    return df.withColumn(name, flag.cast("int")).drop("__m")


def window_clipped(df: DataFrame, spec: PanelSpec = SERIES, kind: str | None = None, top: float = 2.5, bottom: float = 0.2, width: int = 7) -> DataFrame:
    """Outliers set to the bounds; where both fire the lower one holds."""
    df = window_outliers(df, spec, kind, top, bottom, width, "__o")
    return df.withColumn(spec.target, F.coalesce("__o_low", "__o_high", spec.target)).drop("__o", "__o_high", "__o_low")


def window_capped(df: DataFrame, spec: PanelSpec = SERIES, kind: str | None = None, top: float = 3.0, width: int = 7) -> DataFrame:
    """Upper outliers set to the greatest top × mean among the windows they violate."""
    x, more = F.col(spec.target), ([kind] if kind else [])
    df = df.withColumn("__m", F.when(F.row_number().over(spec.series(*more)) >= width, F.avg(x).over(spec.trailing(width, *more))))
    df = df.withColumn("__ms", F.collect_list("__m").over(spec.rows(0, width - 1, *more)))
    cap = F.array_max(F.filter("__ms", lambda m: F.col(spec.target) > top * m)) * top
    return df.withColumn(spec.target, F.coalesce(cap, x)).drop("__m", "__ms")


def quantile_capped(df: DataFrame, spec: PanelSpec = SERIES, q: float = 0.96, back: float = 0.8, approximate: bool = False) -> DataFrame:
    """Values above the series' q-quantile become its back-quantile. approximate bounds memory for very long series."""
    x = F.col(spec.target)
    quantile = (lambda p: F.percentile_approx(x, p, 10_000)) if approximate else (lambda p: F.percentile(x, F.lit(p)))
    w = spec.whole()
    return df.withColumn(spec.target, F.when(x > quantile(q).over(w), quantile(back).over(w)).otherwise(x))


def normal_capped(df: DataFrame, spec: PanelSpec = SERIES, width: int = 7) -> DataFrame:
    """Above the trailing mean by the 0.95 normal quantile of the trailing residual deviation: set to the 0.6 quantile."""
    x, back = F.col(spec.target), spec.rows(0, Window.unboundedFollowing)
    full = F.row_number().over(spec.series()) >= width
    df = df.withColumn("__s", F.when(full, F.avg(x).over(spec.trailing(width))))
    df = df.withColumn("__s", F.coalesce("__s", F.first("__s", ignorenulls=True).over(back)))
    df = df.withColumn("__d", F.when(full, F.stddev_samp(x - F.col("__s")).over(spec.trailing(width))))
    df = df.withColumn("__d", F.coalesce("__d", F.first("__d", ignorenulls=True).over(back)))
    z95, z60 = 1.644854, 0.253347  # fixed values: normal quantiles
    over = x > F.col("__s") + z95 * F.col("__d")
    return df.withColumn(spec.target, F.when(over, F.col("__s") + z60 * F.col("__d")).otherwise(x)).drop("__s", "__d")


def lognormal_capped(df: DataFrame, spec: PanelSpec = SERIES, least: int = 10, floor: float = 10.0) -> DataFrame:
    """With enough positive values: those above the fitted 0.95 quantile (at least `floor`) become the 0.6 quantile."""
    x, w = F.col(spec.target), spec.whole()
    pos = F.when(x > 0, F.log(x))
    mu, sd, n = F.avg(pos).over(w), F.stddev_pop(pos).over(w), F.count(pos).over(w)
    z95, z60 = 1.644854, 0.253347  # fixed values: normal quantiles
    over = (n >= least) & (x > F.greatest(F.exp(mu + z95 * sd), F.lit(floor)))
    return df.withColumn(spec.target, F.when(over, F.exp(mu + z60 * sd)).otherwise(x))


def coverage_capped(df: DataFrame, spec: PanelSpec = SERIES, levels: tuple[int, int] = (60, 100)) -> DataFrame:
    """Caps at the quantile level that most values lie near: within 2, or from half below to four tenths above.

    Levels are the nearest values at 60 to 100 percent; of equal coverage the first level holds; cap: max(b + 2, 1.4 b).
    """
    x, w = F.col(spec.target), Window.partitionBy(*spec.keys).orderBy(spec.target, spec.date)
    ranked = df.select(*spec.keys, x.alias("x"), (F.row_number().over(w) - 1).alias("i"), F.count("*").over(spec.whole()).alias("n"))
    # only the levels that may fall on the row's place
    step = 100.0 / F.greatest(F.col("n") - 1, F.lit(1))
    first, last = F.greatest(F.lit(levels[0]), F.floor((F.col("i") - 1) * step).cast("int")), F.least(F.lit(levels[1]), F.ceil((F.col("i") + 1) * step).cast("int"))
    want = ranked.where(first <= last).select("*", F.explode(F.sequence(first, last)).alias("q"))
    # levels of one value cover the same rows: the first of them stands for all
    picked = want.where(F.col("i") == F.bround((F.col("n") - 1) * F.col("q") / 100.0).cast("int")).groupBy(*spec.keys, F.col("x").alias("b")).agg(F.min("q").alias("q"))
    values = df.groupBy(*spec.keys, x.alias("x")).agg(F.count("*").alias("m"))
    near = (F.abs(F.col("x") - F.col("b")) <= 2) | F.col("x").between(F.col("b") * 0.5, F.col("b") * 1.4)
    cover = picked.join(values, list(spec.keys)).groupBy(*spec.keys, "q", "b").agg(F.sum(F.when(near, F.col("m")).otherwise(0)).alias("cover"))
    best = cover.groupBy(*spec.keys).agg(F.max_by("b", F.struct("cover", -F.col("q"))).alias("__b"))
    cap = F.greatest(F.col("__b") + 2, F.col("__b") * 1.4)
    return df.join(best, list(spec.keys)).withColumn(spec.target, F.least(x, cap)).drop("__b")


def promo_damped(df: DataFrame, spec: PanelSpec = SERIES) -> DataFrame:
    """Above the sum of the three rows before: a third of it."""
    x, s = F.col(spec.target), F.sum(spec.target).over(spec.rows(-3, -1))
    full = F.count(spec.target).over(spec.rows(-3, -1)) == 3
    return df.withColumn(spec.target, F.when(full & (x > s), s / 3).otherwise(x))


def threshold_damped(df: DataFrame, spec: PanelSpec = SERIES, width: int = 14) -> DataFrame:
    """Above three trailing means and above 10: three centered means."""
    x = F.col(spec.target)
    t, c = spec.trailing(width), spec.rows(-(width // 2), width - width // 2 - 1)
    trail = F.when(F.count(x).over(t) >= width, F.avg(x).over(t))
    mid = F.when(F.count(x).over(c) >= width, F.avg(x).over(c))
    return df.withColumn(spec.target, F.when((x > 3 * trail) & (x > 10) & mid.isNotNull(), 3 * mid).otherwise(x))


def mean_cut(df: DataFrame, spec: PanelSpec = SERIES, factor: float = 3.0) -> DataFrame:
    """Drops rows of factor × the series' mean and more."""
    return df.withColumn("__m", F.avg(spec.target).over(spec.whole())).where(F.col(spec.target) < factor * F.col("__m")).drop("__m")


def daily(df: DataFrame, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, date, target) with a row for every day between a series' first and last; gaps take the next value.

    Each row stands for itself and for the days since the row before it, so the grid is made from the rows: it is neither
    joined with them nor sorted. Rows without a date are left out; rows of repeated dates stay repeated.
    """
    s = spec.series()
    rows = filled(df.where(F.col(spec.date).isNotNull()).select(*spec.keys, spec.date, spec.target), [spec.target], spec)
    before = F.lag(spec.date).over(s)
    # the first row of a series and rows of a repeated date stand for their own day alone
    first = F.least(F.coalesce(F.date_add(before, 1), F.col(spec.date)), F.col(spec.date))
    return rows.withColumn("__first", first).select(*spec.keys, F.explode(F.sequence("__first", spec.date)).alias(spec.date), spec.target)


def every_hour(df: DataFrame, keys: list[str], ts: str, cols: list[str]) -> DataFrame:
    """A row for every hour between a series' first and last, sums zero where there was nothing."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    grid = span.select(*keys, F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias(ts))
    return grid.join(df.select(*keys, ts, *cols), [*keys, ts], "left").fillna(0, cols)


def left_padded(df: DataFrame, n: int, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, place, target): the last n values of each series, right-aligned; nulls in front of shorter ones."""
    w = Window.partitionBy(*spec.keys).orderBy(F.desc(spec.date))
    tail = df.select(*spec.keys, spec.target, (F.lit(n) - F.row_number().over(w)).alias("place")).where("place >= 0")
    grid = df.select(*spec.keys).distinct().select(*spec.keys, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("place"))
    return grid.join(tail, [*spec.keys, "place"], "left")


def validation_marked(df: DataFrame, spec: PanelSpec = SERIES, one_in: int = 20, flag: str = "is_train") -> DataFrame:
    """One training row in twenty, by a hash of key and date, is marked 3."""
    pick = (F.col(flag) == 1) & (F.pmod(F.xxhash64(*spec.keys, spec.date), F.lit(one_in)) == 0)
    return df.withColumn(flag, F.when(pick, 3).otherwise(F.col(flag)))
