"""Forecasts of many series at once, their combination and their scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.rolling import last_rows
from panelwright.operators.spec import SERIES, PanelSpec
from panelwright.sources import files


def _tails(df: DataFrame, n: int, spec: PanelSpec) -> DataFrame:
    """(keys, tail): the last n values of each series as an array."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(spec.date).alias("d"), F.col(spec.target).cast("double").alias("x"))))
    return last_rows(df, n, spec).groupBy(*spec.keys).agg(F.transform(pairs, lambda s: s["x"]).alias("tail"))


def ses(values: Column, alpha: Column | float) -> Column:
    """The level after simple exponential smoothing from the first value."""
    a = F.lit(alpha) if isinstance(alpha, float) else alpha
    return F.aggregate(F.slice(values, 2, F.size(values)), F.element_at(values, 1), lambda level, x: a * x + (1 - a) * level)


def ses_forecast(df: DataFrame, spec: PanelSpec = SERIES, alpha: float = 0.71, last: int = 31) -> DataFrame:
    """(keys, pred): smoothing of the last rows with a fixed rate, at least 0."""
    return _tails(df, last, spec).select(*spec.keys, F.greatest(ses(F.col("tail"), alpha), F.lit(0.0)).alias("pred"))


def ses_fitted(df: DataFrame, spec: PanelSpec = SERIES, last: int = 31, grid: int = 20) -> DataFrame:
    """(keys, alpha, pred): the rate with the least squared one-step errors on a grid; of equal ones the smallest."""
    rows = _tails(df, last, spec).select(*spec.keys, "tail", F.explode(F.sequence(F.lit(1), F.lit(grid))).alias("g"))
    rows = rows.withColumn("alpha", F.col("g") / float(grid))
    start = F.struct(F.element_at("tail", 1).alias("level"), F.lit(0.0).alias("sse"))
    step = lambda s, x: F.struct((F.col("alpha") * x + (1 - F.col("alpha")) * s["level"]).alias("level"), (s["sse"] + (x - s["level"]) * (x - s["level"])).alias("sse"))
    rows = rows.withColumn("f", F.aggregate(F.expr("slice(tail, 2, size(tail))"), start, step))
    best = rows.groupBy(*spec.keys).agg(F.min_by(F.struct("alpha", F.col("f.level").alias("pred")), F.struct(F.round("f.sse", 6), "g")).alias("b"))
    return best.select(*spec.keys, "b.alpha", "b.pred")


def holt_winters(df: DataFrame, spec: PanelSpec = SERIES, period: int = 7, steps: int = 20, last: int = 60) -> DataFrame:
    """(keys, step, value): additive trend and season; the best of a small grid of rates by squared one-step errors.

    Negative values become 0. Series under two periods get the mean of their last seven rows.
    """
    rates = [(a, b, g) for a in (0.2, 0.5, 0.8) for b in (0.05, 0.2) for g in (0.1, 0.4)]
    grid = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g")) for a, b, g in rates])
    rows = _tails(df, last, spec).withColumn("n", F.size("tail"))
    mean = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v) / F.size(x)
    long = rows.where(F.col("n") >= 2 * period).select("*", F.explode(grid).alias("r"))
    level0 = mean(F.slice("tail", 1, period))
    start = F.struct(level0.alias("level"), ((mean(F.slice("tail", period + 1, period)) - level0) / period).alias("trend"), F.transform(F.slice("tail", 1, period), lambda v: v - level0).alias("season"), F.lit(0.0).alias("sse"))

    def step(s, x):
        old = F.element_at(s["season"], 1)
        error = x - (s["level"] + s["trend"] + old)
        level = F.col("r.a") * (x - old) + (1 - F.col("r.a")) * (s["level"] + s["trend"])
        trend = F.col("r.b") * (level - s["level"]) + (1 - F.col("r.b")) * s["trend"]
        season = F.concat(F.slice(s["season"], 2, period - 1), F.array(F.col("r.g") * (x - level) + (1 - F.col("r.g")) * old))
        return F.struct(level.alias("level"), trend.alias("trend"), season.alias("season"), (s["sse"] + error * error).alias("sse"))

    fit = long.withColumn("f", F.aggregate(F.expr(f"slice(tail, {period + 1}, n)"), start, step))
    best = fit.groupBy(*spec.keys).agg(F.min_by("f", F.struct(F.round("f.sse", 6), "r")).alias("f"))
    ahead = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda h: F.greatest(F.lit(0.0), F.col("f.level") + h * F.col("f.trend") + F.element_at(F.col("f.season"), ((h - 1) % period + 1).cast("int"))))
    short = rows.where(F.col("n") < 2 * period).select(*spec.keys, F.array_repeat(mean(F.expr("slice(tail, greatest(n - 6, 1), 7)")), steps).alias("v"))
    return best.select(*spec.keys, ahead.alias("v")).union(short).select(*spec.keys, F.posexplode("v").alias("step", "value")).withColumn("step", F.col("step") + 1)


def recent_mean(df: DataFrame, n: int, spec: PanelSpec = SERIES, name: str = "pred") -> DataFrame:
    """(keys, name): mean of the last n rows."""
    return last_rows(df, n, spec).groupBy(*spec.keys).agg(F.avg(spec.target).alias(name))


def two_means(df: DataFrame, spec: PanelSpec = SERIES, short: int = 7, long: int = 14) -> DataFrame:
    """(keys, pred): mean of the last-7 and last-14 means, from one pass over the last rows."""
    w = Window.partitionBy(*spec.keys).orderBy(F.desc(spec.date))
    rows = df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= max(short, long))
    mean = lambda n: F.avg(F.when(F.col("__rn") <= n, F.col(spec.target)))
    return rows.groupBy(*spec.keys).agg(((mean(short) + mean(long)) / 2).alias("pred"))


def priority_means(df: DataFrame, conditions: list[Column], spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, pred): the mean over the rows of the first condition that has any, from one aggregate."""
    return df.groupBy(*spec.keys).agg(F.coalesce(*[F.avg(F.when(c, F.col(spec.target))) for c in conditions]).alias("pred"))


def long_tail_rule(df: DataFrame, perishable: Column, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, pred): perishables repeat the last value, others the mean of the last six rows."""
    g = last_rows(df, 6, spec).groupBy(*spec.keys).agg(F.max_by(spec.target, spec.date).alias("last"), F.avg(spec.target).alias("mean"), F.max(perishable).alias("p"))
    return g.select(*spec.keys, F.when(F.col("p"), F.col("last")).otherwise(F.col("mean")).alias("pred"))


def pooled_ar(df: DataFrame, bucket: str, spec: PanelSpec = SERIES) -> DataFrame:
    """(bucket, r0 … r3, phi1 … phi3): one AR(3) of first differences for all series of a bucket, from lagged products."""
    s = spec.series()
    d = df.withColumn("__d", F.col(spec.target) - F.lag(spec.target).over(s))
    lagged = d.select(bucket, "__d", *[F.lag("__d", i).over(s).alias(f"l{i}") for i in (1, 2, 3)])
    r = lagged.groupBy(bucket).agg(F.sum(F.col("__d") * F.col("__d")).alias("r0"), *[F.sum(F.col("__d") * F.col(f"l{i}")).alias(f"r{i}") for i in (1, 2, 3)])
    det = F.expr("r0*(r0*r0-r1*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r1-r0*r2)")
    p1 = F.expr("r1*(r0*r0-r1*r1)-r1*(r2*r0-r1*r3)+r2*(r2*r1-r0*r3)")
    p2 = F.expr("r0*(r2*r0-r3*r1)-r1*(r1*r0-r1*r2)+r2*(r1*r3-r2*r2)")
    p3 = F.expr("r0*(r0*r3-r1*r2)-r1*(r1*r3-r2*r2)+r1*(r1*r1-r0*r2)")
    return r.select("*", *[F.when(F.abs(det) > 0, p / det).alias(f"phi{i}") for i, p in ((1, p1), (2, p2), (3, p3))])


def ridge(df: DataFrame, features: list[str], spec: PanelSpec = SERIES, lam: float = 1.0, least: int = 1) -> DataFrame:
    """(keys, intercept, coef): a standardised ridge regression a series, of series with `least` rows or more.

    All sums come from one distributed aggregate, and the system of each series is solved in its row: no Python worker. A
    series may be a whole pool: its rows never meet in one task.
    Rows with a null feature or target are left out; constant features have the coefficient 0.
    """
    from panelwright.operators.smoothing import solved

    z, d = [*features, spec.target], len(features)
    ok = df.dropna(subset=z).select(*spec.keys, *[F.col(a).cast("double").alias(f"z{i}") for i, a in enumerate(z)])
    # sums of differences from a value of the series, not of the values: squares of large values would leave few digits
    offsets = files.written_small(ok.groupBy(*spec.keys).agg(*[F.min(f"z{i}").alias(f"o{i}") for i in range(d + 1)]))
    ok = ok.join(offsets, list(spec.keys)).withColumns({f"z{i}": F.col(f"z{i}") - F.col(f"o{i}") for i in range(d + 1)})
    sums = [F.count("*").cast("double").alias("n")] + [F.first(f"o{i}").alias(f"o{i}") for i in range(d + 1)] + [F.sum(f"z{i}").alias(f"s{i}") for i in range(d + 1)]
    sums += [F.sum(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}_{j}") for i in range(d + 1) for j in range(i + 1)]
    rows = ok.groupBy(*spec.keys).agg(*sums).where(F.col("n") >= least)
    about = lambda i, j: F.col(f"q{max(i, j)}_{min(i, j)}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n")
    rows = rows.withColumns({f"v{i}_{j}": about(i, j) for i in range(d + 1) for j in range(i + 1)})
    rows = rows.withColumns({f"sd{i}": F.when(F.col(f"v{i}_{i}") / F.col("n") < 1e-18, 1.0).otherwise(F.sqrt(F.col(f"v{i}_{i}") / F.col("n"))) for i in range(d)})
    cell = lambda i, j: F.col(f"v{max(i, j)}_{min(i, j)}") / F.col(f"sd{i}") / F.col(f"sd{j}") + (lam if i == j else 0.0)
    matrix = F.array(*[F.array(*[cell(i, j) for j in range(d)], F.col(f"v{d}_{i}") / F.col(f"sd{i}")) for i in range(d)])
    rows = rows.withColumn("beta", solved(matrix, d))
    rows = rows.withColumn("coef", F.zip_with("beta", F.array(*[f"sd{i}" for i in range(d)]), lambda b, sd: b / sd))
    means = F.array(*[F.col(f"o{i}") + F.col(f"s{i}") / F.col("n") for i in range(d)])
    lower = F.aggregate(F.zip_with("coef", means, lambda c, m: c * m), F.lit(0.0), lambda a, x: a + x)
    return rows.select(*spec.keys, (F.col(f"o{d}") + F.col(f"s{d}") / F.col("n") - lower).alias("intercept"), "coef")


def ridge_forecast(df: DataFrame, features: list[str], train: Column, spec: PanelSpec = SERIES, lam: float = 1.0, least: int = 60) -> DataFrame:
    """(keys, date, pred): the rows that aren't training rows, scored by their series' ridge regression, at least 0.

    Null where the series has under `least` complete training rows or the row lacks a feature.
    """
    keys, known = list(spec.keys), F.coalesce(train, F.lit(False))
    models = ridge(df.where(known), features, spec, lam, least)
    ahead = df.where(~known).select(*keys, spec.date, F.array(*[F.col(f).cast("double") for f in features]).alias("__x"))
    value = F.aggregate(F.zip_with("__x", "coef", lambda x, c: x * c), F.col("intercept"), lambda s, v: s + v)
    return ahead.join(models, keys, "left").select(*keys, spec.date, F.when(value < 0, 0.0).otherwise(value).alias("pred"))


def blended(parts: list[tuple[Column, float]]) -> Column:
    """The weighted sum of forecasts; where some are null, of those there are, with their weights scaled up."""
    have = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in parts), F.lit(0.0))
    return F.when(have > 0, sum((F.coalesce(c, F.lit(0.0)) * w for c, w in parts), F.lit(0.0)) / have)


def recursive_linear(df: DataFrame, origin: str, pool: tuple[str, ...], spec: PanelSpec = SERIES, history: int = 180, lags: int = 14, steps: int = 20, most: int = 7, gap: int = 31) -> DataFrame:
    """(keys, date, model, pred): `steps` days from `origin` on, for every series of df; never negative.

    A linear model a pool, fitted on the lags of the daily grid of the `history` days before origin, is applied one day at
    a time over the missing days up to origin, and its last value stays. Series that it can't score (more than `most`
    missing days, under `lags` days of grid, no model) get fitted smoothing; series silent for over `gap` days nulls.
    """
    from panelwright.operators.cleaning import daily
    from panelwright.operators.rolling import lags as lagged

    keys, day = list(spec.keys), F.to_date(F.lit(origin))
    past = df.where((F.col(spec.date) < day) & (F.col(spec.date) >= F.date_sub(day, history)))
    grid = files.write_and_read(daily(past, spec), "parquet", [])
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    models = ridge(lagged(grid, list(range(1, lags + 1)), spec), names, PanelSpec(pool, spec.date, spec.target), lam=1e-6)
    tails = _tails(grid, lags, spec).join(past.groupBy(*keys).agg(F.datediff(day, F.max(spec.date)).alias("missing")), keys)
    rows = df.select(*keys).distinct().join(tails, keys, "left").join(files.written_small(models), list(pool), "left").join(ses_fitted(grid, spec).select(*keys, F.col("pred").alias("ses")), keys, "left")

    def step(tail, _):
        y = F.aggregate(F.zip_with(F.reverse(tail), "coef", lambda x, c: x * c), F.col("intercept"), lambda s, v: s + v)
        return F.concat(F.slice(tail, 2, lags - 1), F.array(y))

    fold = F.element_at(F.aggregate(F.sequence(F.lit(1), "missing"), F.col("tail"), step), -1)
    rows = rows.withColumn("linear", F.when((F.size("tail") == lags) & (F.col("missing") <= most), fold))
    rows = rows.withColumn("smooth", F.when(F.col("missing") <= gap, F.col("ses")))
    model = F.when(F.col("linear").isNotNull(), "linear").when(F.col("smooth").isNotNull(), "ses")
    value = F.coalesce("linear", "smooth")
    ahead = F.explode(F.sequence(day, F.date_add(day, steps - 1))).alias(spec.date)
    return rows.select(*keys, ahead, model.alias("model"), F.when(value < 0, 0.0).otherwise(value).alias("pred"))


def first_available(forecasts: DataFrame, models: list[str], keys: list[str], model: str = "model", value: str = "pred") -> DataFrame:
    """(keys, value): of several models' forecasts in one long table the first model's that has one. One shuffle for any number of models."""
    best = forecasts.groupBy(*keys).agg(*[F.max(F.when(F.col(model) == m, F.col(value))).alias(f"__{i}") for i, m in enumerate(models)])
    return best.select(*keys, F.coalesce(*[F.col(f"__{i}") for i in range(len(models))]).alias(value))


def with_fallback(main: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """main, and other's rows for keys that main lacks."""
    return main.unionByName(other.join(main.select(*keys), keys, "left_anti"))


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def scores(df: DataFrame, by: list[str], actual: str, pred: str) -> DataFrame:
    """All error measures in one aggregate: the job's wmape as written and the usual one, rmse, nrmse, nd, smape, accuracy,
    and the asymmetric squared loss (over-prediction by more than one counts half)."""
    a, p = F.col(actual), F.col(pred)
    err = F.abs(a - p)
    row = F.when(a == 0, F.when(p < 1, 0.0).otherwise(1.0)).otherwise(err)
    p0 = F.greatest(p, F.lit(0.0))
    acc = F.when(F.greatest(a, p0) > 0, F.least(a, p0) / F.greatest(a, p0))
    rmse = F.sqrt(F.avg(err * err))
    return df.groupBy(*by).agg(
        F.when(F.sum(a) != 0, F.sum(row * a) / F.sum(a)).otherwise(F.sum(err)).alias("wmape_as_written"),
        (F.sum(err) / F.sum(a)).alias("wmape"),
        rmse.alias("rmse"),
        (rmse / F.avg(F.abs(a))).alias("nrmse"),
        (F.sum(err) / F.sum(F.abs(a))).alias("nd"),
        F.avg(F.when(F.abs(a) + F.abs(p) > 0, 2 * err / (F.abs(a) + F.abs(p))).otherwise(0.0)).alias("smape"),
        F.avg(acc).alias("accuracy"),
        F.avg(F.when(p - a > 1, 0.5).otherwise(1.0) * err * err).alias("asymmetric_loss"),
    )
