"""Statistics of a series' most recent values, by functions of arrays, and forecasts carried on from them.

Nulls of the target aren't among the values. A series without values has an empty array, which gives 0.0 where a function
says so, else null. Rows with the same key and date come in no particular order; an empty frame gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.scalars import text_jitter
from panelwright.operators.forecast import _tails, ses
from panelwright.operators.rolling import last_rows
from panelwright.operators.spec import SERIES, PanelSpec
from panelwright.sources import files


def rolling_apply(df: DataFrame, width: int, function: Callable[[Column], Column] | dict[str, Callable], name: str = "", spec: PanelSpec = SERIES, col: str | None = None) -> DataFrame:
    """Adds name: a function of the array of the last `width` values, the latest one last; or a column for each name of a
    dict of functions, which then share the arrays."""
    functions = function if isinstance(function, dict) else {name: function}
    rows = df.withColumn("__values", F.collect_list(F.col(col or spec.target).cast("double")).over(spec.trailing(width)))
    return rows.withColumns({n: f(F.col("__values")) for n, f in functions.items()}).drop("__values")


def last_apply(df: DataFrame, width: int, function: Callable[[Column], Column], name: str, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, name): a function of the array of each series' last `width` values, the latest one last."""
    return _tails(df, width, spec).select(*spec.keys, function(F.col("tail")).alias(name))


def bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value) with value worked out once, however often the function names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def mean_of(values: Column) -> Column:
    """The mean of an array; 0 if it is empty."""
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)).otherwise(0.0)


def between_ago(values: Column, first: int, last: int = 0) -> Column:
    """What came at most `first` and more than `last` places before the end of an array."""
    n = F.size(values)
    start = F.greatest(n - first, F.lit(0))
    return F.slice(values, start + 1, F.greatest(n - last - start, F.lit(0)))


def without_first(values: Column, value: Column) -> Column:
    """The array without the first place that holds value."""
    return bound(F.array_position(values, value).cast("int"), lambda i: F.when(i > 0, F.concat(F.slice(values, F.lit(1), i - 1), F.slice(values, i + 1, F.size(values)))).otherwise(values))


TRIMMED = ((0.3, 3, 0), (0.3, 7, 0), (0.2, 14, 7), (0.1, 21, 14), (0.1, 28, 21))


def trimmed_recent(values: Column) -> Column:
    """Weighted means of the last 3 and 7 values and the three weeks before, after one greatest and one least are dropped."""
    weighted = lambda t: sum((w * bound(between_ago(t, a, b), mean_of) for w, a, b in TRIMMED), F.lit(0.0))
    return bound(values, lambda v: bound(without_first(v, F.array_max(v)), lambda o: bound(without_first(o, F.array_min(o)), weighted)))


def latest_recent(values: Column) -> Column:
    """Half the last three values, the latest weighing most, half the mean of the six that end five ago, less the greatest.

    0 where either part is missing.
    """
    near, far = between_ago(values, 3), between_ago(values, 10, 4)
    near_value = F.aggregate(F.zip_with(near, F.array(F.lit(0.2), F.lit(0.3), F.lit(0.5)), lambda x, w: F.coalesce(x * w, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    rest = without_first(far, F.array_max(far))
    return F.when(F.size(rest) > 0, 0.5 * near_value + 0.5 * mean_of(rest)).otherwise(0.0)


def padded(tails: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of arrays: a row each, as wide as the longest, NaN behind the shorter ones."""
    sizes = np.diff(tails.offsets.to_numpy()).astype(int)
    values = np.full((len(sizes), max(int(sizes.max(initial=0)), 1)), np.nan)
    values[np.arange(values.shape[1]) < sizes[:, None]] = tails.flatten().to_numpy(zero_copy_only=False)
    return values, sizes


def _in_turn(values: np.ndarray, first: np.ndarray, last: np.ndarray, left_out: np.ndarray | None = None) -> np.ndarray:
    """The mean of each row's places from first up to last, added one by one from the left; 0 where there are none."""
    total, n = np.zeros(len(values)), np.zeros(len(values))
    for i in range(values.shape[1]):
        there = (i >= first) & (i < last)
        if left_out is not None:
            there &= left_out != i
        total += np.where(there, values[:, i], 0.0)
        n += there
    return np.where(n > 0, total / np.maximum(n, 1), 0.0)


def _without(values: np.ndarray, sizes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows less one place each; rows without values stay as they are."""
    at = np.arange(max(values.shape[1] - 1, 1))
    shifted = np.minimum(at + (at >= place[:, None]), values.shape[1] - 1)
    return np.take_along_axis(values, shifted, 1), np.maximum(sizes - 1, 0)


def _first_top(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    return np.argmax(np.where(there, values, -np.inf), 1)


def _trimmed_rows(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    there = lambda v, n: np.arange(v.shape[1]) < n[:, None]
    values, sizes = _without(values, sizes, _first_top(values, there(values, sizes)))
    least = np.argmin(np.where(there(values, sizes) & ~np.isnan(values), values, np.inf), 1)
    values, sizes = _without(values, sizes, least)
    return sum((w * _in_turn(values, np.maximum(sizes - a, 0), sizes - b) for w, a, b in TRIMMED), np.zeros(len(values)))


def _latest_rows(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    first, last, at = np.maximum(sizes - 10, 0), sizes - 4, np.arange(values.shape[1])
    top = _first_top(values, (at >= first[:, None]) & (at < last[:, None]))
    near = sum((w * values[np.arange(len(values)), np.maximum(sizes - i, 0)] for w, i in ((0.2, 3), (0.3, 2), (0.5, 1))), np.zeros(len(values)))
    return np.where(last - first > 1, 0.5 * near + 0.5 * _in_turn(values, first, last, top), 0.0)


def by_batch(function: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int = 4096) -> Callable[[Column], Column]:
    """A function of an array column that works on a batch of rows at once, as (values, lengths); arrays hold no nulls."""

    def run(arrays: pa.Array) -> pa.Array:
        parts = [function(*padded(pa.concat_arrays([arrays.slice(at, size)]))) for at in range(0, len(arrays), size)]
        return pa.array(np.concatenate([np.zeros(0), *parts]))

    return lambda values: F.arrow_udf(run, "double")(values)


#: `trimmed_recent` and `latest_recent` for many arrays, such as one a row of a panel; sums are added in the same order.
trimmed_of_rows = by_batch(_trimmed_rows)
latest_of_rows = by_batch(_latest_rows)


def carried_on(values: Column, weights: tuple[float, ...], steps: int) -> Column:
    """The next `steps` values, each the weighted sum of the last ones, the latest under the last weight."""
    k = len(weights)

    def grown(a, _):
        x = sum((F.lit(w) * F.element_at(a, i - k) for i, w in enumerate(weights)), F.lit(0.0))
        return F.concat(a, F.array(x))

    all_ = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), values, grown)
    return F.when(F.size(values) >= k, F.slice(all_, F.size(values) + 1, F.lit(steps)))


def capped_recent_mean(df: DataFrame, n: int = 4, least: int = 7, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, pred): the mean of the last n rows; of all rows where a series has under `least` of them."""
    tail = df.groupBy(*spec.keys).agg(F.count("*").alias("n"), F.avg(spec.target).alias("mean"))
    last = last_apply(df, n, mean_of, "last", spec)
    return tail.join(last, list(spec.keys)).select(*spec.keys, F.when(F.col("n") < least, F.col("mean")).otherwise(F.col("last")).alias("pred"))


def recursive_first_order(df: DataFrame, origin: str, pool: str, spec: PanelSpec = SERIES, steps: int = 20, most: int = 7, gap: int = 31) -> DataFrame:
    """(keys, date, model, pred): a first-order regression a pool, applied day by day from each series' last row to origin,
    then flat for `steps` days. Series more than `most` days behind, or in a pool without a slope, get exponential smoothing
    of their last 31 rows; series silent for over `gap` days get nulls. Never negative.
    """
    keys, day = list(spec.keys), F.to_date(F.lit(origin))
    past = df.where(F.col(spec.date) < day)
    pairs = past.select(pool, F.col(spec.target).alias("y"), F.lag(spec.target).over(spec.series()).alias("x")).where("x is not null")
    models = pairs.groupBy(pool).agg(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a"))
    tails = _tails(past, 31, spec).select(*keys, F.element_at("tail", -1).alias("last"), ses(F.col("tail"), 0.71).alias("ses"))
    rows = past.groupBy(*keys, pool).agg(F.datediff(day, F.max(spec.date)).alias("missing")).join(tails, keys).join(models, pool, "left")
    fold = F.aggregate(F.sequence(F.lit(1), F.least("missing", F.lit(most))), F.col("last"), lambda v, _: F.col("a") + F.col("b") * v)
    rows = rows.withColumn("model", F.when(F.col("missing") > gap, None).when((F.col("missing") <= most) & F.col("b").isNotNull(), "linear").otherwise("ses"))
    value = F.when(F.col("model") == "linear", fold).when(F.col("model") == "ses", F.col("ses"))
    return rows.select(*keys, F.explode(F.sequence(day, F.date_add(day, steps - 1))).alias(spec.date), "model", F.greatest(value, value * 0).alias("pred"))


def _pooled(df: DataFrame, pool: str, spec: PanelSpec) -> tuple[DataFrame, DataFrame]:
    """Rows with y, d and its lags l1 to l3, the pool's phi1 to phi3, the residual e and the one before it, e1; and (pool, theta).

    The input is written once and read by all three passes; models are broadcast only where a count shows them to be few, so
    that rows don't move by pool.
    """
    from panelwright.operators.forecast import pooled_ar

    s = spec.series()
    df = files.write_and_read(df.select(*spec.keys, pool, spec.date, F.col(spec.target).cast("double").alias(spec.target)), "parquet", [])
    models = files.written_small(pooled_ar(df, pool, spec).select(pool, "phi1", "phi2", "phi3"))
    d = df.withColumnRenamed(spec.target, "y").withColumn("d", F.col("y") - F.lag("y").over(s))
    d = d.withColumns({f"l{i}": F.lag("d", i).over(s) for i in (1, 2, 3)}).join(models, pool)
    d = d.withColumn("e", F.expr("d - phi1 * l1 - phi2 * l2 - phi3 * l3")).withColumn("e1", F.lag("e").over(s))
    theta = d.where("e1 is not null").groupBy(pool).agg((F.sum(F.col("e") * F.col("e1")) / F.sum(F.col("e1") * F.col("e1"))).alias("theta"))
    return d, files.written_small(theta)


def pooled_arma(df: DataFrame, pool: str, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, pool, phi1 … phi3, theta, pred): first differences of a pool share an AR(3), whose residuals share a first-order
    term; pred is the last value plus the next difference that both foretell, at least 0.

    Null where a pool's equations have no solution or a series has under five rows.
    """
    d, theta = _pooled(df, pool, spec)
    last = d.groupBy(*spec.keys, pool).agg(F.max_by(F.struct("y", "d", "l1", "l2", "e", "phi1", "phi2", "phi3"), spec.date).alias("z")).select(*spec.keys, pool, "z.*")
    pred = F.expr("y + phi1 * d + phi2 * l1 + phi3 * l2 + theta * e")
    return last.join(theta, pool, "left").select(*spec.keys, pool, "phi1", "phi2", "phi3", "theta", F.greatest(pred, pred * 0).alias("pred"))


def pooled_arma_forecast(df: DataFrame, pool: str, spec: PanelSpec = SERIES, steps: int = 7, places: tuple[int, ...] = (1, 2, 3, 7)) -> DataFrame:
    """(keys, pool, step, pred): `steps` values ahead by the models of `pooled_arma`, which stay as fitted.

    A model's outputs are its one-step forecasts of every row and the one after the last. Each step's forecast is the mean of
    the outputs at `places` from the end (1: the new one), without those that a short series lacks; 0 or less becomes a small
    number that depends on key and step. It then counts as the series' next value. Series without any output at the places
    (under six rows), or in a pool without a solution, have nulls.
    """
    d, theta = _pooled(df, pool, spec)
    deep = max(*places, 4)
    kept = F.array_sort(F.collect_list(F.struct(spec.date, "y", "e", "e1")))
    tails = last_rows(d, deep, spec).groupBy(*spec.keys, pool).agg(kept.alias("t"), *[F.first(f"phi{i}").alias(f"phi{i}") for i in (1, 2, 3)])
    tails = tails.join(theta, pool, "left").withColumns({"ys": F.transform("t", lambda r: r["y"]), "outs": F.transform("t", lambda r: r["y"] - r["e"] + F.col("theta") * r["e1"]), "e": F.element_at("t", -1)["e"]})

    def step(s, i):
        back = lambda n: F.try_element_at(s["ys"], F.lit(-n))
        foretold = back(1) + sum((F.col(f"phi{k}") * (back(k) - back(k + 1)) for k in (1, 2, 3)), F.lit(0.0))
        outs = F.concat(s["outs"], F.array(foretold + F.col("theta") * s["e"]))
        there = F.filter(F.array(*[F.try_element_at(outs, F.lit(-n)) for n in places]), lambda x: x.isNotNull())
        mean = F.when(F.size(there) > 0, mean_of(there))
        value = F.when(mean <= 0, text_jitter(*spec.keys, i)).otherwise(mean)
        return bound(F.struct(s["ys"].alias("ys"), foretold.alias("f"), outs.alias("outs"), value.alias("v")), lambda r: F.struct(F.concat(r["ys"], F.array(r["v"])).alias("ys"), (r["v"] - r["f"]).alias("e"), r["outs"].alias("outs")))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.struct("ys", "e", "outs"), step, lambda s: F.slice(s["ys"], -steps, steps))
    return tails.select(*spec.keys, pool, F.posexplode(done).alias("step", "pred")).withColumn("step", F.col("step") + 1)
