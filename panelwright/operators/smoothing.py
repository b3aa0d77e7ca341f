"""Exponential smoothing with fitted rates: searched from coarse to fine inside each series' row, with no shuffle of its own.

A series is one row with its last values as an array; a set of rates is a fold over it that gives the sum of squared
one-step errors, worked out for a batch of series and all their rates at once. The first round tries a whole grid, each further round a finer grid around the best few of the round
before, so that of several valleys the deepest is kept. Null targets aren't among the values.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.cleaning import quantile_capped
from panelwright.operators.forecast import _tails, ses
from panelwright.operators.recent import bound, padded
from panelwright.operators.rolling import last_rows
from panelwright.operators.spec import SERIES, PanelSpec


def _values(df: DataFrame, last: int, spec: PanelSpec) -> DataFrame:
    """(keys, tail, last_day): each series' last values; a series without values has an empty array."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(spec.date).alias("d"), F.col(spec.target).cast("double").alias("x"))))
    tails = last_rows(df, last, spec).groupBy(*spec.keys).agg(F.transform(pairs, lambda s: s["x"]).alias("tail"), F.max(spec.date).alias("last_day"))
    return tails.withColumn("tail", F.filter("tail", lambda x: x.isNotNull()))


def _in_batches(rows: DataFrame, fitted: Callable[[np.ndarray, np.ndarray], dict], schema: str, size: int = 2048) -> DataFrame:
    """rows with what fitted(values, lengths) finds for the series of a part of a batch at once; rates are tried side by side,
    so a part holds `size` series. rows end with `tail`, which goes."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                keys = part.drop_columns(["tail"])
                out = fitted(*padded(pa.concat_arrays([part.column("tail")])))
                yield pa.RecordBatch.from_arrays([*keys.columns, *[x if isinstance(x, pa.Array) else pa.array(x[0], mask=x[1]) for x in out.values()]], [*keys.schema.names, *out])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "tail")
    return rows.mapInArrow(run, f"{kept}, {schema}")


def _least(found: dict[str, np.ndarray], barred: np.ndarray, order: tuple[str, ...], keep: int) -> dict[str, np.ndarray]:
    """Of the trials of each series (columns) the `keep` that come first by `order`, barred ones last."""
    places = np.lexsort([*[found[k] for k in reversed(order)], barred], axis=-1)[:, :keep]
    return {k: np.take_along_axis(v, places, 1) if v.ndim == 2 else np.take_along_axis(v, places[:, :, None], 1) for k, v in found.items()}


def _ses_tried(values: np.ndarray, sizes: np.ndarray, alpha: np.ndarray) -> dict[str, np.ndarray]:
    """sse, alpha and level of smoothing each series with each of its rates (columns)."""
    level, sse = np.repeat(values[:, :1], alpha.shape[1], 1), np.zeros(alpha.shape)
    for i in range(1, values.shape[1]):
        there = (sizes > i)[:, None]
        error = np.where(there, values[:, i : i + 1] - level, 0.0)
        level, sse = level + alpha * error, sse + error * error
    return {"sse": sse, "alpha": alpha, "level": level}


def _ses_best(values: np.ndarray, sizes: np.ndarray, coarse: int, keep: int, rounds: int) -> dict:
    order, step = ("sse", "alpha", "level"), 1.0 / coarse
    found = _ses_tried(values, sizes, np.tile(np.arange(1, coarse + 1) * step, (len(sizes), 1)))
    barred = np.zeros(found["sse"].shape, bool)
    for _ in range(rounds):
        step /= 10
        best = _least(found, barred, order, keep)
        rates = np.clip(best["alpha"][:, :, None] + np.arange(-10, 11) * step, step, 1.0).reshape(len(sizes), -1)
        rates = np.sort(rates, axis=1)
        again = np.concatenate([np.zeros((len(sizes), 1), bool), rates[:, 1:] == rates[:, :-1]], 1)
        tried = _ses_tried(values, sizes, rates)
        found = {k: np.concatenate([best[k], tried[k]], 1) for k in order}
        barred = np.concatenate([np.zeros(best["sse"].shape, bool), again], 1)
    best = _least(found, barred, order, 1)
    few, none = sizes < 2, sizes < 1
    return {"alpha": (best["alpha"][:, 0], few), "sse": (best["sse"][:, 0], few), "level": (best["level"][:, 0], none)}


def ses_optimised(df: DataFrame, spec: PanelSpec = SERIES, last: int = 31, origin: str | None = None, gap: int = 31, coarse: int = 40, keep: int = 3, rounds: int = 3) -> DataFrame:
    """(keys, alpha, sse, pred): simple smoothing of the last rows with the rate in (0, 1] of the least squared errors.

    The rate is exact to 1 / (coarse * 10 ** rounds). Series of one value repeat it (alpha null); with an origin, series
    silent for over `gap` days before it have no forecast. Series without values have none either.
    """
    rows = _in_batches(_values(df, last, spec).select(*spec.keys, "last_day", "tail"), lambda v, n: _ses_best(v, n, coarse, keep, rounds), "alpha double, sse double, level double")
    alive = F.lit(True) if origin is None else F.datediff(F.to_date(F.lit(origin)), "last_day") <= gap
    return rows.select(*spec.keys, "alpha", "sse", F.when(alive & F.col("level").isNotNull(), F.greatest("level", F.lit(0.0))).alias("pred"))


def ses_with_rules(df: DataFrame, spec: PanelSpec = SERIES, sellable: Column | None = None, alpha: float = 0.71, last: int = 31, steps: int = 20) -> DataFrame:
    """(keys, step, value): smoothing with a fixed rate, with the rules for short, silent and jumping series.

    Values over the 0.99 quantile count as the 0.9 quantile. Series of at most two rows repeat their mean; those whose last
    five values are 0 the mean of the last three; all others the smoothed last rows that could be sold (sellable, or with
    sales). If such a series has at most 15 rows, sold at least 1 on the day before last and five times that (whole
    times) on the last, the first step is the mean of the forecast and the last value. What is missing or under a small
    number that depends on the keys and the step becomes that number. Null targets aren't rows.
    """
    k, x = list(spec.keys), F.col(spec.target)
    rows = df.where(x.isNotNull()).select(*k, spec.date, x.cast("double").alias(spec.target), x.cast("double").alias("__x"), (F.coalesce(sellable, F.lit(False)) if sellable is not None else F.lit(True)).alias("__able"))
    rows = quantile_capped(rows, spec, 0.99, 0.9)
    place = Window.partitionBy(*k).orderBy(F.desc(spec.date))
    ranked = rows.withColumn("__rn", F.row_number().over(place))
    at = lambda c, i: F.max(F.when(F.col("__rn") == i, F.col(c)))
    y = F.col(spec.target)
    facts = ranked.groupBy(*k).agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.avg(F.when(F.col("__rn") <= 3, y)).alias("mean_3"), F.max(F.when(F.col("__rn") <= 5, F.abs(y))).alias("top_5"), at("__x", 1).alias("l1"), at("__x", 2).alias("l2"))
    tails = _tails(rows.where(F.col("__able") | (F.col("__x") > 0)), last, spec)
    both = facts.join(tails, k, "left").withColumn("smooth", F.when(F.size("tail") > 0, ses(F.col("tail"), alpha)))
    silent = (F.col("n") >= 5) & (F.col("top_5") == 0)
    value = F.when(F.col("n") <= 2, F.col("mean")).when(silent, F.col("mean_3")).otherwise(F.col("smooth"))
    jump = (F.col("n") > 2) & ~silent & (F.col("n") <= 15) & (F.col("l2") >= 1) & (F.floor(F.col("l1") / F.col("l2")) >= 5)
    first = F.when(jump, (F.col("smooth") + F.col("l1")) / 2).otherwise(value)
    out = both.select(*k, F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"), value.alias("v"), first.alias("f"))
    return out.select(*k, "step", F.greatest(F.coalesce(F.when(F.col("step") == 1, F.col("f")).otherwise(F.col("v")), F.lit(0.0)), S.jitter(*k, "step")).alias("value"))


def _hw_tried(values: np.ndarray, sizes: np.ndarray, rates: dict[str, np.ndarray], period: int) -> dict[str, np.ndarray]:
    """sse, a, b, g, level, trend and season of additive smoothing with trend and season, from the second period on, of each
    series with each of its rates (columns). The season of place i is at i % period.

    Level and season start from the first period, the trend from the first two.
    """
    mean = lambda x: sum((x[:, i : i + 1] for i in range(period)), 0.0) / period
    a, b, g = (rates[k] for k in "abg")
    first, start = values[:, :period], mean(values[:, :period])
    level, sse = np.broadcast_to(start, a.shape), np.zeros(a.shape)
    trend = np.broadcast_to((mean(values[:, period : 2 * period]) - start) / period, a.shape)
    season = np.repeat((first - start)[:, None, :], a.shape[1], 1)
    for i in range(period, values.shape[1]):
        there, x, old = (sizes > i)[:, None], values[:, i : i + 1], season[:, :, i % period]
        new = a * (x - old) + (1 - a) * (level + trend)
        error = np.where(there, x - (level + trend + old), 0.0)
        season[:, :, i % period] = np.where(there, g * (x - new) + (1 - g) * old, old)
        trend = np.where(there, b * (new - level) + (1 - b) * trend, trend)
        level, sse = np.where(there, new, level), sse + error * error
    return {"sse": sse, "a": a, "b": b, "g": g, "level": level, "trend": trend, "season": season}


def _hw_best(values: np.ndarray, sizes: np.ndarray, period: int, steps: int, keep: int, rounds: int) -> dict:
    n, order = len(sizes), ("sse", "a", "b", "g")
    if values.shape[1] < 2 * period:
        values = np.pad(values, ((0, 0), (0, 2 * period - values.shape[1])), constant_values=np.nan)
    grid = np.array(list(itertools.product((0.1, 0.35, 0.6, 0.85), (0.01, 0.1, 0.4), (0.01, 0.2, 0.6))))
    moves = np.array([m for m in itertools.product((-1, 0, 1), repeat=3) if any(m)])
    found, size = _hw_tried(values, sizes, {k: np.tile(grid[:, i], (n, 1)) for i, k in enumerate("abg")}, period), 0.25
    for _ in range(rounds):
        size /= 3
        best = _least(found, np.zeros(found["sse"].shape, bool), order, keep)
        rates = {k: np.clip(best[k][:, :, None] + moves[:, i] * size, 0.01, 0.99).reshape(n, -1) for i, k in enumerate("abg")}
        tried = _hw_tried(values, sizes, rates, period)
        found = {k: np.concatenate([best[k], tried[k]], 1) for k in found}
    best = {k: v[:, 0] for k, v in _least(found, np.zeros(found["sse"].shape, bool), order, 1).items()}
    few, h = sizes < 2 * period, np.arange(1, steps + 1)
    turned = np.take_along_axis(best["season"], (sizes[:, None] + h - 1) % period, 1)
    ahead = np.maximum(0.0, best["level"][:, None] + h * best["trend"][:, None] + turned)
    final = values[np.arange(n), np.maximum(sizes - 1, 0)]
    ahead[few] = final[few][:, None]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * steps, pa.int32()), pa.array(ahead.ravel()), mask=pa.array(sizes < 1))
    return {k: (best[k], few) for k in ("a", "b", "g", "sse")} | {"ahead": lists}


def holt_winters_fitted(df: DataFrame, spec: PanelSpec = SERIES, period: int = 4, steps: int = 20, last: int = 60, keep: int = 2, rounds: int = 3) -> DataFrame:
    """(keys, a, b, g, sse, ahead): additive trend and season with fitted rates; ahead is an array of the next `steps`
    values, negative ones 0.

    Rates are in [0.01, 0.99], found on a grid of 36 and then around the best ones at a third, a ninth, … of its width.
    Series under two periods repeat their last value (rates null); series without values have no forecast.
    """
    rows = _values(df, last, spec).select(*spec.keys, "tail")
    return _in_batches(rows, lambda v, n: _hw_best(v, n, period, steps, keep, rounds), "a double, b double, g double, sse double, ahead array<double>")


def rescaled(ahead: Column, mean: Column, *jitter_keys) -> Column:
    """Forecasts whose total is that of as many days at `mean`: the first stays, the rest of the total is dealt over the
    others in proportion (0.001 more each, so that zeros get a share). What falls under 0 becomes a small number that
    depends on the keys. Null without forecasts or mean.
    """
    n = F.size(ahead)
    rest = F.transform(F.slice(ahead, F.lit(2), n), lambda x: x + 0.001)
    total = F.aggregate(rest, F.lit(0.0), lambda s, x: s + x)
    first = F.element_at(ahead, 1)
    dealt = bound((mean * n - first) / total, lambda share: F.transform(rest, lambda x: x * share))
    return F.when(ahead.isNotNull() & mean.isNotNull(), F.transform(F.concat(F.array(first), dealt), lambda x, i: F.when(x < 0, S.jitter(*jitter_keys, i)).otherwise(x)))


def solved(matrix: Column, size: int) -> Column:
    """The solution of a system of linear equations, an array of rows of size + 1 numbers, the right side last.

    Gauss-Jordan without pivoting, for symmetric matrices with positive eigenvalues (such as ridge sums).
    """

    def eliminated(rows, k):
        def with_pivot(p):
            return F.transform(rows, lambda row, i: F.when(i == k, p).otherwise(F.zip_with(row, p, lambda x, y: x - F.try_element_at(row, k + 1) * y)))

        return bound(F.try_element_at(rows, k + 1), lambda row: bound(F.transform(row, lambda x: x / F.try_element_at(row, k + 1)), with_pivot))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, eliminated)
    return F.transform(done, lambda row: F.element_at(row, size + 1))

