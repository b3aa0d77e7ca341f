"""Forecasts from many origins at once, and their scores.

A row is dealt to each origin that has it in its history, and the origin joins the keys of the series. So any forecast
operator that takes a `PanelSpec` makes the forecasts of all origins in the one plan that it makes for one, and can't see
a row of the origin's day or later. The copies of a row are as many as histories overlap, never as there are origins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.forecast import scores
from panelwright.operators.spec import SERIES, PanelSpec

Model = Callable[[DataFrame, PanelSpec], DataFrame]
MEASURES = ["rmse", "nrmse", "nd", "smape", "accuracy"]


def _days(origins: list[str]):
    return F.array(*[F.to_date(F.lit(o)) for o in sorted(set(origins))])


def followed(df: DataFrame, origins: list[str], horizon: int, spec: PanelSpec = SERIES) -> DataFrame:
    """Adds __met: the origins in whose `horizon` days the row's series has a row. One window, by the series alone."""
    day = F.to_date(spec.date)
    met = [F.max(F.when((day >= o) & (day < F.date_add(o, horizon)), o)).over(spec.whole()) for o in (F.to_date(F.lit(x)) for x in sorted(set(origins)))]
    return df.withColumn("__met", F.array_compact(F.array(*met)))


def histories(df: DataFrame, origins: list[str], days: int, spec: PanelSpec = SERIES) -> tuple[DataFrame, PanelSpec]:
    """(rows, spec): the rows of the `days` days before each origin, with the origin as a column and a key.

    Rows in no history, and rows without a date, are left out; rows of repeated dates stay repeated. Of rows that `followed`
    has marked, only histories that an outcome follows are made.
    """
    day, marked = F.to_date(spec.date), "__met" in df.columns
    wanted = F.filter(F.col("__met") if marked else _days(origins), lambda o: (day < o) & (day >= F.date_sub(o, days)))
    return df.withColumn("origin", F.explode(wanted)).drop("__met"), replace(spec, keys=(*spec.keys, "origin"))


def outcomes(df: DataFrame, origins: list[str], horizon: int, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, origin, date, actual): the rows of the `horizon` days from each origin on."""
    day = F.to_date(spec.date)
    wanted = F.filter(_days(origins), lambda o: (day >= o) & (day < F.date_add(o, horizon)))
    return df.select(*spec.keys, F.explode(wanted).alias("origin"), spec.date, F.col(spec.target).cast("double").alias("actual"))


def backtest(df: DataFrame, origins: list[str], models: dict[str, Model], horizon: int, days: int, spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, origin, date, model, actual, pred): each model's forecasts beside what came.

    A model gets the histories and their spec and returns (keys, origin, pred), or (keys, origin, step, value) with steps
    from 1, a day each. Days without a row have no actual and no line; series that a model has no forecast for have a null.
    The history is dealt once by series for all models, and forecasts of one kind meet the outcomes in one join. With df
    from `followed`, models only see histories that are scored; that is for models that take each series by itself.
    """
    if not models:
        raise ValueError("no models")
    came = outcomes(df, origins, horizon, spec)
    past, own = histories(df.repartition(*spec.keys), origins, days, spec)
    keys, kinds = list(own.keys), {}
    for name, model in models.items():
        ahead = model(past, own)
        if "step" in ahead.columns:
            ahead = ahead.select(*keys, F.date_add("origin", (F.col("step") - 1).cast("int")).alias(spec.date), F.col("value").alias("pred"))
            on = (*keys, spec.date)
        else:
            on = tuple(keys)
        kinds.setdefault(on, {})[name] = ahead.select(*on, F.col("pred").cast("double").alias("pred"))
    out = None
    for on, found in kinds.items():
        each = reduce(DataFrame.unionByName, [f.withColumn("model", F.lit(name)) for name, f in found.items()])
        wide = each.groupBy(*on).agg(*[F.max(F.when(F.col("model") == name, F.col("pred"))).alias(f"__{i}") for i, name in enumerate(found)])
        ahead = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), F.col(f"__{i}").alias("pred")) for i, name in enumerate(found)]))
        one = came.join(wide, list(on), "left").select(*keys, spec.date, "actual", ahead.alias("m")).select(*keys, spec.date, "m.model", "actual", "m.pred")
        out = one if out is None else out.unionByName(one)
    return out


def scored(tested: DataFrame, by: tuple[str, ...] = ("model",)) -> DataFrame:
    """(by, n_origins, measures): each measure's mean over the origins, all origins counting alike. Nulls aren't scored."""
    each = scores(tested.dropna(subset=["pred"]), [*by, "origin"], "actual", "pred")
    return each.groupBy(*by).agg(F.count("*").alias("n_origins"), *[F.avg(m).alias(m) for m in MEASURES])


def best_model(tested: DataFrame, spec: PanelSpec = SERIES, measure: str = "rmse") -> DataFrame:
    """(keys, model, measure): of each series the model with the least mean measure over the origins; ties by name.

    Measures that agree to nine places are equal: the order of a sum decides the places after.
    """
    each = scored(tested, (*spec.keys, "model"))
    best = F.min_by(F.struct("model", measure), F.struct(F.round(measure, 9), "model"))
    return each.where(F.col(measure).isNotNull()).groupBy(*spec.keys).agg(best.alias("b")).select(*spec.keys, "b.*")
