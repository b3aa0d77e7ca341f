"""Rows of an intraday model: what a day sold up to an hour, what it went on to sell, and how the days before went.

Nulls among counts are no sales; a null amount leaves the price null, and rows without a price growth are dropped. Repeated
(series, hour) rows are summed. An empty frame gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.spec import SERIES, PanelSpec

HOURS = range(23)


def expanded(series: DataFrame, hours: Iterable[int], models: list[str]) -> DataFrame:
    """Each row of series once for each cut-off hour and model name."""
    rows = series.withColumn("cut_hour", F.explode(F.array(*[F.lit(h) for h in hours])))
    return rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def active_series(df: DataFrame, origin: str, low: float, high: float, spec: PanelSpec = SERIES, days: int = 8) -> DataFrame:
    """(keys, med): series whose median daily total over the `days` days before origin lies within [low, high]."""
    day = F.to_date(F.lit(origin))
    recent = df.where(F.col(spec.date).between(F.date_sub(day, days), F.date_sub(day, 1)))
    total = recent.groupBy(*spec.keys, spec.date).agg(F.sum(spec.target).alias("t"))
    return total.groupBy(*spec.keys).agg(F.percentile("t", F.lit(0.5)).alias("med")).where(F.col("med").between(low, high))


def intraday_rows(hourly: DataFrame, keys: list[str], cuts: Iterable[int] = range(12, 23), count: str = "cnt", amount: str = "amt", date: str = "dt", hour: str = "hour", back: int = 7) -> DataFrame:
    """(keys, date, cut_hour, current_sum, y, h00 … h22, y_lag1 …, y_mean, y_std, y_median, y_min, y_max, price_growth, month,
    dow, dom): a row a day and cut-off hour, of days that sold something before and after it.

    Statistics are of the `back` rows before, the price's growth is over their mean price; rows without them are dropped.
    Hours become columns in one aggregate and cut-offs rows after it.
    """
    day = hourly.where(F.col(hour) <= HOURS[-1]).groupBy(*keys, date).agg(
        *[F.coalesce(F.sum(F.when(F.col(hour) == h, F.col(count))), F.lit(0.0)).alias(f"h{h:02d}") for h in HOURS],
        (F.sum(amount) / F.sum(count)).alias("__p"),
    )
    rows = day.withColumn("cut_hour", F.explode(F.array(*[F.lit(h) for h in cuts])))
    part = lambda keep: sum((F.when(keep(F.lit(h)), F.col(f"h{h:02d}")).otherwise(0.0) for h in HOURS), F.lit(0.0))
    rows = rows.withColumns({"current_sum": part(lambda h: h < F.col("cut_hour")), "y": part(lambda h: h >= F.col("cut_hour"))}).where("current_sum > 0 and y > 0")
    w = Window.partitionBy(*keys, "cut_hour").orderBy(date)
    before = w.rowsBetween(-back, -1)
    rows = rows.withColumns(
        {f"y_lag{i}": F.lag("y", i).over(w) for i in range(1, back + 1)}
        | {"y_mean": F.avg("y").over(before), "y_std": F.stddev_samp("y").over(before), "y_median": F.percentile("y", F.lit(0.5)).over(before), "y_min": F.min("y").over(before), "y_max": F.max("y").over(before)}
        | {"price_growth": F.col("__p") / F.avg("__p").over(before) - 1}
    )
    rows = rows.where(F.col(f"y_lag{back}").isNotNull() & F.col("price_growth").isNotNull()).drop("__p")
    return rows.withColumns({"month": F.month(date), "dow": F.weekday(date), "dom": F.dayofmonth(date)})
