"""Daily runs: dates relative to the day a run forecasts from, and state that lets a new day read one day's rows.

A run's state has a row a series: the last values, running moments and the sums of exponential means. A new day joins its
rows with the state before it; history is never read again. `StateTable` keeps a version a day in the shared folder, so a
day can be run again, and a run that was lost goes on from the last version that was written whole.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.operators.spec import SERIES, PanelSpec
from panelwright.sources import files

#: Values of a series that the state keeps.
KEEP = 31


@dataclass(frozen=True)
class RunDates:
    """The closed intervals of days that a run learns from and forecasts."""

    train_start: datetime.date
    train_end: datetime.date
    forecast: datetime.date
    test_end: datetime.date


def run_dates(forecast_date: str | datetime.date | None = None, fc_date_delta: int = 0, train_duration: int = -730, test_duration: int = 19) -> RunDates:
    """A run's dates from the day it runs on (default: today; text as 20010601 or 2001-06-01) and durations in days.

    It forecasts from fc_date_delta days later, learns from train_duration days (negative) before that to the day before,
    and tests up to test_duration days after.
    """
    if train_duration >= 0 or test_duration < 0:
        raise ValueError("train_duration has to be negative, test_duration 0 or more")
    day = forecast_date or datetime.date.today()
    if isinstance(day, str):
        day = datetime.datetime.strptime(day.replace("-", ""), "%Y%m%d").date()
    first = day + datetime.timedelta(fc_date_delta)
    return RunDates(first + datetime.timedelta(train_duration), first - datetime.timedelta(1), first, first + datetime.timedelta(test_duration))


def run_slice(df: DataFrame, dates: RunDates, col: str = "dt", excluded: list[tuple[str, str]] = (), marked: str | None = "is_train") -> DataFrame:
    """Rows of a run's days less excluded closed intervals, marked 1 up to the day before the forecast and 0 from it on.

    All bounds are literals next to the scan, so partitions and row groups are pruned. Null dates are in no run.
    """
    to = lambda x: F.lit(str(x)).cast("date").cast(df.schema[col].dataType)
    out = df.where(F.col(col).between(to(dates.train_start), to(dates.test_end)))
    for first, last in excluded:
        out = out.where(~F.col(col).between(to(first), to(last)))
    return out.withColumn(marked, (F.col(col) < to(dates.forecast)).cast("int")) if marked else out


def _state_fields(alphas: tuple[float, ...]) -> str:
    ewm = "".join(f", s_{k} double, w_{k} double" for k in range(len(alphas)))
    return f"last_dt date, n_rows bigint, recent array<double>, n bigint, mean double, m2 double{ewm}"


def _schema(df: DataFrame, spec: PanelSpec, alphas: tuple[float, ...]) -> T.StructType:
    keys = T.StructType([df.schema[k] for k in spec.keys])
    return T.StructType(keys.fields + T.StructType.fromDDL(_state_fields(alphas)).fields)


def empty_state(df: DataFrame, spec: PanelSpec = SERIES, alphas: tuple[float, ...] = ()) -> DataFrame:
    """The state before the first day, with the keys' types of df."""
    return df.sparkSession.createDataFrame([], _schema(df, spec, alphas))


def state_of(history: DataFrame, spec: PanelSpec = SERIES, keep: int = KEEP, alphas: tuple[float, ...] = ()) -> DataFrame:
    """The state after all rows of history, in one pass: what `advanced` gives day by day.

    Last values are picked by rank inside a series, moments are plain aggregates and the sums of an exponential mean are
    sums of powers of its decay, so no series is ever held as a list.
    """
    x = F.col(spec.target).cast("double")
    back = spec.whole().orderBy(F.desc(spec.date))
    rows = history.select(*spec.keys, spec.date, x.alias("__x"), F.row_number().over(back).alias("__rn"), (F.count(x).over(back) - F.when(x.isNotNull(), 1).otherwise(0)).alias("__later"))
    aggs = [
        F.max(spec.date).cast("date").alias("last_dt"),
        F.count("*").alias("n_rows"),
        F.array_sort(F.collect_list(F.when(F.col("__rn") <= keep, F.struct((-F.col("__rn")).alias("at"), F.col("__x").alias("x"))))).alias("__recent"),
        F.count("__x").alias("n"),
        F.coalesce(F.avg("__x"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop("__x") * F.count("__x"), F.lit(0.0)).alias("m2"),
    ]
    for k, a in enumerate(alphas):
        weight = F.pow(F.lit(1 - a), F.col("__later"))
        aggs += [F.coalesce(F.sum(F.col("__x") * weight), F.lit(0.0)).alias(f"s_{k}"), F.coalesce(F.sum(F.when(F.col("__x").isNotNull(), weight)), F.lit(0.0)).alias(f"w_{k}")]
    out = rows.groupBy(*spec.keys).agg(*aggs).withColumn("recent", F.transform("__recent", lambda r: r["x"]))
    return out.select([f.name for f in _schema(history, spec, alphas)])


def advanced(state: DataFrame, day: DataFrame, spec: PanelSpec = SERIES, keep: int = KEEP, alphas: tuple[float, ...] = ()) -> DataFrame:
    """The state after one more day's rows, at most one a series; series without a row keep theirs, new ones begin.

    A row on or before its series' last day is late: it raises an error when the state is read, for a state can't take it
    back; run again from the version before it. Null values count as rows, but in no mean.
    """
    sold = day.select(*[F.col(k) for k in spec.keys], F.col(spec.date).cast("date").alias("__dt"), F.col(spec.target).cast("double").alias("__x"))
    both = state.join(sold, list(spec.keys), "full_outer")
    new, has = F.col("__dt").isNotNull(), F.col("__x").isNotNull()
    old = lambda c, zero: F.coalesce(F.col(c), zero)
    late = F.raise_error(F.concat(F.lit("a row of "), F.col("__dt").cast("string"), F.lit(" is not after its series' last day "), F.col("last_dt").cast("string")))
    n = old("n", F.lit(0)) + has.cast("long")
    mean0 = old("mean", F.lit(0.0))
    mean = F.when(has, mean0 + (F.col("__x") - mean0) / n).otherwise(mean0)
    recent = old("recent", F.array().cast("array<double>"))
    grown = F.concat(recent, F.array("__x"))
    out = {
        "last_dt": F.when(new & (F.col("last_dt") >= F.col("__dt")), late.cast("date")).when(new, F.col("__dt")).otherwise(F.col("last_dt")),
        "n_rows": old("n_rows", F.lit(0)) + new.cast("long"),
        "recent": F.when(new, F.slice(grown, F.greatest(F.size(grown) - keep + 1, F.lit(1)), F.lit(keep))).otherwise(recent),
        "n": n,
        "mean": mean,
        "m2": old("m2", F.lit(0.0)) + F.when(has, (F.col("__x") - mean0) * (F.col("__x") - mean)).otherwise(0.0),
    }
    for k, a in enumerate(alphas):
        out[f"s_{k}"] = F.when(has, old(f"s_{k}", F.lit(0.0)) * (1 - a) + F.col("__x")).otherwise(old(f"s_{k}", F.lit(0.0)))
        out[f"w_{k}"] = F.when(has, old(f"w_{k}", F.lit(0.0)) * (1 - a) + 1).otherwise(old(f"w_{k}", F.lit(0.0)))
    return both.select(*spec.keys, *[c.alias(name) for name, c in out.items()])


def _mean_of(values: Column) -> Column:
    """Mean of the values of an array that are there; null without any."""
    there = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(there) > 0, F.aggregate(there, F.lit(0.0), lambda s, v: s + v) / F.size(there))


def features(state: DataFrame, steps: list[int] = (), widths: list[int] = (), alphas: tuple[float, ...] = (), spec: PanelSpec = SERIES) -> DataFrame:
    """(keys, last_dt, lag_<k>, mean_<w>, expanding_mean, expanding_std, ewm_<j>) of each series as its last row sees them.

    lag_<k> is the value k rows before the last one, mean_<w> that of the last w rows (fewer where there are no more), and
    ewm_<j> the exponential mean of the j-th rate. None may reach further back than the state keeps.
    """
    tail = lambda w: F.slice("recent", F.greatest(F.size("recent") - w + 1, F.lit(1)), F.lit(w))
    out = {f"lag_{k}": F.get(F.col("recent"), F.size("recent") - 1 - k) for k in steps}
    out |= {f"mean_{w}": _mean_of(tail(w)) for w in widths}
    out["expanding_mean"] = F.when(F.col("n") > 0, F.col("mean"))
    out["expanding_std"] = F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    out |= {f"ewm_{j}": F.when(F.col(f"w_{j}") > 0, F.col(f"s_{j}") / F.col(f"w_{j}")) for j in range(len(alphas))}
    return state.select(*spec.keys, "last_dt", *[c.alias(name) for name, c in out.items()])


class StateTable:
    """Versions of a state, one a day, as partitions `day=` of a table in a folder that driver and executors share.

    A day starts from the newest version before it, so running it again gives the same rows in its own place; the days after
    it have to be run again then, too.
    """

    def __init__(self, spark, path: str | None = None):
        self.spark, self.path = spark, (path or files.new_path(spark)).rstrip("/")

    def read(self, before: str) -> DataFrame | None:
        """The newest version of a day before the given one; None without any. Of older versions only names are looked at."""
        try:
            days = self.spark.read.parquet(self.path).select(F.col("day").cast("string"))
            newest = days.where(F.col("day") < before).agg(F.max("day")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return self.spark.read.parquet(f"{self.path}/day={newest}") if newest else None

    def write(self, state: DataFrame, day: str) -> DataFrame:
        """Writes the state after `day` and gives it back as read from there."""
        state.write.mode("overwrite").parquet(f"{self.path}/day={day}")
        return self.spark.read.parquet(f"{self.path}/day={day}")

    def run_day(self, rows: DataFrame, day: str, spec: PanelSpec = SERIES, keep: int = KEEP, alphas: tuple[float, ...] = ()) -> DataFrame:
        """Takes one day's rows of a table into the state; the filter is a literal, so only that day's partition is read.

        The state moves once (a row a series), and nothing of it is collected.
        """
        of_day = rows.where(F.col(spec.date) == F.lit(day).cast(rows.schema[spec.date].dataType))
        before = self.read(day)
        return self.write(advanced(before if before is not None else empty_state(rows, spec, alphas), of_day, spec, keep, alphas), day)
