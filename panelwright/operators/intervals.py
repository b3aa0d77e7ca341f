"""Joins of dated rows with intervals of days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], day: str, first: str, last: str, bin_days: int = 16) -> DataFrame:
    """points joined with all intervals of the same `on` columns that hold their day, both ends included.

    Days are cut into bins and an interval stands in each bin that it touches, so the join is on (on, bin): its work grows
    with the rows that lie near each other, not with all pairs of a key. A match is found in the point's bin alone, so
    once. Intervals that end before they begin hold no day; null days, ends and keys match nothing; repeated rows match
    again. Apart from `on`, the column names of both must differ.
    """
    number = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01")) / bin_days)
    spread = intervals.where(F.col(first) <= F.col(last)).withColumn("__bin", F.explode(F.sequence(number(F.col(first)), number(F.col(last)))))
    dated = points.withColumn("__bin", number(F.col(day)))
    return dated.join(spread, [*on, "__bin"]).where(F.col(day).between(F.col(first), F.col(last))).drop("__bin")
