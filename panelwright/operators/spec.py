"""What a panel's columns are called, and the windows over its series."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PanelSpec:
    """Key columns, date column and target of a panel: one row per key and date, gaps allowed."""

    keys: tuple[str, ...] = ("bu_id", "wh_id", "sku_id")
    date: str = "dt"
    target: str = "arranged_cnt"

    def series(self, *more: str) -> WindowSpec:
        """All rows of a series in date order."""
        return Window.partitionBy(*self.keys, *more).orderBy(self.date)

    def rows(self, first: int, last: int, *more: str) -> WindowSpec:
        return self.series(*more).rowsBetween(first, last)

    def trailing(self, n: int, *more: str) -> WindowSpec:
        """The last n rows, the current one included."""
        return self.rows(-(n - 1), 0, *more)

    def whole(self, *more: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *more)

    def days(self, first: int, last: int, *more: str) -> WindowSpec:
        """Rows by calendar distance in days."""
        return Window.partitionBy(*self.keys, *more).orderBy(F.datediff(self.date, F.lit("1970-01-01"))).rangeBetween(first, last)


SERIES = PanelSpec()


def guarded(value: Column, n: Column, least: int) -> Column:
    """value where at least `least` rows were seen."""
    return F.when(n >= least, value)
