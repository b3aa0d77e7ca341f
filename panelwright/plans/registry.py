"""Named queries over the test tables, each with its SQL twin.

A query is registered by `add`: a function of the spark session and the tables' folder, and the SQL, in which {pa}, {pb}
and {ph} stand for the dense, sparse and hourly panel. Doubles of both are rounded alike by `rounded` and R().
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.sources import panels

MODULES = ("basics", "cleaning", "features", "forecasts", "complete", "models", "daily", "recipes", "pricing")
_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places; a hair above the half, so that equal values with other last bits stay equal."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = (F.floor(c * 10000 + 0.5000001) / 10000.0).alias(name)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("long").alias(name)
        out.append(c)
    return df.select(*out)


def _expand(sql: str) -> str:
    """R(x) and L(x), for a double and an integer result."""
    for tag, left, right in (("R(", "(floor((", ")*10000+0.5000001)/10000+0.0)"), ("L(", "CAST(", " AS BIGINT)")):
        while (m := re.search(rf"(?<![A-Za-z_]){re.escape(tag)}", sql)) is not None:
            depth, i = 1, m.end()
            while depth:
                depth += {"(": 1, ")": -1}.get(sql[i], 0)
                i += 1
            sql = sql[: m.start()] + left + sql[m.end() : i - 1] + right + sql[i:]
    return sql


def add(name: str, sql: str | None = None):
    def put(f: Callable) -> Callable:
        _QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if sql:
            text = _expand(sql)
            used = [(k, v) for k, v in (("pa", panels.DENSE_SQL), ("pb", panels.SPARSE_SQL), ("ph", panels.HOURLY_SQL)) if f"{{{k}}}" in text]
            for k, _ in used:
                text = text.replace(f"{{{k}}}", f"panel_{k}")
            ctes = ", ".join(f"panel_{k} AS MATERIALIZED {v}" for k, v in used)
            if ctes:
                head = next((h for h in ("WITH RECURSIVE ", "WITH ") if text.startswith(h)), "")
                text = f"{head}{ctes}, {text[len(head):]}" if head else f"WITH {ctes} {text}"
            _SQL[name] = text
        return f

    return put


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"panelwright.plans.{m}")


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(_SQL)
