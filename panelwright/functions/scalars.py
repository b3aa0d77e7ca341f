"""Column functions of the panel operators: labels, repairs and dates, all inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NONE_NAME, CLEAR_WEATHER = "无", "晴"


def c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def absolute_percentage_error(actual, pred) -> Column:
    """Error in relation to the actual value; without sales a forecast of 1 or more counts by itself."""
    a, p = c(actual), c(pred)
    return F.when((a == 0) & (p >= 1), p).when((a == 0) & (p < 1), 0.0).otherwise(F.abs(p - a) / a)


def clamp_to_mean(pred, mean, factor: float = 3.0) -> Column:
    return F.greatest(F.least(c(pred), c(mean) * factor), c(mean) / factor)


def range_or_null(x, most: float = 100.0) -> Column:
    return F.when(F.abs(c(x)) <= most, c(x))


def empty_to_null(x) -> Column:
    return F.when(c(x) != "", c(x))


def finite_or_null(x) -> Column:
    x = c(x).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def any_promotion(*counters) -> Column:
    return reduce(lambda a, b: a | b, [c(x) != 0 for x in counters])


def rebate(price, promo_price) -> Column:
    """Share of the price that is taken off."""
    return (c(price) - c(promo_price)) / c(price)


def key_text(*keys) -> Column:
    return F.concat_ws("_", *[c(k).cast("string") for k in keys])


def in_lists(**lists) -> Column:
    """All columns' values are in their lists; a column without a list is free."""
    return reduce(lambda a, b: a & b, [c(k).isin(v if isinstance(v, list | tuple) else [v]) for k, v in lists.items() if v is not None], F.lit(True))


def recode(x, codes: dict[str, int]) -> Column:
    table = F.create_map(*[F.lit(v) for kv in codes.items() for v in kv])
    return F.element_at(table, c(x)) if codes else F.lit(None)


def jitter(*keys, low: float = 0.001, high: float = 0.01) -> Column:
    """A small number that depends on the keys alone, for forecasts that must not be zero."""
    return F.lit(low) + (high - low) * (F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) / 1_000_000)


def text_jitter(*keys, low: float = 0.001, high: float = 0.01) -> Column:
    """As jitter, from the MD5 of the keys' text, which other engines can work out too."""
    digits = F.conv(F.substring(F.md5(F.concat_ws(":", *[c(k).cast("string") for k in keys]).cast("binary")), 1, 7), 16, 10)
    return F.lit(low) + (high - low) * (digits.cast("double") / float(16**7))


def year_week(dt) -> Column:
    return F.year(dt) * 100 + F.weekofyear(dt)


def day_number(dt, since: str = "2021-01-01") -> Column:
    return F.datediff(c(dt), F.lit(since))


def week_of_month(dt) -> Column:
    return F.ceil(F.dayofmonth(dt) / 7)


def week_of_year_by_days(dt) -> Column:
    return F.ceil(F.dayofyear(dt) / 7)


def last_name_dropped(names) -> Column:
    """Of names joined by commas all but the last; a single name stays."""
    return F.regexp_replace(c(names), ",[^,]*$", "")


def date_label(dt, label, own: dict[tuple[int, int], str]) -> Column:
    """Labels of certain (month, day) pairs in place of the given label."""
    out = c(label)
    for (m, d), name in own.items():
        out = F.when((F.month(dt) == m) & (F.dayofmonth(dt) == d), name).otherwise(out)
    return out


def to_json_series(dt, value, fmt: str = "yyyyMMdd"):
    """An aggregate: dates and values as one JSON object, in date order."""
    pairs = F.array_sort(F.collect_list(F.struct(F.date_format(dt, fmt).alias("k"), c(value).alias("v"))))
    return F.to_json(F.map_from_entries(pairs))
