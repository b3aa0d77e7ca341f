"""Window features of a series. `rows` count rows, `days` count calendar days: panels have gaps, so the two differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.spec import SERIES, PanelSpec, guarded

STATS = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp, "sum": F.sum}


def rolling(df: DataFrame, widths: list[int], stats: list[str], spec: PanelSpec = SERIES, col: str | None = None, least: int | None = None, shift: int = 0) -> DataFrame:
    """Adds <stat>_<width>[_shift_<shift>]: statistics of the last `width` rows, `shift` rows ago.

    Null where fewer than `least` (default: width) rows with a value are in the frame. All widths share one sort.
    """
    x, out = col or spec.target, {}
    for n in widths:
        w = spec.rows(-(shift + n - 1), -shift)
        for s in stats:
            value = F.percentile(x, F.lit(0.5)).over(w) if s == "median" else STATS[s](x).over(w)
            out[f"{s}_{n}" + (f"_shift_{shift}" if shift else "")] = guarded(value, F.count(x).over(w), least or n)
    return df.withColumns(out)


def lags(df: DataFrame, steps: list[int], spec: PanelSpec = SERIES, col: str | None = None) -> DataFrame:
    """Adds lag_<k>: the value k rows ago."""
    return df.withColumns({f"lag_{k}": F.lag(col or spec.target, k).over(spec.series()) for k in steps})


def day_lags(df: DataFrame, days: list[int], spec: PanelSpec = SERIES, col: str | None = None, fill: float = 0.0) -> DataFrame:
    """Adds prev_<k>: the value k calendar days ago, `fill` if there is none. No self-join: a range frame of one day."""
    x = col or spec.target
    return df.withColumns({f"prev_{k}": F.coalesce(F.sum(x).over(spec.days(-k, -k)), F.lit(fill)) for k in days})


def expanding_mean(df: DataFrame, spec: PanelSpec = SERIES, col: str | None = None, name: str = "expanding_mean") -> DataFrame:
    return df.withColumn(name, F.avg(col or spec.target).over(spec.rows(Window.unboundedPreceding, 0)))


def weights_needed(alpha: float, eps: float = 1e-12) -> int:
    """How many past values carry a weight above eps."""
    import math

    return max(1, math.ceil(math.log(eps) / math.log(1 - alpha))) if alpha < 1 else 1


def ewm_of(values: Column, alpha: float) -> Column:
    """Exponentially weighted mean of an array that ends at the current value."""
    fold = lambda a, x: F.struct((a["s"] * (1 - alpha) + x).alias("s"), (a["w"] * (1 - alpha) + 1).alias("w"))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w"))
    return F.aggregate(values, zero, fold, lambda a: a["s"] / a["w"])


def ewm(df: DataFrame, spans: list[int], spec: PanelSpec = SERIES, col: str | None = None) -> DataFrame:
    """Adds ewm_<span>: alpha = 2 / (span + 1), weights normalised over the values there are.

    Weights under 1e-12 are left out, so the work is linear in the rows.
    """
    x, out = F.col(col or spec.target).cast("double"), {}
    for n in spans:
        alpha = 2 / (n + 1)
        out[f"ewm_{n}"] = ewm_of(F.collect_list(x).over(spec.trailing(weights_needed(alpha))), alpha)
    return df.withColumns(out)


def ewm_exact(df: DataFrame, span: int, spec: PanelSpec = SERIES, col: str | None = None, name: str | None = None, block: int | None = None) -> DataFrame:
    """Adds ewm_<span> with all weights, for series of any length: alpha = 2 / (span + 1), weights normalised over the
    values there are.

    A series is cut into blocks of rows; inside a block the weighted sum is a running sum of values over powers of the
    decay, and blocks are carried on from their totals, of which a series has one a block, in one array a series: rows that
    lie by series stay there. Nulls aren't among the values: they take the mean as it stands. Dates should not repeat in a
    series.
    """
    import math

    x, keys, name = F.col(col or spec.target).cast("double"), list(spec.keys), name or f"ewm_{span}"
    r = 1 - 2 / (span + 1)
    if r <= 0:
        return df.withColumn(name, F.last(x, ignorenulls=True).over(spec.rows(Window.unboundedPreceding, 0)))
    block = block or max(2, min(1024, int(300 / -math.log(r))))  # no power of the decay in a block leaves what doubles hold
    k = F.count(x).over(spec.rows(Window.unboundedPreceding, 0)) - 1
    rows = df.withColumn("__k", k).withColumns({"__block": F.floor(F.greatest("__k", F.lit(0)) / block), "__at": F.greatest("__k", F.lit(0)) % block})
    local = F.sum(x * F.pow(F.lit(1 / r), F.col("__at"))).over(spec.rows(Window.unboundedPreceding, 0, "__block")) * F.pow(F.lit(r), F.col("__at"))
    rows = rows.withColumn("__local", F.coalesce(local, F.lit(0.0)))
    totals = rows.groupBy(*keys, "__block").agg(F.max_by("__local", "__at").alias("t"))
    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<double>").alias("all"))
    fold = lambda a, e: F.struct((a["carry"] * (r**block) + e["t"]).alias("carry"), F.concat(a["all"], F.array(a["carry"])).alias("all"))
    carries = totals.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__block", "t"))).alias("e"))
    carries = carries.select(*keys, F.aggregate("e", start, fold, lambda a: a["all"]).alias("__carries"))
    rows = rows.join(carries, keys).withColumn("__carry", F.get("__carries", F.col("__block").cast("int"))).drop("__carries")
    weights = (1 - F.pow(F.lit(r), F.col("__k") + 1)) / (1 - r)
    value = (F.col("__local") + F.pow(F.lit(r), F.col("__at") + 1) * F.col("__carry")) / weights
    return rows.withColumn(name, F.when(F.col("__k") >= 0, value)).select(*df.columns, name)


def centered_mean(df: DataFrame, width: int, spec: PanelSpec = SERIES, col: str | None = None, name: str | None = None) -> DataFrame:
    """Mean of `width` rows around the current one, the longer half before it; null unless all are there."""
    x = col or spec.target
    w = spec.rows(-(width // 2), width - width // 2 - 1)
    return df.withColumn(name or f"centered_{width}", guarded(F.avg(x).over(w), F.count(x).over(w), width))


def filled(df: DataFrame, cols: list[str], spec: PanelSpec = SERIES, order: tuple[str, ...] = ("backward", "forward"), constant=None, keys: tuple[str, ...] | None = None) -> DataFrame:
    """Nulls take the next value, then the last one, then a constant, inside a series (or the given keys)."""
    w = Window.partitionBy(*(keys if keys is not None else spec.keys)).orderBy(spec.date, *([k for k in spec.keys if k not in keys] if keys is not None else []))
    back = w.rowsBetween(0, Window.unboundedFollowing)
    ahead = w.rowsBetween(Window.unboundedPreceding, 0)
    out = {}
    for x in cols:
        steps = [F.first(x, ignorenulls=True).over(back) if o == "backward" else F.last(x, ignorenulls=True).over(ahead) for o in order]
        out[x] = F.coalesce(F.col(x), *steps, *([F.lit(constant)] if constant is not None else []))
    return df.withColumns(out)


def streaks(df: DataFrame, spec: PanelSpec = SERIES, col: str | None = None, name: str = "streak") -> DataFrame:
    """How many rows the value has been the same, counted from 0."""
    x, s = F.col(col or spec.target), spec.series()
    changed = F.coalesce((x != F.lag(x).over(s)).cast("int"), F.lit(1))
    df = df.withColumn("__run", F.sum(changed).over(spec.rows(Window.unboundedPreceding, 0)))
    return df.withColumn(name, F.row_number().over(spec.series("__run")) - 1).drop("__run")


def near_equal_chunks(df: DataFrame, interval: int, spec: PanelSpec = SERIES, name: str = "chunk") -> DataFrame:
    """Chunk numbers from 0: ceil(rows / interval) chunks, of which the first ones are one longer where it doesn't go even."""
    n, i = F.count("*").over(spec.whole()), F.row_number().over(spec.series()) - 1
    df = df.withColumns({"__n": n, "__i": i}).withColumn("__k", F.ceil(F.col("__n") / interval))
    size, longer = F.expr("__n div __k"), F.col("__n") % F.col("__k")
    head = longer * (size + 1)
    chunk = F.when(F.col("__i") < head, F.floor(F.col("__i") / (size + 1))).otherwise(longer + F.floor((F.col("__i") - head) / size))
    return df.withColumn(name, chunk.cast("long")).drop("__n", "__i", "__k")


def last_rows(df: DataFrame, n: int, spec: PanelSpec = SERIES) -> DataFrame:
    """The last n rows of each series."""
    w = Window.partitionBy(*spec.keys).orderBy(F.desc(spec.date))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def history_mean(df: DataFrame, widths: tuple[int, ...] = (7, 15, 30), weights: tuple[float, ...] = (1 / 3, 1 / 3, 1 / 3), spec: PanelSpec = SERIES, col: str | None = None, name: str = "history_mean") -> DataFrame:
    """Each row gets the weighted mean of trailing means as they stood one row before; the first row takes its own."""
    x = col or spec.target
    h = sum((w * F.avg(x).over(spec.trailing(n)) for n, w in zip(widths, weights, strict=True)), F.lit(0.0))
    df = df.withColumn("__h", h)
    return df.withColumn(name, F.coalesce(F.lag("__h").over(spec.series()), F.col("__h"))).drop("__h")


def extrapolated(df: DataFrame, steps: int, widths: tuple[int, ...] = (7, 15, 30), weights: tuple[float, ...] = (1 / 3, 1 / 3, 1 / 3), spec: PanelSpec = SERIES, col: str | None = None) -> DataFrame:
    """(keys, step, value): the history mean carried on: each step's value joins the list that the next is taken from.

    Only the last max(widths) values of a series are kept.
    """
    x, keep = F.col(col or spec.target).cast("double"), max(widths)
    pairs = F.array_sort(F.collect_list(F.struct(F.col(spec.date).alias("d"), x.alias("x"))))
    tail = last_rows(df, keep, spec).groupBy(*spec.keys).agg(F.transform(pairs, lambda s: s["x"]).alias("tail"))

    def value(a):
        total = F.lit(0.0)
        for n, w in zip(widths, weights, strict=True):
            part = F.slice(a, F.greatest(F.size(a) - n + 1, F.lit(1)), F.lit(n))
            total = total + w * F.aggregate(part, F.lit(0.0), lambda s, v: s + v) / F.size(part)
        return total

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("tail"), lambda a, _: F.concat(a, F.array(value(a))))
    out = tail.select(*spec.keys, F.slice(grown, F.size("tail") + 1, F.lit(steps)).alias("ahead"))
    return out.select(*spec.keys, F.posexplode("ahead").alias("step", "value")).withColumn("step", F.col("step") + 1)
