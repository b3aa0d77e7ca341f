"""Features of a panel: seasonal and festival indices, bands, promotions, prices, elasticities, encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.intervals import interval_join
from panelwright.operators.rolling import last_rows
from panelwright.operators.spec import SERIES, PanelSpec
from panelwright.sources import files


def seasonal_index(df: DataFrame, dims: list[str], cols: list[str], spec: PanelSpec = SERIES, train: Column | None = None, table: DataFrame | None = None) -> DataFrame:
    """Adds idx_<dim>_<col>: mean of the target by (dim, col) over its mean by dim, both over training rows.

    One aggregate by all dims and cols, written out once, feeds every index; the indices, a few rows each, are written and
    joined back, so that Spark broadcasts them and no row moves by a dimension. Dims must include the group that a
    statistic is confined to. Null dims or cols get no index. table: a written frame with the same values, to take means of.
    """
    x = F.when(train, F.col(spec.target)) if train is not None else F.col(spec.target)
    base = files.write_and_read((df if table is None else table).groupBy(*dims, *cols).agg(F.sum(x).alias("__s"), F.count(x).alias("__n")), "parquet", [])
    out = df
    for d in dims:
        whole = base.groupBy(d).agg((F.sum("__s") / F.sum("__n")).alias("__w"))
        for c in cols:
            part = base.groupBy(d, c).agg((F.sum("__s") / F.sum("__n")).alias("__m")).join(whole, d)
            out = out.join(files.written_small(part.select(d, c, (F.col("__m") / F.col("__w")).alias(f"idx_{d}_{c}"))), [d, c], "left")
    return out.select(*df.columns, *[f"idx_{d}_{c}" for d in dims for c in cols])


def daily_total_index(df: DataFrame, dim: list[str], col: str, spec: PanelSpec = SERIES) -> DataFrame:
    """(dim, col, idx): mean daily total by (dim, col) over the mean daily total by dim."""
    day = df.groupBy(*dim, spec.date, col).agg(F.sum(spec.target).alias("t"))
    part = day.groupBy(*dim, col).agg(F.avg("t").alias("a"))
    whole = df.groupBy(*dim, spec.date).agg(F.sum(spec.target).alias("t")).groupBy(*dim).agg(F.avg("t").alias("b"))
    return part.join(whole, dim).select(*dim, col, (F.col("a") / F.col("b")).alias("idx"))


def festival_index(df: DataFrame, dim: list[str], spec: PanelSpec = SERIES, festival: str = "festival_name", none: str = "无", flank: int = 15, average_years: bool = False) -> DataFrame:
    """(dim, festival, idx): mean daily total on a festival over the yearly means of the plain days around it.

    The yearly means are summed, or averaged. Festival runs are one row a year and name, so the band join is small.
    """
    day = df.groupBy(*dim, spec.date, festival).agg(F.sum(spec.target).alias("t"))
    named = day.where(F.col(festival) != none)
    runs = named.groupBy(*dim, F.col(festival).alias("f"), F.year(spec.date).alias("y")).agg(F.min(spec.date).alias("a"), F.max(spec.date).alias("b"))
    plain = day.where(F.col(festival) == none).select(*dim, F.col(spec.date).alias("d"), "t")
    runs = runs.withColumns({"a": F.date_sub("a", flank), "b": F.date_add("b", flank)})
    near = interval_join(plain, runs, dim, "d", "a", "b")
    yearly = near.groupBy(*dim, "f", "y").agg(F.avg("t").alias("m"))
    base = yearly.groupBy(*dim, "f").agg((F.avg("m") if average_years else F.sum("m")).alias("base"))
    top = named.groupBy(*dim, F.col(festival).alias("f")).agg(F.avg("t").alias("top"))
    return top.join(base, [*dim, "f"]).select(*dim, F.col("f").alias(festival), (F.col("top") / F.col("base")).alias("idx"))


def weekday_ratio(df: DataFrame, dim: str = "cat2", spec: PanelSpec = SERIES, days: int = 45) -> DataFrame:
    """(dim, weekday, ratio) over the last `days` distinct dates; a pair without rows gets 1/7."""
    dates = df.select(spec.date).distinct().orderBy(F.desc(spec.date)).limit(days)
    recent = df.join(F.broadcast(dates), spec.date, "left_semi")  # `days` rows
    mean = recent.groupBy(dim, F.weekday(spec.date).alias("weekday")).agg((F.avg(spec.target) + 0.01).alias("m"))
    grid = df.select(dim).distinct().select(dim, F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday"))
    share = mean.withColumn("ratio", F.col("m") / F.sum("m").over(Window.partitionBy(dim))).drop("m")
    return grid.join(share, [dim, "weekday"], "left").withColumn("ratio", F.coalesce("ratio", F.lit(1 / 7)))


def buyer_indices(df: DataFrame, buyers: list[str], by: str, group: list[str]) -> DataFrame:
    """(group, by, buyer, idx): each buyer count's mean by (group, by) over its mean by group, by one unpivot."""
    long = df.select(*group, by, F.explode(F.create_map(*[y for b in buyers for y in (F.lit(b), F.col(b).cast("double"))])).alias("buyer", "v"))
    part = long.groupBy(*group, by, "buyer").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    w = Window.partitionBy(*group, "buyer")
    return part.select(*group, by, "buyer", (F.col("s") / F.col("n") / (F.sum("s").over(w) / F.sum("n").over(w))).alias("idx"))


def _band(mean: Column, lo: Column, hi: Column) -> Column:
    i = F.least(F.greatest(F.ceil((mean - lo) / ((hi - lo) / 4)), F.lit(1)), F.lit(4))
    return F.when(hi == lo, 2).otherwise(4 - i).cast("int")


def _day_means(df: DataFrame, within: list[str], sku: str, spec: PanelSpec, days: int) -> tuple[DataFrame, DataFrame]:
    """(means, limits): (within, sku, d, m), the means of the last `days` calendar days on each date with rows and a whole
    window behind it, and (within, d, lo, hi), the least and greatest of them.

    A row counts for the dates up to `days` - 1 after it. Rows are dealt by sku first: the copies are made, and summed
    again, where they are, and no copy moves. Limits are a row a day and group, whatever the skus.
    """
    dealt = df.select(*within, sku, spec.date, spec.target).repartition(*within, sku)
    day = dealt.groupBy(*within, sku, spec.date).agg(F.sum(spec.target).alias("s"), F.count(spec.target).alias("n"))
    dates = df.groupBy(*within, F.col(spec.date).alias("d")).agg(F.lit(1).alias("__one")).withColumn("first", F.min("d").over(Window.partitionBy(*within)))
    dates = files.written_small(dates.where(F.col("d") >= F.date_add("first", days - 1)).drop("__one", "first"))
    hop = day.select(*within, sku, "s", "n", F.explode(F.sequence(F.col(spec.date), F.date_add(spec.date, days - 1))).alias("d"))
    mean = hop.join(dates, [*within, "d"], "left_semi").groupBy(*within, sku, "d").agg((F.sum("s") / F.sum("n")).alias("m"))
    return mean, files.written_small(mean.groupBy(*within, "d").agg(F.min("m").alias("lo"), F.max("m").alias("hi")))


def volume_band(df: DataFrame, within: list[str], sku: str = "sku_id", spec: PanelSpec = SERIES, days: int = 7) -> DataFrame:
    """(within, sku, date, band): of the means of the last `days` calendar days, four bins of equal width, lowest 3 to
    highest 0; 2 where all are equal. A date has a band if it has rows and a whole window behind it."""
    mean, limits = _day_means(df, within, sku, spec, days)
    return mean.join(limits, [*within, "d"]).select(*within, sku, F.col("d").alias(spec.date), _band(F.col("m"), F.col("lo"), F.col("hi")).alias("band"))


def with_volume_band(df: DataFrame, within: list[str], sku: str = "sku_id", spec: PanelSpec = SERIES, days: int = 7, deal: bool = False, counted: Column | None = None) -> DataFrame:
    """df with the band of its own dates, as `volume_band` gives it; null where it has none. counted: only such rows count
    and have bands.

    Means come from a window over each sku's days, so that of the days between nothing but the limits is kept. deal: rows
    are dealt by sku alone, which serves the windows of series after it as well.
    """
    limits = _day_means(df if counted is None else df.where(counted), within, sku, spec, days)[1].withColumnRenamed("d", spec.date)
    counted = F.lit(True) if counted is None else counted
    x = F.when(counted, F.col(spec.target))
    w = Window.partitionBy(*within, sku).orderBy(F.datediff(spec.date, F.lit("1970-01-01"))).rangeBetween(1 - days, 0)
    out = (df.repartition(sku) if deal else df).withColumn("__m", F.sum(x).over(w) / F.count(x).over(w)).join(limits.withColumn("__has", F.lit(True)), [*within, spec.date], "left")
    return out.withColumn("band", F.when(F.col("__has") & counted, _band(F.col("__m"), F.col("lo"), F.col("hi")))).select(*df.columns, "band")


def discount_statistics(df: DataFrame, by: list[str], rebates: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[f(r).alias(f"{r}_{n}") for r in rebates for n, f in (("max", F.max), ("mean", F.avg))])


def promotion_counts(df: DataFrame, dims: list[str], counters: list[str], spec: PanelSpec = SERIES) -> DataFrame:
    """Adds <counter>_<dim>: the day's sum of each counter in the row's dim."""
    return df.withColumns({f"{x}_{d}": F.sum(x).over(Window.partitionBy(spec.date, d)) for x in counters for d in dims})


def horizon_statistics(df: DataFrame, horizon: int, spec: PanelSpec = SERIES, col: str | None = None) -> DataFrame:
    """Statistics of what was known `horizon` rows ago; before that the first value stands in."""
    x = F.col(col or spec.target)
    first = F.first(x).over(spec.series().rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("__x", F.coalesce(F.lag(x, horizon).over(spec.series()), first))
    out = {"known_mean": F.avg("__x").over(spec.rows(Window.unboundedPreceding, 0))}
    for n in (7, 14):
        out |= {f"known_mean_{n}": F.avg("__x").over(spec.trailing(n)), f"known_max_{n}": F.max("__x").over(spec.trailing(n)), f"known_min_{n}": F.min("__x").over(spec.trailing(n))}
    return df.withColumns(out).drop("__x")


def elasticity(df: DataFrame, spec: PanelSpec = SERIES, price: str = "price", width: int = 7) -> DataFrame:
    """(keys, ed): mean of -(Δq/q)/(Δp/p) of smoothed price and volume inside 1.5 interquartile ranges; 0 for short series."""
    k = list(spec.keys)
    w = spec.trailing(width)
    full = F.count(price).over(w) >= width
    s = df.select(*k, spec.date, F.when(full, F.avg(price).over(w)).alias("p"), F.when(full, F.avg(spec.target).over(w)).alias("q")).where("p is not null")
    d = s.select(*k, "p", "q", (F.lead("p").over(spec.series()) - F.col("p")).alias("dp"), (F.lead("q").over(spec.series()) - F.col("q")).alias("dq"))
    e = d.where("dp is not null and abs(dp) > 1e-9").select(*k, (-(F.col("dq") / F.col("q")) / (F.col("dp") / F.col("p"))).alias("e"))
    e = e.withColumns({n: F.percentile("e", F.lit(q)).over(spec.whole()) for n, q in (("q1", 0.25), ("q3", 0.75))})
    inside = e.where(F.col("e").between(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")) - 1e-9, F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")) + 1e-9))
    found = inside.groupBy(*k).agg(F.avg("e").alias("ed"))
    return df.select(*k).distinct().join(found, k, "left").withColumn("ed", F.coalesce("ed", F.lit(0.0)))


def winsorised_elasticity(ed: DataFrame, cat: DataFrame, spec: PanelSpec = SERIES) -> DataFrame:
    """ed clipped to the fence over all series, then values of 0 or less replaced by their category's positive mean (else 1)."""
    ed = files.write_and_read(ed, "parquet", [])  # a row a series, read twice
    fence = ed.agg(F.percentile("ed", F.lit(0.25)).alias("a"), F.percentile("ed", F.lit(0.75)).alias("b"))
    out = ed.crossJoin(fence)  # one row
    out = out.withColumn("ed", F.least(F.greatest("ed", F.col("a") - 1.5 * (F.col("b") - F.col("a"))), F.col("b") + 1.5 * (F.col("b") - F.col("a")))).drop("a", "b")
    out = out.join(cat, list(spec.keys))
    mean = F.avg(F.when(F.col("ed") > 0, F.col("ed"))).over(Window.partitionBy("cat2"))
    return out.withColumn("ed", F.when(F.col("ed") > 0, F.col("ed")).otherwise(F.coalesce(mean, F.lit(1.0))))


def ratio_elasticity(df: DataFrame, spec: PanelSpec = SERIES, price: str = "price", band: int = 5) -> DataFrame:
    """(keys, ratio_ed): minus the slope through the means of bands of five of (Δp/p, Δq/q), ordered by price change."""
    k = list(spec.keys)
    s = spec.series()
    d = df.select(*k, spec.date, (F.lead(price).over(s) / F.col(price) - 1).alias("rp"), (F.lead(spec.target).over(s) / F.col(spec.target) - 1).alias("rq")).where("rp is not null")
    d = d.withColumns({n: F.percentile("rp", F.lit(q)).over(spec.whole()) for n, q in (("a", 0.25), ("b", 0.75))})
    d = d.where(F.col("rp").between(F.col("a") - 1.5 * (F.col("b") - F.col("a")) - 1e-9, F.col("b") + 1.5 * (F.col("b") - F.col("a")) + 1e-9))
    order = Window.partitionBy(*k).orderBy("rp", spec.date)
    bands = d.withColumn("g", F.floor((F.row_number().over(order) - 1) / band)).groupBy(*k, "g").agg(F.avg("rp").alias("x"), F.avg("rq").alias("y"))
    return bands.groupBy(*k).agg((-F.regr_slope("y", "x")).alias("ratio_ed"))


def quadratic_elasticity(df: DataFrame, spec: PanelSpec = SERIES, price: str = "price", least: int = 7) -> DataFrame:
    """(keys, c2, c1): least-squares quadratic of volume on centred price, by power sums and Cramer's rule."""
    k = list(spec.keys)
    d = df.withColumn("u", F.col(price) - F.avg(price).over(spec.whole()))
    q, u = F.col(spec.target), F.col("u")
    s = d.groupBy(*k).agg(F.count("*").cast("double").alias("s0"), *[F.sum(F.pow(u, F.lit(i))).alias(f"s{i}") for i in range(1, 5)], *[F.sum(F.pow(u, F.lit(i)) * q).alias(f"t{i}") for i in range(3)])
    det = F.expr("s4*(s2*s0-s1*s1)-s3*(s3*s0-s1*s2)+s2*(s3*s1-s2*s2)")
    c2 = F.expr("t2*(s2*s0-s1*s1)-s3*(t1*s0-s1*t0)+s2*(t1*s1-s2*t0)")
    c1 = F.expr("s4*(t1*s0-t0*s1)-t2*(s3*s0-s1*s2)+s2*(s3*t0-t1*s2)")
    return s.where((F.col("s0") >= least) & (F.abs(det) > 1e-6)).select(*k, (c2 / det).alias("c2"), (c1 / det).alias("c1"))


def predicted_volume(df: DataFrame, spec: PanelSpec = SERIES, price: str = "price", ed: str = "ed") -> DataFrame:
    """Adds ed_volume: last volume × (1 − relative price change × elasticity), at least 0; the first row has none."""
    s = spec.series()
    p, q = F.lag(price).over(s), F.lag(spec.target).over(s)
    return df.withColumn("ed_volume", F.greatest(F.lit(0.0), q * (1 - (F.col(price) - p) / p * F.col(ed))))


def reference_price(df: DataFrame, spec: PanelSpec = SERIES, amount: str = "arranged_amt", width: int = 30, block: int = 3) -> DataFrame:
    """Adds ref_price: the least net price of the row's block of three; net is the trailing mean where the price is off it."""
    k, s = list(spec.keys), spec.series()
    p = F.col(amount) / F.col(spec.target)
    df = df.withColumn("__p", F.when(p > 0, p))
    df = df.withColumn("__p", F.coalesce("__p", F.max("__p").over(spec.trailing(width)))).where("__p is not null")
    m = F.avg("__p").over(spec.trailing(width))
    df = df.withColumn("__m", m).withColumn("__b", F.floor((F.row_number().over(s) - 1) / block))
    net = F.when(F.abs(F.col("__p") - F.col("__m")) / F.col("__m") > 0.05, F.col("__m")).otherwise(F.col("__p"))
    return df.withColumn("__net", net).withColumn("ref_price", F.min("__net").over(Window.partitionBy(*k, "__b"))).drop("__p", "__m", "__b", "__net")


def ranked(df: DataFrame, order: list[str], name: str, within: tuple[str, ...] = (), parts: int = 64) -> DataFrame:
    """Adds name: the row's place from 1 by `order` (and within groups), without one task ever holding all rows.

    The rows with the `parts` least hashes split the order into ranges; each range is numbered by itself, and the ranges'
    counts, a few rows, say where it starts. Rows equal in all of `order` are numbered arbitrarily. Nulls come first.
    """
    some = df.select(*order).orderBy(F.xxhash64(*order)).limit(parts).collect()  # a bounded sample of keys
    if not some:
        return df.withColumn(name, F.lit(None).cast("long"))
    key = F.struct(*order)
    splits = F.array(*[F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order, r, strict=True)]) for r in some])
    rows = df.withColumn("__range", F.size(F.filter(splits, lambda s: s <= key)))
    counts = rows.groupBy(*within, "__range").agg(F.count("*").alias("__n"))
    upto = Window.partitionBy(*within).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*within, "__range", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__before"))  # `parts` + 1 rows a group
    rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(*within, "__range").orderBy(*order)))
    out = rows.join(before, [*within, "__range"]).withColumn(name, F.col(name) + F.col("__before"))
    return out.select(*df.columns, name)


def label_encoded(df: DataFrame, col: str, name: str, table: DataFrame | None = None) -> DataFrame:
    """Adds the value's rank in alphabetical order, from 0; nulls have none. Ranks are given to the distinct values. table: a
    written frame with the same values."""
    values = (df if table is None else table).select(col).where(F.col(col).isNotNull()).distinct()
    ranks = ranked(values, [col], name).withColumn(name, F.col(name) - 1)
    return df.join(files.written_small(ranks), col, "left")


def frequency_encoded(df: DataFrame, col: str, name: str, table: DataFrame | None = None) -> DataFrame:
    """Adds the value's rank by how many rows it has, most first, from 0; of equal counts the first by name. Nulls have none.
    table: a written frame with the same values, to count them there."""
    counts = (df if table is None else table).where(F.col(col).isNotNull()).groupBy(col).agg((-F.count("*")).alias("__c"))
    ranks = ranked(counts, ["__c", col], name).select(col, (F.col(name) - 1).alias(name))
    return df.join(files.written_small(ranks), col, "left")


def first_seen_encoded(df: DataFrame, outer: str, inner: str, name: str, date: str = "dt", table: DataFrame | None = None) -> DataFrame:
    """Adds the rank of `inner` within `outer` by first date, then by name. table: a written frame with the same values."""
    values = (df if table is None else table).groupBy(outer, inner).agg(F.min(date).alias("__d"))
    ranks = values.withColumn(name, F.row_number().over(Window.partitionBy(outer).orderBy("__d", inner)) - 1).drop("__d")
    return df.join(files.written_small(ranks), [outer, inner])


def poisson_quantile(df: DataFrame, rate: str, share: float = 0.85, most: int = 40, name: str = "k") -> DataFrame:
    """Adds the least k whose Poisson distribution function exceeds `share`, rates capped at 7."""
    lam = F.least(F.col(rate), F.lit(7.0))
    step = lambda a, i: F.struct((a["p"] * F.col("__lam") / i).alias("p"), (a["c"] + a["p"]).alias("c"), F.when(a["c"] + a["p"] <= share, a["k"] + 1).otherwise(a["k"]).alias("k"))
    start = F.struct(F.exp(-F.col("__lam")).alias("p"), F.lit(0.0).alias("c"), F.lit(0).alias("k"))
    return df.withColumn("__lam", lam).withColumn(name, F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step, lambda a: a["k"])).drop("__lam")


def poisson_demand(rates: DataFrame, ratios: DataFrame, dim: str = "cat2", rate: str = "rate", days: str = "days", share: float = 0.85) -> DataFrame:
    """rates with a row a weekday: weekday and demand, a week's demand dealt out by the category's weekday ratios.

    A week's demand is the Poisson quantile of the rate (at most 7), or the rate if that is more, over the days that it
    was sold, times seven. Categories without ratios get a seventh a day; no days give a null.
    """
    week = F.greatest(F.col("__k").cast("double"), F.least(F.col(rate), F.lit(7.0))) / F.when(F.col(days) > 0, F.col(days)) * 7
    rows = poisson_quantile(rates, rate, share, name="__k").withColumn("__week", week).withColumn("weekday", F.explode(F.sequence(F.lit(0), F.lit(6))))
    rows = rows.join(ratios.select(dim, "weekday", F.col("ratio").alias("__ratio")), [dim, "weekday"], "left")
    return rows.withColumn("demand", F.col("__week") * F.coalesce("__ratio", F.lit(1 / 7))).drop("__k", "__week", "__ratio")


def long_tail(df: DataFrame, spec: PanelSpec = SERIES, width: int = 7) -> DataFrame:
    """(keys, is_long_tail): the mean of the trailing sums is under 7; shorter series: fewer sales than rows."""
    s = F.when(F.count(spec.target).over(spec.trailing(width)) >= width, F.sum(spec.target).over(spec.trailing(width)))
    g = df.withColumn("__s", s).groupBy(*spec.keys).agg(F.avg("__s").alias("m"), F.sum(spec.target).alias("t"), F.count("*").alias("n"))
    return g.select(*spec.keys, F.when(F.col("n") >= width, F.col("m") < width).otherwise(F.col("t") < F.col("n")).cast("int").alias("is_long_tail"))


def without_long_tail(df: DataFrame, counted: Column, spec: PanelSpec = SERIES, width: int = 7) -> DataFrame:
    """Rows of the series whose counted rows aren't a long tail, as `long_tail` says; series without such rows stay. Windows
    decide, so that rows that lie by series stay where they are."""
    x, w = F.when(F.col("__c"), F.col(spec.target)), spec.trailing(width, "__c")
    df = df.withColumn("__c", F.coalesce(counted, F.lit(False)))
    df = df.withColumn("__s", F.when(F.col("__c") & (F.count(x).over(w) >= width), F.sum(x).over(w)))
    n, whole = F.count(F.when(F.col("__c"), 1)).over(spec.whole()), spec.whole()
    tail = F.when(n >= width, F.avg("__s").over(whole) < width).otherwise(F.sum(x).over(whole) < n)
    return df.withColumn("__t", tail).where("not coalesce(__t, false)").drop("__c", "__s", "__t")


def routed(df: DataFrame, spec: PanelSpec = SERIES, checking: int = 14) -> DataFrame:
    """(keys, route) by the last rows' mean and count of positive days."""
    g = last_rows(df, checking, spec).groupBy(*spec.keys).agg(F.avg(spec.target).alias("m"), F.count(F.when(F.col(spec.target) > 0, 1)).alias("pos"), F.count("*").alias("n"))
    route = F.when((F.col("m") <= 0) | (F.col("pos") <= 0), "no_sell").when(F.col("n") < checking, "very_long_tail")
    return g.select(*spec.keys, route.when((F.col("m") <= 0.5) | (F.col("pos") <= 1), "very_long_tail").when((F.col("m") <= 10) | (F.col("pos") <= 3), "long_tail").otherwise("normal").alias("route"))


def equal_buckets(df: DataFrame, by: str, size: int, keys: list[str], within: list[str] | None = None) -> DataFrame:
    """Adds bucket: groups of `size` in the order of `by`, ties by key. df has a row a series."""
    out = ranked(df, [by, *keys], "__place", tuple(within or ()))
    return out.withColumn("bucket", F.floor((F.col("__place") - 1) / size) + 1).drop("__place")


def index_with_fallback(rows: DataFrame, tables: list[tuple[DataFrame, list[str]]], default: float = 1.0, name: str = "idx") -> DataFrame:
    """Adds name: the index of the first table (keys and idx) that has one for the row, else the default."""
    out = rows
    for i, (table, on) in enumerate(tables):
        out = out.join(table.select(*on, F.col("idx").alias(f"__i{i}")), on, "left")
    return out.select(*rows.columns, F.coalesce(*[F.col(f"__i{i}") for i in range(len(tables))], F.lit(default)).alias(name))


def calendar_flags(df: DataFrame, calendar: DataFrame, date: str = "dt") -> DataFrame:
    """Adds is_holiday, is_workday, holiday_or_eve and next_is_workday from a calendar of special days (day, kind): kind
    'holiday' is free, kind 'swap' a weekend day that is worked. The calendar has a few rows a year."""
    day = calendar.select(F.col("day").cast("date").alias("__day"), F.col("kind").alias("__kind")).distinct()
    out = df
    for i in (0, 1):
        near = day.groupBy(F.date_sub("__day", i).alias(date)).agg(*[F.max(F.when(F.col("__kind") == k, 1).otherwise(0)).alias(f"__{k}{i}") for k in ("holiday", "swap")])
        out = out.join(near, date, "left").fillna(0, [f"__holiday{i}", f"__swap{i}"])
    work = lambda i: ((F.weekday(F.date_add(date, i)) < 5) & (F.col(f"__holiday{i}") == 0)) | (F.col(f"__swap{i}") == 1)
    flags = {"is_holiday": F.col("__holiday0") == 1, "is_workday": work(0), "holiday_or_eve": (F.col("__holiday0") == 1) | (F.col("__holiday1") == 1), "next_is_workday": work(1)}
    return out.select(*df.columns, *[c.cast("int").alias(n) for n, c in flags.items()])


def elastic_volumes(df: DataFrame, statistics: dict[str, tuple[str, str]], price: str = "w_price", ed: str = "ed") -> DataFrame:
    """Adds each named column: the volume that a (price, volume) pair of statistics and the elasticity foretell, at least 0."""
    return df.withColumns({n: F.greatest(F.lit(0.0), F.col(q) * (1 - (F.col(price) - F.col(p)) / F.col(p) * F.col(ed))) for n, (p, q) in statistics.items()})


def nearest_price(df: DataFrame, spec: PanelSpec = SERIES, ref: str = "ref_price", price: str = "price", interval: int = 3) -> DataFrame:
    """(keys, ref, chunk, date, nearest): rows of a series with the same reference price are cut into near-equal chunks of
    about `interval`; of each the price nearest to the reference, the first one of equals."""
    from panelwright.operators.rolling import near_equal_chunks

    by = PanelSpec((*spec.keys, ref), spec.date, spec.target)
    rows = near_equal_chunks(df, interval, by)
    best = F.min_by(F.struct(spec.date, price), F.struct(F.round(F.abs(F.col(price) - F.col(ref)), 6), F.col(spec.date)))
    return rows.groupBy(*spec.keys, ref, "chunk").agg(best.alias("__b")).select(*spec.keys, ref, "chunk", f"__b.{spec.date}", F.col(f"__b.{price}").alias("nearest"))


def perceived_price(df: DataFrame, spec: PanelSpec = SERIES, ref: str = "ref_price", price: str = "price", interval: int = 3, name: str = "perceived") -> DataFrame:
    """df with name: of the row's chunk, as `nearest_price` cuts them, the price nearest to the reference, first one of equals."""
    from panelwright.operators.rolling import near_equal_chunks

    rows = near_equal_chunks(df, interval, PanelSpec((*spec.keys, ref), spec.date, spec.target), "__chunk")
    w = Window.partitionBy(*spec.keys, ref, "__chunk").orderBy(F.round(F.abs(F.col(price) - F.col(ref)), 6), spec.date)
    return rows.withColumn(name, F.first(price).over(w)).drop("__chunk")


def promotion_history_mean(df: DataFrame, promo: str, spec: PanelSpec = SERIES, train: str = "is_train") -> DataFrame:
    """Adds history_mean: of the series' rows of the same promotion state up to the row before, weights .7, .2 and .1; where
    the state has no training row, the mean over all rows with equal weights."""
    from panelwright.operators.rolling import history_mean

    by = PanelSpec((*spec.keys, promo), spec.date, spec.target)
    out = history_mean(history_mean(df, weights=(0.7, 0.2, 0.1), spec=by, name="__own"), spec=spec, name="__all")
    known = F.max(F.col(train) == 1).over(by.whole())
    return out.withColumn("history_mean", F.when(known, F.col("__own")).otherwise(F.col("__all"))).drop("__own", "__all")


def sales_drop_cases(df: DataFrame, spec: PanelSpec = SERIES, pred: str = "pred_t0") -> DataFrame:
    """The latest row of each series whose forecasts went wrong as sales fell: mean error of three rows at least 0.5, and
    the seven rows before those sold at least twice as much."""
    from panelwright.functions.scalars import absolute_percentage_error

    df = df.withColumn("__ape", absolute_percentage_error(spec.target, pred))
    x = spec.target
    df = df.withColumns({"ape_3": F.avg("__ape").over(spec.trailing(3)), "mean_3": F.avg(x).over(spec.trailing(3)), "mean_4_10": F.avg(x).over(spec.rows(-9, -3)), "n_rows": F.count("*").over(spec.whole())})
    df = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*spec.keys).orderBy(F.desc(spec.date))))
    hit = (F.col("ape_3") >= 0.5) & (0.5 * (F.col("mean_4_10") + 1) > F.col("mean_3") + 1) & (F.col("n_rows") > 10)
    return df.where((F.col("__rn") == 1) & hit).drop("__rn", "__ape")


def sized_and_recent(df: DataFrame, least: int, first: str, last: str, spec: PanelSpec = SERIES, counted: Column | None = None) -> DataFrame:
    """Rows of the series that have at least `least` rows (of the counted ones) and whose target from the first to the last
    day does not sum to 0 (or to nothing). Windows decide on both, so that rows that lie by series stay where they are; null
    keys are in no series."""
    day = F.col(spec.date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    rows = df.dropna(subset=list(spec.keys)).withColumns({
        "__n": F.count(F.when(counted if counted is not None else F.lit(True), 1)).over(spec.whole()),
        "__s": F.coalesce(F.sum(F.when(day, F.col(spec.target))).over(spec.whole()), F.lit(0)),
    })
    return rows.where((F.col("__n") >= least) & (F.col("__s") != 0)).drop("__n", "__s")


def festival_scaled_mean(df: DataFrame, index: str, spec: PanelSpec = SERIES, festival: str = "festival_name", none: str = "无", width: int = 3, name: str = "festival_scaled_mean") -> DataFrame:
    """Adds the mean of the last `width` plain rows (fewer at the start) before each row; festivals' rows take it times their index.

    Rows of festivals are in no mean. Rows with no plain row before them take their own value in its place; a null index
    counts as 1.
    """
    plain = F.col(festival) == none
    df = df.withColumn("__plain", F.coalesce(plain, F.lit(False)))
    mean = F.when(F.col("__plain"), F.avg(spec.target).over(spec.trailing(width, "__plain")))
    df = df.withColumn("__m", mean)
    before = F.last("__m", ignorenulls=True).over(spec.rows(Window.unboundedPreceding, -1))
    value = F.coalesce(before, F.col(spec.target).cast("double"))
    return df.withColumn(name, F.when(F.col("__plain"), value).otherwise(value * F.coalesce(F.col(index), F.lit(1.0)))).drop("__plain", "__m")


def recent_band(df: DataFrame, origin: str, spec: PanelSpec = SERIES, days: int = 30, last: int = 7, step: float = 5.0, name: str = "recent_band") -> DataFrame:
    """(keys, name): the mean of a series' last rows within `days` days before origin, in steps; series without any have no row."""
    end = F.to_date(F.lit(origin))
    recent = df.where((F.col(spec.date) < end) & (F.col(spec.date) >= F.date_sub(end, days)))
    back = Window.partitionBy(*spec.keys).orderBy(F.desc(spec.date))
    rows = recent.withColumn("__rn", F.row_number().over(back)).where(F.col("__rn") <= last)
    return rows.groupBy(*spec.keys).agg(F.floor(F.avg(spec.target) / step).alias(name))
