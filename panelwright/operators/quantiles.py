"""Exact quantiles of groups of any size, by narrowing: no group's values have to fit into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: list[str], col: str, shares: dict[str, float], parts: int = 64) -> DataFrame:
    """(keys, one column a share): quantiles with linear interpolation, as `percentile` gives them.

    A mergeable sketch of each group cuts its values into `parts` ranges; the ranges are counted, and only those that the
    wanted places fall into are sorted, each on its own. So a group's values are spread over as many tasks as it has
    ranges, and what a group keeps in memory is `parts` numbers; only copies of one value stay together, as counts.
    Nulls are left out (NaN is the greatest value); a group without values gets no row. A null key is a group.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    rows = df.where(F.col(col).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(col).cast("double").alias("x"))
    values = rows.groupBy(*names, "x").agg(F.count("*").alias("m"))
    ends = F.percentile_approx("x", F.array(*[F.lit(i / parts) for i in range(1, parts)]), F.lit(16 * parts))
    edges = rows.groupBy(*names).agg(ends.alias("ends"), F.count("*").alias("n"))

    def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        """An inner join in which a null key is a key like any other."""
        right = right.withColumnsRenamed({c: f"{c}_r" for c in on})
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(c).eqNullSafe(F.col(f"{c}_r"))
        return left.join(right, cond).drop(*[f"{c}_r" for c in on])

    cut = matched(values, edges, names).select(*names, "x", "m", "n", F.expr("size(filter(ends, e -> e < x))").alias("part"))
    counts = cut.groupBy(*names, "part").agg(F.sum("m").alias("c"), F.first("n").alias("n"))
    before = F.sum("c").over(Window.partitionBy(*names).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    places = F.array(*[F.expr(f"{q}D * (n - 1)") for q in shares.values()])
    wanted = counts.where(F.exists(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))), lambda p: (p >= F.col("before")) & (p < F.col("before") + F.col("c"))))
    wanted = wanted.select(*names, "part", "before")
    some = matched(cut, wanted, [*names, "part"])
    upto = F.sum("m").over(Window.partitionBy(*names, "part").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)) + F.col("before")
    some = some.withColumn("upto", upto)
    at = lambda place: F.max(F.when((F.col("upto") - F.col("m") <= place) & (place < F.col("upto")), F.col("x")))
    out = some.groupBy(*names).agg(F.first("n").alias("n"), *[at(side(F.expr(f"{q}D * (n - 1)"))).alias(f"__{tag}{i}") for i, q in enumerate(shares.values()) for tag, side in (("lo", F.floor), ("hi", F.ceil))])
    between = lambda i, q: F.col(f"__lo{i}") + (F.expr(f"{q}D * (n - 1)") - F.floor(F.expr(f"{q}D * (n - 1)"))) * (F.col(f"__hi{i}") - F.col(f"__lo{i}"))
    return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], *[between(i, q).alias(name) for i, (name, q) in enumerate(shares.items())])
