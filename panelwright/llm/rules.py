"""Quality rules: statistics of each text, and robust multivariate outliers among them, in DataFrame functions alone.

The statistics stay in the row: a text's repeated word windows are found by sorting its own windows' hashes, so nothing
is shuffled for them. Outliers are judged per language and source by minimum-covariance-determinant estimates. From three
starts (medians and quartiles; all rows; the rows inside the middle of every statistic), mean and covariance of the three
quarters of a group nearest to the last estimate are taken again (concentration steps); for each group the start with the
least determinant goes on until no group's determinant falls any more. Every step is one aggregation into histograms
of distances, which tell where three quarters lie, and one into moments, for all groups and starts at once. An estimate
counts as PRIOR rows of the estimate over all rows and as many as the group has of its own, so small groups lean on the
whole by degrees. How far is too far follows from the distances' own distribution.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import staged

BLANK = r"[\x20\x09-\x0D]+"
#: Share of a group that its estimate rests on, concentration steps of every start, further ones of the best start at most,
#: and the fall of a log-determinant that counts.
SHARE, FIRST_STEPS, MOST_STEPS, FALL = 0.75, 2, 6, 0.01
#: Rows that the estimate over all rows counts as, beside a group's own.
PRIOR = 60.0
#: A text is rejected beyond the upper quartile of the logarithms of all squared distances by so many interquartile ranges:
#: Tukey's fence.
FENCE = 1.5
#: Estimates up to this many rows are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 50_000
#: 0.75-quantile of chi-squared with five degrees of freedom: makes the estimates consistent.
CHI2_75 = 6.6257
#: Least standard deviation of each statistic, so that one that is nearly constant in a group doesn't condemn a trace.
FLOORS = {"x0": 0.35, "x1": 0.12, "x2": 0.25, "x3": 0.35, "x4": 0.30}
XS = tuple(FLOORS)
D = len(XS)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, *keep): one row per row of docs.

    Null and empty texts have no words, and so no symbols, lines or windows; a text of any length stays in its row. Null ids
    come back, repeated rows come back repeated, and columns other than `keep` aren't read, whatever their names. An empty
    table gives no rows.
    """
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *[F.col(k).cast("string").alias(f"k_{k}") for k in keep])
    rest = [f"k_{k}" for k in keep]
    blanks, signs = " \t\n\x0b\x0c\r", "#*$%&|<>"
    t = t.select(
        "id",
        *rest,
        F.filter(F.split("text", BLANK), lambda w: w != "").alias("words"),
        F.length(F.translate("text", blanks, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", signs, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, blanks, "")) > 0).alias("lines"),
    )
    windows = F.when(F.size("words") >= 3, F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    base = ["id", *rest, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    t = t.select("id", *rest, F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), windows.alias("w"))
    t = t.select(*base, "w", F.sort_array("w").alias("s"))
    twice = F.expr("exists(sequence(1, greatest(size(s) - 1, 1)), i -> get(s, i) = get(s, i - 1))")
    pairs = F.when(twice, F.sort_array(F.transform("w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.expr("cast(array() as array<struct<h: bigint, i: int>>)"))
    t = t.select(*base, pairs.alias("p"))
    again = F.expr("filter(p, (x, k) -> coalesce(get(p, k - 1).h = x.h, false) or coalesce(get(p, k + 1).h = x.h, false))")
    t = t.select(*base, again.alias("p"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("p", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    t = t.select(*base, covered.cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return t.select(*base[len(rest) + 1 :], "n_repeat_words", failed.alias("base_failed"), "id", *rest)


def transformed(stats: DataFrame) -> DataFrame:
    """stats with the vector that is judged: logs of length, word length, and rates in a hundred words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    x = [F.log1p(n), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log1p(100 * F.col("n_symbols") / n), F.log1p(100 * F.col("n_dup_lines") / n), F.log1p(100 * F.col("n_repeat_words") / n)]
    return stats.withColumns(dict(zip(XS, x, strict=True)))


def _near(df: DataFrame, est: DataFrame, on: list[str], small: bool, how: str = "inner") -> DataFrame:
    """df joined with a few numbers a group: not by a shuffle of df while these are few, whatever df's hot groups."""
    return df.join(F.broadcast(est) if small else est, on, how)


def _whitening(est: DataFrame) -> DataFrame:
    """est (g, s, n, means m*, covariances c*_*) with k*_*, the inverse of the covariance's Cholesky factor, and logdet.

    Worked out on the few rows of the estimates, column by column, so that the rows of texts only need a weighted sum.
    """
    for j in range(D):
        cells = []
        for i in range(j, D):
            inner = f"c{i}_{j}" + "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(j))
            cells.append(f"sqrt(greatest({inner}, 1e-9)) AS l{j}_{j}" if i == j else f"({inner}) / sqrt(greatest(c{j}_{j}{''.join(f' - l{j}_{k} * l{j}_{k}' for k in range(j))}, 1e-9)) AS l{i}_{j}")
        est = est.selectExpr("*", *cells)
    for i in range(D):
        inverse = [f"1 / l{i}_{i} AS k{i}_{i}"] + [f"-({' + '.join(f'l{i}_{k} * k{k}_{j}' for k in range(j, i))}) / l{i}_{i} AS k{i}_{j}" for j in range(i)]
        est = est.selectExpr("*", *inverse)
    logdet = "2 * (" + " + ".join(f"ln(l{i}_{i})" for i in range(D)) + ") AS logdet"
    return est.selectExpr("g", "s", "n", *_MEANS, *_COVS, *[f"k{i}_{j}" for i in range(D) for j in range(i + 1)], logdet)


_MEANS = [f"m{i}" for i in range(D)]
_COVS = [f"c{i}_{j}" for i in range(D) for j in range(i + 1)]


def _distance(df: DataFrame) -> DataFrame:
    """df (with XS, and per row its group's m* and k*_*) with d, the squared Mahalanobis distance."""
    zs = [" + ".join(f"k{i}_{j} * (x{j} - m{j})" for j in range(i + 1)) + f" AS z{i}" for i in range(D)]
    return df.selectExpr("*", *zs).selectExpr("*", " + ".join(f"z{i} * z{i}" for i in range(D)) + " AS d")


def _moments(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Count, mean and covariance (with the floors added) by keys."""
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    sums = [f"avg(x{i}) AS m{i}" for i in range(D)] + [f"avg(x{i} * x{j}) AS q{i}_{j}" for i, j in pairs]
    m = df.groupBy(*keys).agg(F.count("*").cast("double").alias("n"), *map(F.expr, sums))
    return m.selectExpr(*keys, "n", *_MEANS, *[f"q{i}_{j} - m{i} * m{j} + {FLOORS[f'x{i}'] ** 2 if i == j else 0.0}D AS c{i}_{j}" for i, j in pairs])


def _leaning(est: DataFrame, prior: DataFrame | None) -> DataFrame:
    """est (g, s, n, m*, c*) drawn towards the one row of prior, which counts as PRIOR rows."""
    if prior is None:
        return est
    one = prior.selectExpr(*[f"{c} AS p_{c}" for c in [*_MEANS, *_COVS]])
    both = est.crossJoin(F.broadcast(one))  # one row
    return both.selectExpr("g", "s", "n", *[f"(n * {c} + {PRIOR} * p_{c}) / (n + {PRIOR}) AS {c}" for c in [*_MEANS, *_COVS]])


def _bin(col: str):
    return F.floor(F.log(F.col(col) + 1e-6) * 32).cast("int")


def _upper(bin_col):
    return F.exp((bin_col + 1) / 32.0) - 1e-6


def _cuts(df: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """(keys, the bin of d at or below which each share of the rows lies, by name)."""
    bins = df.groupBy(*keys, _bin("d").alias("bin")).agg(F.count("*").alias("n"))  # about 1,500 bins a group at most
    run = bins.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return run.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bin"))).alias(name) for name, share in shares.items()])


def _starts(rows: DataFrame, small: bool) -> DataFrame:
    """(g, s, n, m*, c*): three first estimates of each group."""
    middle = rows.groupBy("g").agg(F.count("*").cast("double").alias("n"), *[F.percentile_approx(f"x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"p{i}") for i in range(D)])
    middle = staged(middle, "middle")
    wide = [f"(p{i}[2] - p{i}[0]) / 1.349D + {FLOORS[f'x{i}']}D" for i in range(D)]
    first = middle.selectExpr("g", "0 AS s", "n", *[f"p{i}[1] AS m{i}" for i in range(D)], *[(f"pow({wide[i]}, 2)" if i == j else "0.0D") + f" AS c{i}_{j}" for i in range(D) for j in range(i + 1)])
    kept = ["g", "s", "n", *_MEANS, *_COVS]
    second = _moments(rows, ("g",)).withColumn("s", F.lit(1)).select(kept)
    near = _near(rows, middle.drop("n"), ["g"], small)
    near = near.where(" AND ".join(f"abs(x{i} - p{i}[1]) <= 2 * ({wide[i]})" for i in range(D)))
    third = _moments(near, ("g",)).withColumn("s", F.lit(2)).select(kept)
    return first.select(kept).union(second).union(third)


def _step(rows: DataFrame, est: DataFrame, prior: DataFrame | None, small: bool) -> DataFrame:
    """The estimates (g, s) from the SHARE of each group's rows nearest to est."""
    near = _distance(_near(rows, est.drop("n", "logdet", *_COVS), ["g"], small)).select("g", "s", *XS, "d")
    cut = staged(_cuts(near, ["g", "s"], {"cut": SHARE}), "cut")
    core = _near(near, cut, ["g", "s"], small).where(_bin("d") <= F.col("cut"))
    return staged(_whitening(_leaning(_moments(core, ("g", "s")), prior)), "estimate")


def mcd(rows: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """(g, n, m*, c*_*, k*_*, logdet, q): each group's estimate of least determinant, from rows (g, XS), one row a group.

    q is the distance within which SHARE of the group's rows lie. A group of one row has an estimate, too.
    """
    small = rows.select("g").distinct().count() <= BROADCAST_ROWS
    est = staged(_whitening(_leaning(_starts(rows, small), prior)), "estimate")
    for _ in range(FIRST_STEPS):
        est = _step(rows, est, prior, small)
    best = est.groupBy("g").agg(F.min_by(F.struct(*[c for c in est.columns if c != "g"]), F.struct("logdet", "s")).alias("e")).select("g", "e.*")
    est = staged(best, "best")
    for _ in range(MOST_STEPS):
        new = _step(rows, est, prior, small)
        fell = new.join(est.select("g", F.col("logdet").alias("old")), "g").agg(F.max(F.col("old") - F.col("logdet"))).first()[0]
        est = new
        if fell is None or fell < FALL:
            break
    q = _cuts(_distance(_near(rows, est, ["g"], small)), ["g"], {"cut": SHARE}).select("g", _upper(F.col("cut")).alias("q"))
    return staged(est.drop("s").join(q, "g"), "estimate")


def outliers(stats: DataFrame, group: tuple[str, ...] = ("lang", "source"), fence: float = FENCE) -> DataFrame:
    """stats (from `statistics`, with the group's columns kept) with distance2 and kept.

    Rows that fail the base rules teach nothing and aren't kept. A null language or source is a group of its own. Where
    no row passes the base rules, distance2 is null.
    """
    stats = staged(stats, "statistics")  # else the optimizer copies the texts' expressions into each use of a statistic
    own = F.concat_ws("\x01", *[F.coalesce(F.col(f"k_{k}"), F.lit("\x00")) for k in group]) if group else F.lit("")
    all_rows = staged(transformed(stats).withColumn("g", own), "grouped")
    rows = all_rows.where(~F.col("base_failed")).select("g", *XS)
    whole = mcd(rows.withColumn("g", F.lit("all")))
    est = mcd(rows, whole)
    scale = (F.col("n") * F.col("q") + PRIOR * F.col("p_q")) / (F.col("n") + PRIOR) / CHI2_75
    est = staged(est.crossJoin(F.broadcast(whole.select(F.col("q").alias("p_q")))).withColumn("scale", scale), "estimate")  # one row
    judged = _distance(_near(all_rows, est, ["g"], est.count() <= BROADCAST_ROWS, "left")).withColumn("d", F.col("d") / F.greatest("scale", F.lit(0.2)))
    judged = staged(judged.select(*stats.columns, F.col("d").alias("distance2")), "judged")
    passed = judged.where(~F.col("base_failed") & F.col("distance2").isNotNull()).select(F.lit(1).alias("g"), F.col("distance2").alias("d"))
    low, high = _cuts(passed, ["g"], {"low": 0.25, "high": 0.75}).select("low", "high").first() or (0, 0)
    cutoff = math.exp((high + 1 + fence * (high - low)) / 32.0)
    verdict = ~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(True))
    return judged.withColumn("kept", verdict)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: tuple[str, ...] = ("lang", "source"), fence: float = FENCE) -> DataFrame:
    """(id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance2), one row per
    row of docs. Null and empty texts have no words and so fail the base rules; null ids come back; repeated rows come back
    repeated; other columns aren't read; an empty table gives no rows."""
    found = outliers(statistics(docs, id_col, text_col, group), group, fence)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"]
    return found.select(F.col("id").alias(id_col), *cols)
