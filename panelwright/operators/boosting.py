"""Gradient-boosted regression trees for any number of cohorts at once, from shared histograms.

A cohort is a value of one column (a bucket of series, an hour, a volume band), and each gets trees of its own. Features
are binned once, at the cohort's own quantiles. A level of the trees of all cohorts is one job: sums of gradients and
of second derivatives by (cohort, node, feature, bin), which are combined in the tasks before the shuffle; cumulative sums
over the bins give the best split of every node. So a round costs as many jobs as the trees are deep, whatever the number of
cohorts, and no cohort's rows have to meet anywhere.

Rows are kept in blocks of up to 4,096 of one cohort: a row of the table holds their bins (a byte each), labels and scores,
so a task adds up a block with numpy, and the trees are joined with blocks and not with rows. What is known of a cohort (its
trees, losses, whether it still takes part) is one row of a small table, written anew after each level. Scores are written
every few rounds; meanwhile they are worked out from the trees since.

Rows marked as validation take no part in the splits; the loss over them decides, cohort by cohort, how many rounds count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.sources import files

_SPLIT = "struct<f: int, b: int, low: double, high: double>"
#: Rows of a block, rows that a task holds to cut blocks from, and bytes of sums that it holds before it hands them on.
BLOCK, HELD, SUMS = 4096, 65_536, 64_000_000
#: As many cohorts are broadcast; more are left to the optimiser.
FEW = 10_000


@dataclass(frozen=True)
class Trees:
    """edges: (cohort, edges), the upper ends of the bins of each feature; trees: (cohort, base, trees), the rounds that
    count, each a map from node to split (the root is 1, the children of n are 2n and 2n + 1); losses: (cohort, round,
    train_loss, valid_loss, kept), round 0 being the base alone."""

    edges: DataFrame
    trees: DataFrame
    losses: DataFrame
    features: tuple[str, ...]
    cohort: str
    depth: int


def gradients(score: Column, label: Column, loss: str) -> tuple[Column, Column, Column]:
    """(gradient, second derivative, loss) of a row. `asymmetric`: predictions over the label by more than one weigh half."""
    error = score - label
    if loss == "squared":
        return error, F.lit(1.0), error * error / 2
    if loss != "asymmetric":
        raise ValueError(f"unknown loss {loss}")
    weight = F.when(error > 1, 0.5).otherwise(1.0)
    return weight * error, weight, weight * error * error / 2


def _binned(df: DataFrame, edges: DataFrame, features: tuple[str, ...], cohort: str) -> DataFrame:
    """Adds __bins, the number of edges under each feature's value; nulls and NaN are in bin 0 with the least values."""
    joined = df.join(edges, cohort)

    def bin_of(i: int, x: Column) -> Column:
        under = F.filter(F.element_at("edges", i + 1), lambda end: end < x)
        return F.when(x.isNull() | F.isnan(x), 0).otherwise(F.size(under))

    bins = [bin_of(i, F.col(f).cast("double")) for i, f in enumerate(features)]
    return joined.withColumn("__bins", F.array(*bins)).drop("edges")


def _score(trees: Column, bins: Column, depth: int) -> Column:
    """Sum of the values that a row reaches in an array of trees. The way down is a fold, so that no step is written out twice."""

    def one(total, tree):
        def step(at, _):
            split = F.try_element_at(tree, at["node"])
            right = F.try_element_at(bins, split["f"] + 1) > split["b"]
            return F.struct(
                F.when(split.isNull(), at["node"]).when(right, 2 * at["node"] + 1).otherwise(2 * at["node"]).cast("int").alias("node"),
                F.when(split.isNull(), at["value"]).when(right, split["high"]).otherwise(split["low"]).alias("value"),
            )

        start = F.struct(F.lit(1).alias("node"), F.lit(0.0).alias("value"))
        return total + F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, step, lambda at: at["value"])

    return F.aggregate(trees, F.lit(0.0), one)


def _cohort_type(df: DataFrame) -> str:
    return df.schema["cohort"].dataType.simpleString()


def _packed(rows: DataFrame, n: int) -> DataFrame:
    """(cohort, x, y, valid): rows in blocks, each of one cohort, as arrays of 8 bytes a number and one a mark; nulls are NaN."""

    def cut(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        coded = pa.concat_arrays(table.column("cohort").chunks).dictionary_encode()
        codes = coded.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        x = np.stack([table.column(f"x{i}").to_numpy()[order].astype(np.float64) for i in range(n)]) if n else np.empty((0, len(codes)))
        y, valid = table.column("y").to_numpy()[order], table.column("valid").to_numpy()[order].astype(np.uint8)
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        spans = [(c, i, min(i + BLOCK, end)) for c, end in enumerate(ends) for i in range(ends[c - 1] if c else 0, end, BLOCK)]
        parts = [[part[..., i:j].tobytes() for _, i, j in spans] for part in (x, y, valid)]
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array([c for c, _, _ in spans])), *[pa.array(p, pa.binary()) for p in parts]], ["cohort", "x", "y", "valid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held, size = [*held, batch], size + batch.num_rows
            if size >= HELD:
                yield cut(held)
                held, size = [], 0
        if held:
            yield cut(held)

    return rows.mapInArrow(run, f"cohort {_cohort_type(rows)}, x binary, y binary, valid binary")


def _blocks(packed: DataFrame, bins: int) -> DataFrame:
    """(cohort, bins, y, valid, score) of blocks joined with (edges, base): of each value the number of edges under it, feature
    by feature, and the base as score. NaN is in bin 0 with the least values."""
    kind = np.min_scalar_type(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = [], []
            for x, edges, base in zip(batch.column("x"), batch.column("edges"), batch.column("base").to_pylist()):
                edges = [np.array(e, np.float64) for e in edges.as_py()]
                values = np.frombuffer(x.as_buffer()).reshape(len(edges), -1)
                each = [np.where(np.isnan(v), 0, np.searchsorted(e, v)).astype(kind) for v, e in zip(values, edges)]
                found.append(b"".join(e.tobytes() for e in each))
                scores.append(np.full(values.shape[1], base).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("cohort"), pa.array(found, pa.binary()), batch.column("y"), batch.column("valid"), pa.array(scores, pa.binary())], ["cohort", "bins", "y", "valid", "score"])

    return packed.mapInArrow(run, f"cohort {_cohort_type(packed)}, bins binary, y binary, valid binary, score binary")


def _reached(bins: np.ndarray, tree: dict[int, dict], levels: int) -> np.ndarray:
    """The node that each row of a block reaches after so many levels."""
    at = np.ones(bins.shape[1], np.int64)
    if not tree or not levels:
        return at
    f, b, rows = np.full(max(tree) + 1, -1), np.zeros(max(tree) + 1, np.int64), np.arange(bins.shape[1])
    for node, split in tree.items():
        f[node], b[node] = split["f"], split["b"]
    for _ in range(levels):
        here = np.minimum(at, len(f) - 1)
        on = (at < len(f)) & (f[here] >= 0)
        at = np.where(on, 2 * at + (bins[f[here], rows] > b[here]), at)
    return at


def _added(bins: np.ndarray, tree: dict[int, dict], depth: int) -> np.ndarray:
    """The tree's value of each row of a block."""
    value = np.zeros(2 * max(tree, default=0) + 2)
    for node, split in tree.items():
        value[2 * node], value[2 * node + 1] = split["low"], split["high"]
    return value[_reached(bins, tree, depth)]


def _derived(error: np.ndarray, loss: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`gradients` of an array."""
    weight = np.where(error > 1, 0.5, 1.0) if loss == "asymmetric" else np.ones(len(error))
    return weight * error, weight, weight * error * error / 2


def _opened(batch: pa.RecordBatch, n: int, kind: np.dtype, depth: int, growing: bool) -> Iterator[tuple]:
    """(cohort, bins, label, is valid, score, tree) of each block, the score with all finished trees; tree: the one that grows."""
    columns = [batch.column(c) for c in ("cohort", "bins", "y", "valid", "score", "trees")]
    for cohort, bins, y, valid, score, trees in zip(*columns):
        y = np.frombuffer(y.as_buffer())
        bins = np.frombuffer(bins.as_buffer(), kind).reshape(n, len(y))
        score, trees = np.frombuffer(score.as_buffer()), [dict(t) for t in trees.as_py()]
        for tree in trees[:-1] if growing else trees:
            score = score + _added(bins, tree, depth)
        yield cohort, bins, y, np.frombuffer(valid.as_buffer(), np.uint8) > 0, score, trees[-1] if growing else {}


def _cells(blocks: DataFrame, n: int, bins: int, level: int, depth: int, loss: str, grows: bool) -> DataFrame:
    """(cohort, node, f, b, g, h, n): sums of a level over the training rows of all cohorts; at level 0 also the losses, whose
    feature is -1 (g: their sum, b: 0 for training rows and 1 for the others). Without grows the losses only."""
    kind, size = np.min_scalar_type(bins), n * bins << level

    def handed(sums: dict, losses: dict, like: pa.Array) -> Iterator[pa.RecordBatch]:
        for cohort, cells in sums.items():
            node, f, b = np.unravel_index(np.flatnonzero(cells[2]), (1 << level, n, bins))
            values = cells[:, cells[2] > 0]
            yield row(like, cohort, node + (1 << level), f, b, *values)
        for cohort, found in losses.items():
            there = np.flatnonzero(found[1])
            yield row(like, cohort, np.ones(len(there)), np.full(len(there), -1), there, found[0][there], np.zeros(len(there)), found[1][there])

    def row(like, cohort, node, f, b, g, h, count) -> pa.RecordBatch:
        arrays = [pa.array(c.astype(np.int32)) for c in (node, f, b)]
        arrays = [pa.array([cohort] * len(node), like), *arrays, pa.array(g), pa.array(h), pa.array(count.astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, ["cohort", "node", "f", "b", "g", "h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, losses, like = {}, {}, None
        for batch in batches:
            like = batch.column("cohort").type
            for cohort, x, y, valid, score, tree in _opened(batch, n, kind, depth, level > 0):
                key = cohort.as_py()
                g, h, lost = _derived(score - y, loss)
                if not level:
                    found = losses.setdefault(key, np.zeros((2, 2)))
                    found[0] += np.bincount(valid, lost, 2)
                    found[1] += np.bincount(valid, minlength=2)
                if not grows:
                    continue
                node = _reached(x, tree, level) - (1 << level)
                on = np.flatnonzero(~valid & (node >= 0) & (node < 1 << level))
                x, g, h, node = x[:, on], g[on], h[on], node[on] * n
                cells = sums.setdefault(key, np.zeros((3, size)))
                for f in range(n):
                    at = (node + f) * bins + x[f]
                    count = np.bincount(at, minlength=size)
                    cells[0] += np.bincount(at, g, size)
                    cells[1] += count if loss == "squared" else np.bincount(at, h, size)
                    cells[2] += count
                if (len(sums) + 1) * 24 * size > SUMS or len(losses) > SUMS // 1000:
                    yield from handed(sums, losses, like)
                    sums, losses = {}, {}
        if like is not None:
            yield from handed(sums, losses, like)

    out = blocks.mapInArrow(run, f"cohort {_cohort_type(blocks)}, node int, f int, b int, g double, h double, n bigint")
    return out.groupBy("cohort", "node", "f", "b").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])


def _best(cells: dict[str, np.ndarray], n: int, bins: int, lam: float, least: int, rate: float) -> dict[int, dict]:
    """node -> the best split of each node of a level, if any has a gain."""
    nodes, place = np.unique(cells["node"], return_inverse=True)
    left = np.zeros((3, len(nodes), n, bins))
    for i, c in enumerate("ghn"):
        left[i][place, cells["f"], cells["b"]] = cells[c]
    there = left[2] > 0
    left = left.cumsum(axis=3)
    total = left[..., -1:]
    right = total - left
    (gl, hl, nl), (gr, hr, nr), (gt, ht, _) = left, right, total
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - gt * gt / (ht + lam)
        able = there & (nl >= least) & (nr >= least) & (gain > 1e-9)
        # equal gains of different features differ in their last bits: nine digits of the gain count, then the feature, then the bin
        unit = 10.0 ** (np.floor(np.log10(np.where(able, gain, 1.0))) - 8)
        gain = np.where(able, np.floor(gain / unit + 0.5) * unit, 0.0).reshape(len(nodes), -1)
        low, high = -rate * gl / (hl + lam), -rate * gr / (hr + lam)
    found = {}
    for k, at in enumerate(gain.argmax(axis=1)):
        if gain[k, at] > 0:
            f, b = divmod(int(at), bins)
            found[int(nodes[k])] = {"f": f, "b": b, "low": float(low[k, f, b]), "high": float(high[k, f, b])}
    return found


def _staged(df: DataFrame) -> DataFrame:
    return files.write_and_read(df, "parquet", [])


def fit(df: DataFrame, features: list[str], label: str, cohort: str, valid: Column | None = None, rounds: int = 20, depth: int = 4, rate: float = 0.3, bins: int = 32, lam: float = 1.0, least: int = 5, loss: str = "squared", patience: int = 5, stage_every: int = 4, written: bool = False) -> Trees:
    """Trees for every cohort of df's rows that have a label.

    valid marks the rows that choose the number of rounds (null and false: training); a cohort without such rows keeps all
    rounds, one whose validation loss hasn't fallen for `patience` rounds takes no further part, and the rounds up to its
    least validation loss count (of equal ones the first). A cohort without training rows has no trees. Null features are
    with the least values; constant ones are never split at; a null cohort is left out. An empty table gives no trees.
    df is read twice and written before, unless it is a written table already.
    """
    if loss not in ("squared", "asymmetric"):
        raise ValueError(f"unknown loss {loss}")
    names = tuple(features)
    n = len(names)
    is_valid = F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(False)
    rows = df.where(F.col(label).isNotNull() & F.col(cohort).isNotNull())
    rows = rows.select(F.col(cohort).alias("cohort"), F.col(label).cast("double").alias("y"), is_valid.alias("valid"), *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(names)])
    table = rows if written else _staged(rows)
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    ends = [F.coalesce(F.array_distinct(F.percentile_approx(F.nanvl(f"x{i}", F.lit(None)), shares, F.lit(100 * bins))), F.array().cast("array<double>")) for i in range(n)]
    known = _staged(table.where(~F.col("valid")).groupBy("cohort").agg(F.array(*ends).alias("edges"), F.avg("y").alias("base")))
    cohorts = known.count()
    shared = F.broadcast if cohorts <= FEW else (lambda one: one)
    blocks = _staged(_blocks(_packed(table, n).join(shared(known), "cohort"), bins))
    if not written:
        files.drop_written(table)
    state = _staged(known.select("cohort", F.array().cast(f"array<map<int, {_SPLIT}>>").alias("trees"), F.array().cast("array<struct<round: int, train_loss: double, valid_loss: double>>").alias("losses"), F.lit(True).alias("active")))

    def with_trees(since: int) -> DataFrame:
        recent = F.slice("trees", since + 1, F.greatest(F.size("trees") - since, F.lit(0)))
        return blocks.join(shared(state.where("active").select("cohort", recent.alias("trees"))), "cohort")

    def levelled(since: int, k: int, level: int, grows: bool = True) -> DataFrame:
        """The cohorts after one more level of round k; at level 0 the losses of the round before come first."""

        def grown(cells: pa.Table, one: pa.Table) -> pa.Table:
            if not cells.num_rows:
                return one
            own, of = one.to_pylist()[0], {c: cells.column(c).to_numpy() for c in ("node", "f", "b", "g", "h", "n")}
            if not level:
                lost = {int(b): float(g / m) for f, b, g, m in zip(of["f"], of["b"], of["g"], of["n"]) if f < 0}
                own["losses"].append({"round": k - 1, "train_loss": lost.get(0), "valid_loss": lost.get(1)})
                marks = [x["valid_loss"] for x in own["losses"]]
                own["active"] = marks[0] is None or k - 1 - marks.index(min(marks)) < max(patience, 1 if k == 1 else 0)
            if grows and own["active"]:
                trees = own["trees"] if level else [*own["trees"], []]
                found = _best({c: v[of["f"] >= 0] for c, v in of.items()}, n, bins, lam, least, rate)
                own["trees"] = [*trees[:-1], [*trees[-1], *found.items()]]
            return pa.Table.from_pylist([own], schema=one.schema)

        cells = _cells(with_trees(since), n, bins, level, depth, loss, grows)
        return _staged(cells.groupBy("cohort").cogroup(state.groupBy("cohort")).applyInArrow(grown, state.schema))

    def rescored(since: int) -> DataFrame:
        kind = np.min_scalar_type(bins)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                scores = [score.tobytes() for *_, score, _ in _opened(batch, n, kind, depth, False)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("cohort", "bins", "y", "valid")], pa.array(scores, pa.binary())], ["cohort", "bins", "y", "valid", "score"])

        return _staged(with_trees(since).mapInArrow(run, blocks.schema))

    since, alive = 0, cohorts > 0 and n > 0
    for k in range(1, rounds + 2) if cohorts else []:
        last = k > rounds or not n
        for level in range(depth if not last else 1):
            fresh = levelled(since, k, level, not last)
            files.drop_written(state)
            state = fresh
            alive = not last and (level > 0 or k == 1 or valid is None or not state.where("active").isEmpty())
            if not alive:
                break
        if not alive:
            break
        if k - since >= stage_every and k < rounds:
            fresh = rescored(since)
            files.drop_written(blocks)
            blocks, since = fresh, k
    files.drop_written(blocks)
    seen = state.select("cohort", F.inline("losses"))
    best = seen.groupBy("cohort").agg(F.when(F.count("valid_loss") == 0, F.max("round")).otherwise(F.min_by("round", F.struct(F.coalesce("valid_loss", F.lit(float("inf"))), "round"))).alias("best"))
    history = _staged(seen.join(best, "cohort").select("cohort", "round", "train_loss", "valid_loss", (F.col("round") <= F.col("best")).alias("kept")))
    used = F.filter(F.slice("trees", 1, F.least(F.coalesce("best", F.lit(0)), F.size("trees"))), lambda t: F.size(t) > 0)
    trees = known.select("cohort", "base").join(state, "cohort").join(best, "cohort", "left").select("cohort", "base", used.alias("trees"))
    return Trees(known.select("cohort", "edges"), _staged(trees), history, names, cohort, depth)


def predict(df: DataFrame, model: Trees, name: str = "pred") -> DataFrame:
    """df with the score of its cohort's trees; rows of cohorts that have none are left out."""
    both = files.written_small(model.trees.join(model.edges, "cohort"), FEW).select(F.col("cohort").alias(model.cohort), F.struct("base", "trees").alias("__m"), "edges")
    rows = _binned(df, both, model.features, model.cohort)
    return rows.withColumn(name, F.col("__m.base") + _score(F.col("__m.trees"), F.col("__bins"), model.depth)).drop("__m", "__bins")
