"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in an order drawn by hash, are cut into blocks. Of share w = its weight over all weights, its block i
is released at slot floor(i / w) and due by slot ceil((i + 1) / w); at each slot the released block with the earliest
deadline comes next. So at any slot each source has had its share to less than one block. Weights are exact fractions, a
float being taken as it is written (0.1 is a tenth). With whole numbers a of sum A in their place, all windows fall
together again after A slots, so one cycle of A slots is worked out and later slots follow by arithmetic. When a source
has no block left, the others share the slots by their weights from there on; no document is dropped or repeated.

The plan is made from one row a source in one task, which writes a row a block of one cycle (never more than there are
blocks); from these Spark derives all blocks' slots, in runs of a bounded length over all tasks, and joins them to the
documents by source and block.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import staged

#: Documents in a block, documents that a part of a source's order has on average, blocks that one row of the plan is spread by.
BLOCK, PART_ROWS, RUN = 16, 1_000, 4_096
_PLAN = pa.schema([("source", pa.string()), ("first_block", pa.int64()), ("end_block", pa.int64()), ("step", pa.int64()), ("first_slot", pa.int64()), ("cycle", pa.int64())])


def whole_weights(weights: dict) -> dict:
    """The weights as whole numbers without a common divisor, in the same proportion."""
    exact = {s: Fraction(str(w)) if isinstance(w, float) else Fraction(w) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights are positive")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    divisor = math.gcd(*whole.values())
    return {s: w // divisor for s, w in whole.items()}


def earliest_deadlines(weights: dict) -> Iterator[object]:
    """The source of each slot of one cycle, for whole weights. Of equal deadlines the first source by name comes first."""
    cycle = sum(weights.values())
    done = dict.fromkeys(weights, 0)
    names = sorted(weights)
    release = [(0, k) for k in range(len(names))]
    ready: list[tuple[int, int]] = []
    for t in range(cycle):
        while release and release[0][0] <= t:
            _, k = heapq.heappop(release)
            heapq.heappush(ready, (-(-(done[names[k]] + 1) * cycle // weights[names[k]]), k))
        _, k = heapq.heappop(ready)  # shares sum to 1, so there is always one, and it is in time
        s = names[k]
        done[s] += 1
        heapq.heappush(release, (done[s] * cycle // weights[s], k))
        yield s


def plan(blocks: dict[str, int], weights: dict[str, int]) -> Iterator[tuple]:
    """(source, first block, end block, step, first slot, cycle): blocks first, first + step, ... before the end have slots
    first, first + cycle, ... A row a block of a cycle, for each phase; a phase ends as the first source runs out.
    """
    left, gone, base = {s: n for s, n in blocks.items() if n > 0}, dict.fromkeys(blocks, 0), 0
    while left:
        a = whole_weights({s: weights[s] for s in left})
        cycle, slots = sum(a.values()), {s: [] for s in left}
        last = None
        for t, s in enumerate(earliest_deadlines(a)):
            slots[s].append(t)
            if len(slots[s]) == left[s]:  # it runs out in the first cycle
                last = t
                break
        if last is None:
            last = min((n - 1) // a[s] * cycle + slots[s][(n - 1) % a[s]] for s, n in left.items())
        full, rest = divmod(last + 1, cycle)
        for s in sorted(left):
            n = full * a[s] + sum(t < rest for t in slots[s]) if full else len(slots[s])
            for k, t in enumerate(slots[s][:n]):
                yield s, gone[s] + k, gone[s] + n, a[s], base + t, cycle
            gone[s] += n
            left[s] -= n
        left, base = {s: n for s, n in left.items() if n}, base + last + 1


def _key(source_col: str):
    """The source as a name of its own kind for null."""
    return F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))


def _slots(counts: DataFrame, weights: dict, block: int) -> DataFrame:
    """(source, block, slot) of every block, from (source, n): the documents of each source."""
    named = {"n" if s is None else f"s{s}": str(Fraction(str(w)) if isinstance(w, float) else Fraction(w)) for s, w in weights.items()}

    def run(batches):
        blocks = {s: -(-n // block) for b in batches for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        rows = []
        for row in plan(blocks, {s: Fraction(named.get(s, "1")) for s in blocks}):
            rows.append(row)
            if len(rows) == 50_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PLAN, strict=True)], schema=_PLAN)
                rows = []
        if rows:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PLAN, strict=True)], schema=_PLAN)

    kind = "source string, first_block long, end_block long, step long, first_slot long, cycle long"
    made = staged(counts.coalesce(1).mapInArrow(run, kind), "plan")
    # a source's blocks of one place in the cycle are dealt out in runs, so that no row holds all of them and no task makes them
    last = "(end_block - 1 - first_block) div step"
    runs = made.select("*", F.explode(F.expr(f"sequence(0L, {last}, {RUN}L)")).alias("run")).repartition("source", "first_block", "run")
    every = runs.select("*", F.explode(F.expr(f"sequence(run, least(run + {RUN - 1}L, {last}))")).alias("i"))
    return every.select("source", (F.col("first_block") + F.col("i") * F.col("step")).alias("block"), (F.col("first_slot") + F.col("i") * F.col("cycle")).alias("slot"))


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK, seed: int = 1) -> DataFrame:
    """(row, block, slot, position): each row of docs, as a struct of its columns, and its place in the mixed order.

    weights by source name (None: the null source), as numbers, fractions or floats; absent sources, or all without
    weights, get 1. Positions are unique and ascending by slot, but leave gaps after a source's short last block. Null ids
    are ordered like any other; rows with equal ids are ordered by their other columns, so the order is the same each
    time, and repeated rows take places of their own. Column names may be any. An empty table gives no rows.
    """
    if any(w <= 0 for w in (weights or {}).values()):
        raise ValueError("weights are positive")
    n = len(docs.columns)
    own, source = (f"c{docs.columns.index(c)}" for c in (id_col, source_col))
    rows = docs.toDF(*[f"c{i}" for i in range(n)])
    rows = rows.select(F.struct(*rows.columns).alias("row"), _key(source).alias("source"), F.col(own).alias("id"), F.xxhash64(F.lit(seed), F.col(own)).alias("h"))
    counts = staged(rows.groupBy("source").agg(F.count("*").alias("n")), "counts")
    most = counts.agg(F.max("n")).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, most / PART_ROWS))))
    rows = rows.withColumn("part", F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long"))
    parts = staged(rows.groupBy("source", "part").agg(F.count("*").alias("n")), "parts")  # at most a row a PART_ROWS / 2 rows and source
    upto = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("source", "part").orderBy("h", "id", F.xxhash64("row"), "row"))
    rows = rows.withColumn("place", place).join(parts, ["source", "part"]).withColumn("place", F.col("before") + F.col("place") - 1)
    rows = rows.select("row", "source", "place", F.expr(f"place div {block}").alias("block"))
    rows = rows.join(_slots(counts, weights or {}, block), ["source", "block"])
    return rows.select("row", "block", "slot", F.expr(f"slot * {block} + place % {block}").alias("position"))


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK, seed: int = 1) -> DataFrame:
    """(id_col, source_col, block, slot, position): one row per row of docs, ordered as `mixed` says; other columns aren't
    read, so rows with equal ids and sources are interchangeable here."""
    out = mixed(docs.select(id_col, source_col), weights, id_col, source_col, block, seed)
    return out.select(F.col("row.c0").alias(id_col), F.col("row.c1").alias(source_col), "block", "slot", "position")


def interleaved(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK, seed: int = 1) -> DataFrame:
    """docs, all rows and columns (of any names), sorted into the mixed order: written files hold it, in the order of their
    names. Nulls, repeats and empty tables as `mixed` says."""
    return mixed(docs, weights, id_col, source_col, block, seed).orderBy("position").select("row.*").toDF(*docs.columns)
