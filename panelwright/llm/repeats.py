"""Removal of byte strings that occur again, by a radix sort of all suffixes down to a fixed depth.

The suffixes' first `length` bytes are told apart digit by digit, most significant digit first, and a suffix leaves the
sort as soon as its group has no other member or is known to agree in all digits; the groups that are equal to the full
depth are exactly the repeated strings. So that neighbouring suffixes travel as one row, the digits are taken in the
order that makes them agree longest:

1. the suffix's sampled gram (of its grams the one with the least hash) and its place: a run of neighbouring suffixes
   shares it, and one row carries the run;
2. all bytes that the run's suffixes cover: where these agree, all suffixes of the run agree;
3. for the rest, blocks of a few suffixes: first the bytes that all have in common, then all bytes they cover;
4. for the rest, single suffixes.

A class of equal rows goes on as a single member, so a group of thousands of copies costs the later passes one row.
Digits are compared as 64-bit hashes, two independent ones at full depth.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import drop_staged, staged

GRAM = 32
BLOCK = 8
#: Suffixes handled at once in a task.
CHUNK = 1 << 20
U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(29))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


_BYTES = [_mix(np.arange(1, 257, dtype=np.uint64) * U(c)) for c in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)]


class Powers:
    """Powers of a base and of its inverse modulo 2**64, up to a growing length."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = U(base), U(pow(base, -1, 1 << 64)), 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n, 1 << 14)
            self.up, self.down = (np.cumprod(np.concatenate([[U(1)], np.full(self.n, b, np.uint64)])) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS = [Powers(b) for b in _BASES]


class Hashes:
    """Hashes of any substrings of some bytes, in constant time each."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = _POWERS[which].upto(len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[which][data] * up[: len(data)])])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])


def _salted(h: np.ndarray, *more) -> np.ndarray:
    for m in more:
        h = _mix(h ^ (np.asarray(m).astype(np.uint64) + U(0x632BE59BD9B4E019)))
    return h


def runs_of(data: np.ndarray, length: int, gram: int):
    """(core, span, lo, n, off) of the runs of suffixes that share their sampled gram, off being the gram's place from lo."""
    wide = length - gram + 1
    for first in range(0, len(data) - length + 1, CHUNK):
        part = data[first : first + CHUNK + length - 1]
        h = Hashes(part)
        at = np.arange(len(part) - gram + 1)
        g = h.of(at, at + gram)
        least, size = (g >> U(22) << U(22)) | at.astype(np.uint64), 1
        while 2 * size <= wide:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < wide:
            least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
        a = (least & U((1 << 22) - 1)).astype(np.int64)
        lo = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        n = np.diff(np.concatenate([lo, [len(a)]]))
        off = a[lo] - lo
        core = g[a[lo]]
        yield core, _salted(h.of(lo, lo + n - 1 + length), n, off), lo + first, n, off


def blocks_of(data: np.ndarray, runs: np.ndarray, length: int, gram: int, block: int):
    """The same for blocks of suffixes of the given runs (rows of lo, n, off); off is then 0."""
    h = Hashes(data)
    lo, n, off = runs.T
    anchor = lo + off
    first, last = (off - n + 1) // block, off // block  # by distance from the gram, so that blocks of equal runs agree
    many = last - first + 1
    i = np.repeat(np.arange(len(lo)), many)
    j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + first[i]
    start = np.maximum(anchor[i] - (j * block + block - 1), lo[i])
    end = np.minimum(anchor[i] - j * block, lo[i] + n[i] - 1)
    inner, outer = anchor[i] - j * block, anchor[i] - (j * block + block - 1) + length
    core = _salted(h.of(inner, outer), h.of(anchor[i], anchor[i] + gram), j + (1 << 20))
    return core, _salted(h.of(start, end + length), end - start, anchor[i] - start + (1 << 20)), start, end - start + 1, np.zeros(len(i), np.int64)


def suffixes_of(data: np.ndarray, blocks: np.ndarray, length: int):
    """The same for the single suffixes of the given blocks; core and span are two independent hashes of all bytes."""
    lo, n = blocks[:, 0], blocks[:, 1]
    p = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return Hashes(data, 1).of(p, p + length), Hashes(data).of(p, p + length), p, np.ones(len(p), np.int64), np.zeros(len(p), np.int64)


ROW = "core long, span long, uid long, lo long, size int"


def _rows(uid: int, found) -> pa.RecordBatch:
    core, span, lo, n, off = found
    return pa.record_batch(
        [pa.array(core.astype(np.int64)), pa.array(span.astype(np.int64)), pa.array(np.full(len(lo), uid, np.int64)), pa.array(lo.astype(np.int64)), pa.array((n * 256 + off).astype(np.int32))],
        names=["core", "span", "uid", "lo", "size"],
    )


def _bytes(value) -> np.ndarray:
    """A text's bytes without a copy."""
    raw = value.as_buffer() if value.is_valid else None
    return np.frombuffer(raw, np.uint8) if raw is not None and len(raw) else np.zeros(0, np.uint8)


def _gathered(batches, least: int = 1 << 16):
    """Fewer, larger batches."""
    rest, size = [], 0
    for b in batches:
        rest.append(b)
        size += b.num_rows
        if size >= least:
            yield from pa.Table.from_batches(rest).combine_chunks().to_batches()
            rest, size = [], 0
    if rest:
        yield from pa.Table.from_batches(rest).combine_chunks().to_batches()


def _classes(rows: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(resolved, open): rows that agree in all bytes they cover with another row; and one member of each class that
    shares its core with another class."""
    resolved_of = lambda classes: classes.where("n > 1").select("core", "span")
    agg = rows.groupBy("core", "span").agg(F.count("*").alias("n"), F.min(F.struct("uid", "lo", "size")).alias("one"))
    if last:
        spans = staged(rows.groupBy("core", "span").agg(F.count("*").alias("n")).where("n > 1").select("core", "span"), "classes")
        return staged(rows.join(spans, ["core", "span"], "left_semi").select("uid", "lo", "size"), "resolved"), None
    classes = staged(agg.select("core", "span", "n", "one.*"), "classes")
    shared = classes.groupBy("core").agg(F.count("*").alias("c")).where("c > 1").select("core")
    left = staged(classes.join(shared, "core", "left_semi").select("uid", "lo", "size"), "open")
    resolved = staged(rows.join(resolved_of(classes), ["core", "span"], "left_semi").select("uid", "lo", "size"), "resolved")
    drop_staged(classes)
    return resolved, left


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(uid, id, text) with a uid of its own for each row: the id if it is one, else a number given once."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    rows, known = ids.agg(F.count("*"), F.count("id")).first()
    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    if rows == known and ids.groupBy("id").count().where("count > 1").isEmpty():
        return out.select(F.col("id").alias("uid"), "id", "text")
    return staged(out.select(F.monotonically_increasing_id().alias("uid"), "id", "text"), "texts")


def repeated_runs(texts: DataFrame, length: int = 200, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """(uid, lo, n) for texts (uid, text): the suffixes lo ... lo + n - 1 start strings that also start anywhere else."""

    def first(it):
        for b in it:
            for uid, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                data = _bytes(text)
                if len(data) >= length:
                    for found in runs_of(data, length, gram):
                        yield _rows(uid, found)

    def again(cut):
        def run(it):
            for b in it:
                for uid, text, runs in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                    at = np.sort(runs.values.to_numpy(zero_copy_only=False))
                    lo, size = at >> 16, at & 0xFFFF
                    yield _rows(uid, cut(_bytes(text), np.stack([lo, size >> 8, size & 255], axis=1)))

        return lambda it: _gathered(run(it))

    def visit(open_, cut):
        packed = open_.groupBy("uid").agg(F.collect_list(F.expr("lo * 65536 + size")).alias("runs"))
        return staged(texts.select("uid", "text").join(packed, "uid").select("uid", "text", "runs").mapInArrow(again(cut), ROW), "rows")

    rows = staged(texts.select("uid", "text").mapInArrow(lambda it: _gathered(first(it)), ROW), "rows")
    found, open_ = _classes(rows)
    drop_staged(rows)
    rows = visit(open_, lambda data, runs: blocks_of(data, runs, length, gram, block))
    more, open_ = _classes(rows)
    drop_staged(rows)
    rows = visit(open_, lambda data, runs: suffixes_of(data, runs, length))
    last, _ = _classes(rows, last=True)
    drop_staged(rows)
    return found.union(more).union(last).select("uid", "lo", F.expr("shiftright(size, 8)").alias("n"))


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", kept_bytes: bool = False) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256[, kept]): one row per row of docs.

    Each byte covered by a string of `length` bytes that also starts anywhere else, in the same document or another, is
    removed; strings are judged on the input. Null texts are empty, and repeated rows are copies of each other like any
    others. Null ids are kept. Other columns aren't read; an empty table gives no rows. kept is the rest as bytes: a cut
    may fall inside a character.
    """
    if not GRAM <= length <= 255:
        raise ValueError(f"length is from {GRAM} to 255")
    texts = _texts(docs, id_col, text_col)
    runs = repeated_runs(texts, length).groupBy("uid").agg(F.collect_list(F.expr("lo * 256 + n")).alias("runs"))
    kind = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept_bytes

    def cut(it):
        for b in it:
            rows, kept = [], []
            for text, runs in zip(b.column(1), b.column(2), strict=True):
                data = _bytes(text)
                if not runs.is_valid:
                    rows.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    kept.append(data.tobytes() if kept_bytes else None)
                    continue
                at = np.sort(runs.values.to_numpy(zero_copy_only=False))
                lo, end = at >> 8, (at >> 8) + (at & 255) - 1 + length
                reach = np.maximum.accumulate(end)
                new = np.concatenate([[True], lo[1:] > reach[:-1]])
                starts, ends = lo[new], reach[np.concatenate([new[1:], [True]])]
                rest = b"".join(data[s:e].tobytes() for s, e in zip(np.concatenate([[0], ends]), np.concatenate([starts, [len(data)]]), strict=True))
                rows.append((len(data), int((ends - starts).sum()), len(starts), hashlib.sha256(rest).hexdigest()))
                kept.append(rest if kept_bytes else None)
            columns = [b.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))]
            if rows:
                yield pa.record_batch(columns + [pa.array(kept, pa.binary())] * kept_bytes, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * kept_bytes)

    out = texts.join(runs, "uid", "left").select("id", "text", "runs").mapInArrow(cut, kind)
    return out.withColumnRenamed("id", id_col)
