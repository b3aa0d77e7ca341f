"""Benchmark decontamination: occurrences of benchmark word windows in documents.

The benchmark's windows become a set that every task gets by broadcast: their hashes in order, and the words' numbers by
which a hit is verified, about 24 bytes a window and the distinct words once. Its text's size is checked first; a benchmark
beyond the limit is taken in blocks of at most that size, one after the other, each scanned over all documents. A task
turns a document's words into the numbers of known benchmark words; only runs of known words as long as a window are looked
up, and all words are compared, so a hit is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import staged

#: Bytes of benchmark text whose windows are broadcast at once, at most: a set of some 100 MB.
BLOCK_BYTES = 16 << 20
WINDOW = 13
#: Bytes that are word characters, lower-cased; all others become blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def folded(text: str | None) -> bytes:
    """The text's UTF-8 bytes, as long as before, with A-Z lowered and everything between words blank."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)


def _hashes(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Of the n numbers from each start on."""
    h = np.zeros(len(starts), np.uint64)
    for k in range(n):
        h = (h ^ ids[starts + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class WindowSet:
    """All windows of some benchmark items, by their length."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        self.names: list[str] = []
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item, text in items:
            words = folded(text).split()
            if words:
                ids = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int32)
                found.setdefault(min(window, len(ids)), []).append((len(self.names), ids))
                self.names.append("" if item is None else str(item))
        self.by_length = {}
        for n, some in found.items():
            ids = np.concatenate([x for _, x in some])
            first = np.cumsum([0] + [len(x) for _, x in some[:-1]])
            starts = np.concatenate([f + np.arange(len(x) - n + 1) for f, (_, x) in zip(first, some, strict=True)])
            owner = np.repeat([k for k, _ in some], [len(x) - n + 1 for _, x in some])
            h = _hashes(ids, starts, n)
            order = np.argsort(h, kind="stable")
            self.by_length[n] = (h[order], starts[order].astype(np.int32), owner[order].astype(np.int32), ids)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit (None: none), and the items with an occurring window."""
        number = self.number
        ids = np.array([number.get(w, 0) for w in words], np.int32)
        gaps = np.concatenate([[-1], np.flatnonzero(ids == 0), [len(ids)]])
        runs = np.diff(gaps) - 1
        hit, items = None, set()
        for n, (known, where, owner, theirs) in self.by_length.items():
            long = np.flatnonzero(runs >= n)
            if not len(long):
                continue
            starts = np.concatenate([np.arange(gaps[g] + 1, gaps[g + 1] - n + 1) for g in long])
            h = _hashes(ids, starts, n)
            low, high = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            for i in np.flatnonzero(low < high):
                s = starts[i]
                mine = ids[s : s + n]
                for j in range(low[i], high[i]):
                    if np.array_equal(theirs[where[j] : where[j] + n], mine):
                        hit = np.zeros(len(ids), bool) if hit is None else hit
                        hit[s : s + n] = True
                        items.add(self.names[owner[j]])
        return hit, items


def window_sets(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """Broadcast window sets that hold all items, each of about block_bytes of text at most (or one larger item), one at a
    time: a set is built when it is asked for."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for k in range(n):
        yield spark.sparkContext.broadcast(WindowSet([tuple(r) for r in items.where(block == k).collect()], window)), k == n - 1


def _intervals(hit: np.ndarray | None) -> list[int]:
    """Starts and ends of the runs of hit words, alternating."""
    return [] if hit is None else np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def _scan(batches, one):
    """Adds (n_words, spans, items) to batches whose first three columns aren't these."""
    for b in batches:
        n_words, spans, items = [], [], []
        at_text, at_spans, at_items = (b.schema.get_field_index(c) for c in ("__text", "__spans", "__items"))
        for text, s, it in zip(b.column(at_text), b.column(at_spans).to_pylist(), b.column(at_items).to_pylist(), strict=True):
            words = folded(text.as_py()).split()
            it = set(it)
            hit, found = one.value.scan(words)
            it |= found
            if s:
                hit = np.zeros(len(words), bool) if hit is None else hit
                for start, end in zip(s[::2], s[1::2], strict=True):
                    hit[start:end] = True
            n_words.append(len(words))
            spans.append(_intervals(hit))
            items.append(sorted(it))
        columns = [b.column(i) for i in range(b.num_columns) if i not in (at_spans, at_items)] + [pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))]
        names = [n for n in b.schema.names if n not in ("__spans", "__items")] + ["__spans", "__items"]
        at = names.index("__n_words")
        columns[at] = pa.array(n_words, pa.int64())
        yield pa.record_batch(columns, names=names)


def _hits(docs: DataFrame, benchmark: DataFrame, text_col: str, window: int, block_bytes: int) -> DataFrame:
    """docs' columns as c0, c1 ... with __text, __n_words, __spans (word numbers), __items."""
    out = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(f"`{text_col}`").cast("string").alias("__text"), F.lit(0).cast("long").alias("__n_words"), F.expr("cast(array() as array<bigint>)").alias("__spans"), F.expr("cast(array() as array<string>)").alias("__items"))
    for one, last in window_sets(benchmark, window=window, block_bytes=block_bytes):
        out = out.mapInArrow(lambda it, one=one: _scan(it, one), out.schema)
        if not last:
            out = staged(out, "hits")
            one.unpersist()
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id_col, n_words, n_hit, n_items, items, contaminated): one row per row of docs.

    A window is `window` consecutive words of an item, or all of a shorter item's. Null and empty texts have no words and
    aren't contaminated; items without words have no window; a null item id is listed as the empty string. Repeated rows
    come back repeated; other columns aren't read; an empty benchmark hits nothing. Contaminated: at least one word in
    twenty is hit.
    """
    found = _hits(docs.select(id_col, text_col), benchmark, text_col, window, block_bytes)
    n_hit = F.expr("aggregate(transform(__spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)")
    out = found.select(F.col("c0").alias(id_col), F.col("__n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("__items").cast("long").alias("n_items"), F.col("__items").alias("items"))
    return out.withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def items_digest(items):
    """Lower-case hex SHA-256 of the item ids, in order as strings, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "documents", text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without contaminated documents (action 'documents'), or with the hit words cut out of all texts ('spans').

    All columns of docs stay, whatever their names. A cut goes from the first hit word's first to the last hit word's last
    character. Null texts stay null.
    """
    if action not in ("documents", "spans"):
        raise ValueError("action is 'documents' or 'spans'")
    found = _hits(docs, benchmark, text_col, window, block_bytes)
    if action == "documents":
        n_hit = F.expr("aggregate(transform(__spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)")
        found = found.where(~((n_hit > 0) & (20 * n_hit >= F.col("__n_words"))))
        return found.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])

    def cut(it):
        for b in it:
            texts = []
            for text, spans in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                text = text.as_py()
                if text is not None and spans:
                    raw, flat = text.encode("utf-8", "surrogatepass"), folded(text)
                    places, at = [], 0
                    for w in flat.split():
                        at = flat.index(w, at)
                        places.append((at, at + len(w)))
                        at += len(w)
                    out, last = [], 0
                    for s, e in zip(spans[::2], spans[1::2], strict=True):
                        out.append(raw[last : places[s][0]])
                        last = places[e - 1][1]
                    text = b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")
                texts.append(text)
            yield pa.record_batch([pa.array(texts, pa.string()), *b.columns[2:]], names=["__text", *b.schema.names[2:]])

    rest = [f"c{i}" for i in range(len(docs.columns))]
    kinds = ", ".join(["__text string", *[f"{r} {docs.schema[c].dataType.simpleString()}" for r, c in zip(rest, docs.columns, strict=True)]])
    done = found.select("__text", "__spans", *rest).mapInArrow(cut, kinds)
    return done.select(*[(F.col("__text") if c == text_col else F.col(r)).alias(c) for r, c in zip(rest, docs.columns, strict=True)])


def digest_of(items: list[str]) -> str:
    """The same digest in Python."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
