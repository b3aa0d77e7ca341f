"""Spelling variants: frequent words that differ by one edit, found by blocked Gram matrices of their letter counts.

A word is a vector of letter counts, with the squared distance x.x + y.y - 2 x.y to another word. One inserted or deleted
letter makes it 1, one replaced letter 2, so pairs of a squared distance over two are never near. The words are put into
blocks by their length, cut finer by how many letters each of eight fixed letter groups has: an edit moves a word by at
most one in each of at most two groups, so a word is compared with its own block and with the blocks next to it, half of
which it visits while the other half visits it. A block is one matrix, its visitors another; the product of both gives all
distances, and only pairs at one or two are compared letter by letter. Blocks over `BLOCK` words are dealt in parts, each
of which is visited on its own, and visitors stream by, so a task holds at most one part and one batch of visitors.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import drop_staged, staged

#: A word: letters of ASCII and Latin-1, after A-Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
UPPER = "[A-Za-zÀ-ÿ]"
#: One letter of a run is deleted where this divides the checksum.
ERROR_RATE = 199
#: Letter groups of a block's key; eight counts of a byte each make a long.
GROUPS = 8
#: Words of a block, or part of one, that a task holds at once.
BLOCK = 2048
#: Visitors that are multiplied with a block at once.
VISITORS = 4096
#: Distinct words that a counting task keeps before it hands them on, and their characters.
HELD, HELD_CHARS = 300_000, 16 << 20
LETTERS = 26 + 64

_COLUMN = np.full(256, 0, np.int64)
_COLUMN[ord("a") : ord("z") + 1] = np.arange(26)
_COLUMN[0xC0:0x100] = 26 + np.arange(64)


def _steps() -> np.ndarray:
    """What an edit can do to the counts of the letter groups, one of each two opposite steps; no step is left out."""
    unit = np.eye(GROUPS, dtype=np.int64)
    all_ = [*unit, *(-unit), *(unit[i] - unit[j] for i, j in itertools.permutations(range(GROUPS), 2))]
    return np.array([s for s in all_ if next(x for x in s if x) > 0])


STEPS = _steps()


def runs_of(doc_id: str, text: str | None) -> Counter:
    """How often each word occurs in a text, one letter deleted where the checksum says so."""
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    text = (text or "").encode("utf-8", "replace").lower().decode()  # of bytes, lower() only turns A-Z
    for word, n in Counter(RUN.findall(text)).items():
        h = zlib.crc32(word.encode(), start)
        if h % ERROR_RATE == 0:
            k = h % len(word)
            word = word[:k] + word[k + 1 :]
        out[word] += n
    return out


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n): the words of all texts with at least `shortest` letters and `least` occurrences. Null texts have none."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def out(held):
        words = list(held)
        for i in range(0, len(words), 50_000):
            some = words[i : i + 50_000]
            yield pa.record_batch([pa.array(some, pa.string()), pa.array([held[w] for w in some], pa.int64())], schema=schema)

    def run(it):
        held, chars = Counter(), 0
        for b in it:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for word, n in runs_of(doc_id, text.as_py()).items():
                    if len(word) >= shortest:
                        chars += len(word) if word not in held else 0
                        held[word] += n
                if len(held) > HELD or chars > HELD_CHARS:
                    yield from out(held)
                    held, chars = Counter(), 0
        yield from out(held)

    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts a word; in doubles, which hold the products exactly up to 2**53, where singles wouldn't do."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    rows = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    counts = np.bincount(rows * LETTERS + _COLUMN[raw], minlength=len(words) * LETTERS).reshape(-1, LETTERS)
    return counts.astype(np.float32 if len(words) == 0 or counts.max() < 256 else np.float64)


def block_keys(words: list[str]) -> np.ndarray:
    """(words, 1 + len(STEPS)) longs: a word's own block, and the blocks that it visits.

    A byte a group, modulo 256: longer words may share a block with others, which costs comparisons and loses none.
    """
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    rows = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    groups = np.bincount(rows * GROUPS + raw % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    moved = groups[:, None, :] + np.concatenate([np.zeros((1, GROUPS), np.int64), STEPS])[None]
    return np.ascontiguousarray(moved.astype(np.uint8)).view(np.int64)[:, :, 0]


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter inserted, deleted or replaced turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


class _Tally:
    """Per word of a block: how many near words it met, and the best of them (most frequent, then first by code points)."""

    def __init__(self, words: list[str], counts: list[int]):
        self.words, self.counts, self.letters = words, counts, letter_counts(words)
        self.norms = (self.letters.astype(np.float64) ** 2).sum(axis=1)
        self.met: dict[int, list] = {}

    def add(self, i: int, word: str, n: int) -> None:
        seen = self.met.get(i)
        if seen is None:
            self.met[i] = [1, n, word]
        else:
            seen[0] += 1
            if (-n, word) < (-seen[1], seen[2]):
                seen[1:] = n, word

    def rows(self):
        return [(self.words[i], *m) for i, m in self.met.items()]


def meet(a: _Tally, b: _Tally) -> None:
    """Compares all words of a with all of b (a is b: each two once) by one product of their letter counts."""
    used = np.flatnonzero(b.letters.any(axis=0))
    product = (a.letters[:, used] @ b.letters[:, used].T).astype(np.float64 if a.letters.dtype == np.float64 or b.letters.dtype == np.float64 else np.float32, copy=False)
    product *= -2
    product += a.norms[:, None].astype(product.dtype)
    product += b.norms[None].astype(product.dtype)
    near = (product > 0.5) & (product < 2.5)
    for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
        if (a is not b or i < j) and one_edit(a.words[i], b.words[j]):
            a.add(i, b.words[j], b.counts[j])
            b.add(j, a.words[i], a.counts[i])


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best_n, best): for words that have any near word, how many, and the most frequent one.

    words: distinct words of letters, with their counts n. Of equally frequent near words the first by code points.
    """
    # a few small files of words would make few, large tasks of them
    dealt = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = pa.schema([("key", pa.int64()), ("role", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def keys(it):
        for b in it:
            for k in range(0, b.num_rows, 2000):
                some = b.slice(k, 2000)
                found = block_keys(some.column(0).to_pylist())
                rows = np.repeat(np.arange(found.shape[0]), found.shape[1])
                role = np.minimum(np.tile(np.arange(found.shape[1]), found.shape[0]), 1).astype(np.int32)
                yield pa.record_batch([pa.array(found.ravel()), pa.array(role), some.column(0).take(pa.array(rows)), some.column(1).take(pa.array(rows))], schema=keyed)

    rows = words.select("word", "n").repartition(dealt, "word").mapInArrow(keys, "key long, role int, word string, n long")
    own = words.select("word").mapInArrow(lambda it: (pa.record_batch([pa.array(block_keys(b.column(0).to_pylist())[:, 0])], names=["key"]) for b in it if b.num_rows), "key long")
    large = staged(own.groupBy("key").count().where(F.col("count") > block).select("key", F.ceil(F.col("count") / block).cast("int").alias("parts")), "blocks")
    if large.isEmpty():
        rows = rows.withColumn("part", F.lit(0))
    else:
        rows = rows.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        rows = rows.withColumn("own", F.expr("if(role = 0, pmod(xxhash64(word), parts), -1)").cast("int"))
        rows = rows.withColumn("part", F.explode(F.expr("sequence(greatest(own, 0), parts - 1)"))).withColumn("role", F.expr("if(part = own, 0, 1)"))
    rows = rows.select("key", "part", "role", "word", "n").repartition(dealt * 4, "key", "part").sortWithinPartitions("key", "part", "role", "word")
    found = pa.schema([("word", pa.string()), ("met", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def batch(tallies):
        got = [r for t in tallies for r in t.rows()]
        if got:
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*got, strict=True), found, strict=True)], schema=found)

    def scan(it):
        at, residents, waiting, visits = None, None, [], 0

        def settle():
            if residents is not None:
                meet(residents, residents)
                return batch([residents])
            return ()

        for b in it:
            key, part, role = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in itertools.pairwise([0, *edges.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                if at != (key[lo], part[lo]):
                    if waiting:
                        residents = _Tally(*map(list, zip(*waiting, strict=True)))
                    yield from settle()
                    at, residents, waiting = (key[lo], part[lo]), None, []
                if role[lo] == 0:  # a block may go on in the next batch
                    waiting += zip(b.column(3).slice(lo, hi - lo).to_pylist(), b.column(4).slice(lo, hi - lo).to_pylist(), strict=True)
                    continue
                if waiting:
                    residents, waiting = _Tally(*map(list, zip(*waiting, strict=True))), []
                if residents is None:
                    continue  # nobody lives there
                for k in range(lo, hi, VISITORS):
                    some = min(VISITORS, hi - k)
                    visitors = _Tally(b.column(3).slice(k, some).to_pylist(), b.column(4).slice(k, some).to_pylist())
                    meet(visitors, residents)
                    yield from batch([visitors])
        if waiting:
            residents = _Tally(*map(list, zip(*waiting, strict=True)))
        yield from settle()

    met = rows.mapInArrow(scan, "word string, met long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w")))
    return met.groupBy("word").agg(F.sum("met").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form) rows without cycles: the last word that forms lead to. Each round doubles the way."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = staged(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        drop_staged(now)
        now = after
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 6, least: int = 5, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per frequent word of the texts, each word's near words being those
    that one inserted, deleted or replaced letter away.

    form is the most frequent near word (ties: the first by code points) if it is at least `ratio` times as frequent, else
    null; root is the end of the way from form to form. Null and empty texts have no words; a null id counts as an empty
    one in the checksum; repeated rows count again. Other columns of docs are not read. An empty table gives no rows.
    """
    words = staged(word_counts(docs, id_col, text_col, shortest, least), "words")
    near = staged(near_words(words, block), "near")
    joined = words.join(near, "word", "left")
    good = F.col("best_n") >= ratio * F.col("n")
    rows = staged(joined.select("word", F.when(good, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(rows.where("form is not null").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def normalised(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id_col, at, word, root): every word of every text that has another root, and its number in the text (from 0).

    Words are compared as they stand in the text (A-Z lower-cased); nulls have none.
    """
    changed = found.where("root != word").select(F.col("word").alias("__w"), "root")
    lower = F.expr(f"translate({text_col}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
    words = docs.select(F.col(id_col), F.posexplode(F.regexp_extract_all(lower, F.lit(f"({UPPER}+)"), 1)).alias("at", "word"))
    return words.join(changed, F.col("word") == F.col("__w")).select(id_col, "at", "word", "root")
