"""Periodic runs of words: found in a grammar of the text, each rule once, and carried to all places that the rule makes.

A run is a stretch of words with smallest period q that goes on for at least `LEAST` words and `TIMES` periods, and that no
neighbouring word extends. The words of a text, as numbers, are compressed by Re-Pair: the most frequent pair of
neighbouring symbols becomes a new symbol, until no pair occurs twice; what is left is halved again and again, which gives
rules used once. Every run crosses the boundary of the smallest rule whose words hold it all. So each rule's words are
looked at once: a run over the boundary has two whole periods on one side of it, so candidates are the q whose two periods
next to the boundary are equal (prefix sums of a polynomial hash, all q at once, then word by word). What a rule shows
holds at all places where the rule was made; where a place cuts a run off, another, larger rule shows it whole, and
intervals of one period that overlap by a period are merged.

Words that occur fewer than four times in a text, or next to each other fewer than three times, are in no run together (a
run has four of each word, three of each pair), so they cut a text into pieces first; only pieces of six words or more are
compressed. The work is about n log n for a text of n words and its memory grows with the text, not with the batch.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words and so many periods.
LEAST, TIMES = 6, 4
#: Of the polynomial hash; a hit is compared word by word, so collisions only cost time.
PRIME, BASE = (1 << 31) - 1, 1_000_003
_powers = np.ones(1, np.int64)


def powers(n: int) -> np.ndarray:
    """BASE ** 0 … BASE ** (n - 1) modulo PRIME; the table is kept and doubled as texts grow."""
    global _powers
    while len(_powers) < n:
        step = int(_powers[-1]) * BASE % PRIME
        _powers = np.concatenate([_powers, _powers * step % PRIME])
    return _powers[:n]


def repair(symbols: list[int], new: int) -> tuple[list[int], list[tuple[int, int, list[int]]]]:
    """Re-Pair: (starts of the symbols that are left, rules). Rules are symbols from `new` on.

    A rule is (words of its first half, words, places); a place is the number of the first word in the text.
    """
    n = len(symbols)
    sym, after, before, size = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n
    where: dict[int, list[int]] = defaultdict(list)
    for i in range(n - 1):
        where[sym[i] << 32 | sym[i + 1]].append(i)
    heap = [(-len(v), k) for k, v in where.items() if len(v) > 1]
    heapq.heapify(heap)
    rules: list[tuple[int, int, list[int]]] = []
    while heap:
        claimed, pair = heapq.heappop(heap)
        places = where.pop(pair, None)
        if places is None:
            continue
        a, b = pair >> 32, pair & 0xFFFFFFFF
        places.sort()
        good, last = [], -1
        for p in places:
            if p > last and sym[p] == a and (q := after[p]) < n and sym[q] == b:
                good.append(p)
                last = q
        if len(good) < 2:
            continue
        if len(good) < -claimed and heap and -heap[0][0] > len(good):  # it isn't the most frequent one any more
            where[pair] = good
            heapq.heappush(heap, (-len(good), pair))
            continue
        x, touched = new + len(rules), set()
        rules.append((size[good[0]], size[good[0]] + size[after[good[0]]], good))
        for p in good:
            q = after[p]
            behind, ahead = before[p], after[q]
            size[p] += size[q]
            sym[p], sym[q], after[p] = x, -1, ahead
            if ahead < n:
                before[ahead] = p
                k = x << 32 | sym[ahead]
                where[k].append(p)
                touched.add(k)
            if behind >= 0:
                k = sym[behind] << 32 | x
                where[k].append(behind)
                touched.add(k)
        for k in touched:
            if len(where[k]) > 1:
                heapq.heappush(heap, (-len(where[k]), k))
    starts, p = [], 0
    while p < n:
        starts.append(p)
        p = after[p]
    return starts, rules


def _same(a: np.ndarray, b: np.ndarray) -> int:
    """How many words two stretches have in common from their beginning on."""
    differ = a != b
    i = int(differ.argmax()) if len(differ) else 0
    return i if len(differ) and differ[i] else len(differ)


def _crossing(w: np.ndarray, s: np.ndarray, start: int, mid: int, end: int) -> set[tuple[int, int, int]]:
    """(from, to, period) of the runs of w[start:end] over mid, maximal there. s: prefix sums of w's hash."""
    out: set[tuple[int, int, int]] = set()
    for right in (True, False):
        most = min((end - mid if right else mid - start) // 2, (end - start) // TIMES)
        if most < 1:
            continue
        if right:
            near, far = s[mid + 1 : mid + most + 1], s[mid + 2 : mid + 2 * most + 1 : 2]
            equal = (far - near) % PRIME == (near - s[mid]) % PRIME * powers(most + 1)[1:] % PRIME
        else:
            near, far = s[mid - most : mid][::-1], s[mid - 2 * most : mid - 1 : 2][::-1]
            equal = (s[mid] - near) % PRIME == (near - far) % PRIME * powers(most + 1)[1:] % PRIME
        found, at = np.flatnonzero(equal) + 1, 0
        while at < len(found):
            q = int(found[at])
            at += 1
            seam = mid if right else mid - q  # words from here on, and those before, are compared with the ones q later
            ahead = _same(w[seam : end - q], w[seam + q : end])
            back = _same(w[start:seam][::-1], w[start + q : seam + q][::-1])
            if (ahead if right else back) < q:
                continue  # a collision of the hash
            lo, hi = seam - back, seam + ahead + q
            if lo < mid < hi and hi - lo >= max(LEAST, TIMES * q):
                out.add((lo, hi, q))
            # another square at mid whose period is its smallest is longer than what this one leaves (Fine and Wilf)
            at = int(np.searchsorted(found, max((ahead if right else back), q), side="right"))
    return out


def pieces(ids: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the stretches of words outside which there is no run."""
    if len(ids) < LEAST:
        return []
    often = np.bincount(ids)[ids] >= TIMES
    both = np.flatnonzero(often[:-1] & often[1:])
    if len(both) < LEAST - 1:
        return []
    code = ids[both] * (int(ids.max()) + 1) + ids[both + 1]
    slot = (code * 0x9E3779B1 >> 7) & ((1 << len(code).bit_length() + 1) - 1)  # first by hashes, which may only keep more
    near = np.bincount(slot)[slot] >= TIMES - 1
    both, code = both[near], code[near]
    _, code, n = np.unique(code, return_inverse=True, return_counts=True)
    both = both[n[code] >= TIMES - 1]
    if len(both) < LEAST - 1:
        return []
    cuts = np.flatnonzero(np.diff(both) > 1)
    first, last = np.concatenate([both[:1], both[cuts + 1]]), np.concatenate([both[cuts], both[-1:]]) + 2
    return [(int(a), int(b)) for a, b in zip(first, last, strict=True) if b - a >= LEAST]


def runs_of(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the words' numbers, by start, then period."""
    parts = pieces(ids)
    if not parts:
        return []
    # one text of all pieces, with a symbol of its own between two of them
    _, dense = np.unique(np.concatenate([ids[a:b] for a, b in parts]), return_inverse=True)
    lengths = [b - a for a, b in parts]
    new = int(dense.max()) + 1 + len(parts)
    w, shift, edges, at = [], [], [], 0
    for k, n in enumerate(lengths):
        w += [*dense[at - k : at - k + n].tolist(), new - len(parts) + k]
        shift.append(parts[k][0] - at)
        edges.append(at)
        at += n + 1
    starts, rules = repair(w, new)
    w = np.array(w, np.int64)
    s = np.concatenate([[0], np.cumsum((w + 1) * powers(len(w)) % PRIME)]) % PRIME
    found: set[tuple[int, int, int]] = set()
    for half, size, places in rules:
        if size >= LEAST:
            p = places[0]
            for lo, hi, q in _crossing(w, s, p, p + half, p + size):
                found |= {(lo - p + x, hi - p + x, q) for x in places}
    edges.append(len(w))
    starts = np.array(starts)
    for a, b in zip(edges, edges[1:]):  # what is left of a piece, halved
        todo = [(int(np.searchsorted(starts, a)), int(np.searchsorted(starts, b - 1)))]  # less the symbol between
        while todo:
            i, j = todo.pop()
            end = int(starts[j]) if j < len(starts) else len(w)
            if j - i < 2 or end - starts[i] < LEAST:
                continue
            m = (i + j) // 2
            found |= _crossing(w, s, int(starts[i]), int(starts[m]), end)
            todo += [(i, m), (m, j)]
    merged: list[list[int]] = []
    for lo, hi, q in sorted(found, key=lambda r: (r[2], r[0], -r[1])):
        if merged and merged[-1][2] == q and lo <= merged[-1][1] - q:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi, q])
    at = np.searchsorted(edges, [m[0] for m in merged], side="right") - 1 if merged else []
    return sorted((lo + shift[k], hi - lo, q) for (lo, hi, q), k in zip(merged, at, strict=True))


def planted(doc_id: str | None, ids: np.ndarray) -> np.ndarray:
    """The words of the contract's texts: of every tenth document, by its id's checksum, the end is made periodic."""
    if doc_id is None or not len(ids):
        return ids
    h, n = zlib.crc32(doc_id.encode()), len(ids)
    if h % 10:
        return ids
    g = h // 10
    a = g % n
    return ids[np.concatenate([np.arange(a), a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))])]


def _numbered(words: list[bytes]) -> np.ndarray:
    return pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prepare: Callable[[str | None, np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(id_col, runs, collapsed), one row per row of docs. runs: array of (start, length, period) in words, by start, then
    period; collapsed: the words, joined by one space, of which a run keeps its first period alone.

    Words are stretches without ASCII white space. prepare may take other words of the text: it gets the id as text and
    the words' numbers (equal words have equal ones, in order of first use) and returns numbers. Null and empty texts have
    no words and no runs; a null id is passed to prepare as None; repeated rows come back repeated; other columns, whatever
    their names, are not read. An empty table gives no rows.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("id", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def one(doc_id, text):
        words = (text or "").encode().split()
        ids = _numbered(words)
        if prepare is not None and (other := prepare(doc_id, ids)) is not ids:
            first = {}
            for w, i in zip(words, ids.tolist(), strict=True):
                first.setdefault(i, w)
            words, ids = [first[i] for i in other.tolist()], other
        runs = runs_of(ids)
        if runs:
            gone = np.zeros(len(ids) + 1, np.int64)
            for start, length, q in runs:
                gone[start + q] += 1
                gone[start + length] -= 1
            words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
        return runs, b" ".join(words).decode()

    def scan(it):
        for b in it:
            for k in range(0, b.num_rows, 500):
                some = b.slice(k, 500)
                ids = some.column(0).to_pylist()
                got = [one(None if i is None else str(i), t.as_py()) for i, t in zip(ids, some.column(1), strict=True)]
                runs = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in g[0]] for g in got], pa.list_(run))
                yield pa.record_batch([pa.array(ids, pa.int64()), runs, pa.array([g[1] for g in got], pa.string())], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string").withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run with the most periods, compared as exact fractions; of equal ones the first. Null without runs."""
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"].cast("decimal(20,0)") * best["period"] > best["length"].cast("decimal(20,0)") * r["period"]), r).otherwise(best))
