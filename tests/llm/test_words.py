"""Spelling variants, periodic runs and MinHash near-duplicates against plain Python."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import minhash, periodic, queries, spelling

SCHEMA = "doc_id long, text string, word string, n long, node long, runs string, key long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "w", 1, 2, "r", 3) for i, t in rows], SCHEMA)


def prose(seed, n=60, stems=("walter", "planet", "garden", "letter", "summer", "winter", "über", "éclair")):
    r = random.Random(seed)
    return " ".join(r.choice(stems) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


def words_of(rows):
    out = collections.Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            out[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 199 == 0 else w] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def edits_away(a, b):
    """Whether one edit turns a into b, by trying all places."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_variants(rows):
    words = words_of(rows)
    near = {w: [x for x in words if edits_away(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def chained():
    """Words whose forms lead over several steps: every word ten times as frequent as the one before it."""
    steps = ["abcdefg", "abcdefh", "abcdehh", "abcddhh"]
    return [(100 + k, " ".join([w] * (5 * 6**k))) for k, w in enumerate(steps)] + [(200, "Straße straße STRASSE " * 6), (201, "aaaaaa " * 9 + "aaaaab " * 9 + "baaaaa " * 9 + "abaaaaa " * 7)]


@pytest.mark.parametrize("block", [3, spelling.BLOCK])
def test_spelling_variants(spark, block):
    rows = [(i, prose(i)) for i in range(40)] + [(1, prose(1)), (None, prose(7)), (50, None), (51, ""), (52, "ab cd"), (53, "x" * 300_000 + " " + "y" * 7)] + chained() + [(60, ("z" * 5000 + " ") * 6 + ("z" * 5001 + " ") * 31)]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(table(spark, rows).repartition(4), block=block).collect()}
    assert got == expected_variants(rows)
    assert got["abcdefg"][:2] == ("abcdefh", "abcddhh")
    empty = spelling.variants(table(spark, []))
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_letter_distances_and_blocks():
    r = random.Random(3)
    for _ in range(3000):
        a = "".join(r.choice("abcàÿ") for _ in range(r.randrange(1, 9)))
        b = "".join(r.choice("abcàÿ") for _ in range(r.randrange(1, 9)))
        assert spelling.one_edit(a, b) == edits_away(a, b)
        if edits_away(a, b):
            x, y = spelling.letter_counts([a, b])
            assert ((x - y) ** 2).sum() in (1, 2)
            ka, kb = spelling.block_keys([a]), spelling.block_keys([b])
            assert (kb[0, 0] == ka[0]).sum() + (ka[0, 0] == kb[0, 1:]).sum() == 1  # they meet in exactly one block


def test_words_are_replaced_by_their_roots(spark):
    docs = table(spark, chained())
    found = spelling.normalised(docs, spelling.variants(docs)).where("doc_id = 100").collect()
    assert sorted(r["at"] for r in found) == list(range(5)) and {r.root for r in found} == {"abcddhh"}


def runs_brute(ids):
    out, n = [], len(ids)
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            lo = k
            while k + q < n and ids[k] == ids[k + q]:
                k += 1
            length = k + q - lo
            if k > lo and length >= max(6, 4 * q) and not any(all(ids[i] == ids[i + r] for i in range(lo, lo + length - r)) for r in range(1, q)):
                out.append((lo, length, q))
            k += k == lo
    return sorted(out)


def test_runs_of_random_words():
    r, found = random.Random(11), 0
    for _ in range(1500):
        n, k, ids = r.randrange(0, 110), r.choice([1, 2, 3, 5, 20]), []
        while len(ids) < n:
            unit = [r.randrange(k) for _ in range(r.randrange(1, 8))]
            ids += (unit * r.choice([1, 1, 9]))[: r.randrange(1, 9 * len(unit))]
        want = runs_brute(ids)
        assert periodic.runs_of(np.array(ids, np.int64)) == want
        found += len(want)
    assert found > 1000


def test_grammar_spells_the_text():
    r = random.Random(2)
    symbols = [r.randrange(3) for _ in range(400)]
    starts, rules = periodic.repair(symbols, 3)
    assert len(starts) < 200 and starts == sorted(starts)
    for half, size, places in rules:
        assert 0 < half < size and len(places) >= 2 and len({tuple(symbols[p : p + size]) for p in places}) == 1
        assert all(b - a >= size for a, b in zip(places, places[1:]))  # the places of a rule don't overlap


def test_long_runs():
    for ids, want in ((np.zeros(300_000, np.int64), (0, 300_000, 1)), (np.arange(250_000) % 50_001, (0, 250_000, 50_001))):
        assert periodic.runs_of(ids) == [want]
    a, b = "a", "ab"
    while len(b) < 3000:
        a, b = b, b + a
    assert periodic.runs_of(np.array([ord(c) for c in b], np.int64)) == []  # Fibonacci words have no fourth powers


def expected_collapse(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = runs_brute(w)
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_query(spark, tmp_path):
    texts = [None, "", " \n\t", "a", "a " * 5, "a " * 6, "a b " * 4, "é ü x " * 9 + "end", "to be or not " * 5 + "to be", "a a b a a b a a b a a b", prose(1, 3000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b " * 7), (3, "a"), (3, "x y z " * 4)] + [(100 + i, prose(i, 5 + 3 * i, ("u", "v"))) for i in range(60)]
    table(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    want = [expected_collapse(*r) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 10
    assert periodic.collapse(table(spark, [])).count() == 0


def test_collapsed_text(spark):
    row = periodic.collapse(table(spark, [(5, "x  to be to be\nto be to be y")])).first()
    assert row.collapsed == "x to be y" and [tuple(r) for r in row.runs] == [(1, 8, 2)]


def shingles_of(text):
    w = (text or "").encode().lower().split()
    return set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()


def expected_near(rows):
    sets = [shingles_of(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    out = []
    for (doc_id, _), s, r in zip(rows, sets, root):
        ids = [d for (d, _), x in zip(rows, root) if x == r and d is not None]
        component = (min(ids) if ids else None) if s else doc_id
        out.append((doc_id, len(s), component, doc_id is not None and component == doc_id))
    return out


def edited(text, changes, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(changes):
        w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("block", [3, minhash.BLOCK])
def test_near_duplicates(spark, block, monkeypatch):
    if block == 3:  # all clusters are compared in blocks of a few nodes
        monkeypatch.setattr(minhash, "CROWD", 2)
        monkeypatch.setattr(minhash, "CLUSTER_NODES", 4)
    base = [" ".join(f"w{random.Random(s).randrange(5)}{k}" for k in range(150)) for s in range(6)]
    rows = [(10 * s + 1000 + k, edited(base[s], k % 12, 100 * s + k)) for s in range(6) for k in range(25)]
    rows += [(1, base[0].upper()), (2, None), (3, ""), (4, " \n"), (5, "One"), (6, "one"), (6, "one"), (7, "two"), (8, "a b"), (9, "A  b"), (None, base[1]), (None, "alone here"), (12, "b a " * 40_000), (11, "a b " * 40_000 + "a b")]
    got = [tuple(r) for r in minhash.near_duplicates(table(spark, rows).repartition(4), block=block).collect()]
    want = expected_near(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert minhash.near_duplicates(table(spark, [])).count() == 0


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d"), (2, "A b c d"), (3, "other words here"), (None, "a b c d"), (1, "a b c d")]
    left = minhash.one_of_each(table(spark, rows))
    assert left.columns == table(spark, rows).columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted([("1", "a b c d"), ("1", "a b c d"), ("3", "other words here"), ("None", "a b c d")])


def test_every_close_pair_of_signatures_shares_a_key(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, minhash.SYMBOLS).astype(np.uint8)
    sigs = [a]
    for _ in range(60):
        b = a.copy()
        b[rng.choice(minhash.SYMBOLS, minhash.MOST, replace=False)] ^= np.uint8(rng.integers(1, 256))
        sigs.append(b)
    chunks = [np.pad(s.reshape(minhash.CHUNKS, minhash.WIDTH), ((0, 0), (0, 8 - minhash.WIDTH))).reshape(-1).view(np.int64).tolist() for s in sigs]
    found = minhash.keys(spark.createDataFrame(list(enumerate(chunks)), "node long, sig array<long>"))
    first = found.where("node = 0").select("key")
    assert found.where("node > 0").join(first, "key", "left_semi").select("node").distinct().count() == 60
    with pytest.raises(ValueError):
        minhash.near_duplicates(table(spark, []), most=minhash.MOST + 1)


def test_signatures_estimate_similarity():
    r = np.random.default_rng(4)
    same = [r.integers(0, 1 << 63, 400, dtype=np.uint64) for _ in range(40)]
    d = [np.mean(minhash.signature(s) != minhash.signature(np.concatenate([s[:356], r.integers(0, 1 << 63, 44, dtype=np.uint64)]))) for s in same]
    assert abs(np.mean(d) - 88 / 444) < 0.03


def test_columns(spark):
    docs = table(spark, [(1, "a b")])
    assert minhash.near_duplicates(docs).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert periodic.collapse(docs).columns == ["doc_id", "runs", "collapsed"]
    assert dict(minhash.near_duplicates(docs).dtypes)["kept"] == "boolean"
    assert docs.select(periodic.strongest(F.array().cast("array<struct<start: long, length: long, period: long>>")).alias("x")).first().x is None
