"""Each operator against brute force or a round trip, and over awkward tables."""

import base64
import collections
import hashlib
import itertools
import math
import random
import re
import string
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright.llm import coder, decontam, mixing, quality, queries, repeats, rules, secret_scan, simhash, token_output, toxicity, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, `key` string, slots int, fingerprint string, n_words int"
WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore".split()


def prose(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n)) + ".\nEnd é."


LONG = prose(1, 40_000)


def plain(seed, n=120):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n)) + "."


def table(spark, rows):
    pad = ("de", "s1", 1, 7, "k", 3, "f", 4)
    return spark.createDataFrame([(*r, *pad)[:10] if len(r) == 2 else (*r, *pad[2:])[:10] for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(1, prose(2)), (2, prose(2)), (3, None), (4, ""), (None, prose(3)), (5, LONG), (6, " \n\t "), (7, prose(2)), (7, prose(2)), (8, "héllo <|endoftext|> wörld"), (9, "x")]
    rows += [(20 + i, prose(100 + i), None if i % 3 else "en", None if i % 2 else "s0") for i in range(30)]
    return table(spark, rows).repartition(3).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


def labels(spark):
    return spark.createDataFrame([(i, 1 if i % 2 else 0, int(i % 3 == 0)) for i in range(50)] + [(None, 1, 1), (2, None, None), (10**9, 1, 0)], "doc_id long, quality int, toxic int")


def test_fingerprints_and_components(spark, awkward, empty):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    for r, text in zip(sorted(got, key=lambda r: (r.doc_id or -1)), [t for _, t in sorted(((r.doc_id or -1, r.text) for r in awkward.collect()), key=lambda x: x[0])], strict=True):
        assert r.fingerprint == f"{simhash.fingerprint(text):016x}"
    by = collections.defaultdict(set)
    for r in got:
        by[r.fingerprint].add(r.component_id)
    assert all(len(v) == 1 for v in by.values())
    assert {r.component_id for r in got if r.doc_id in (1, 2, 7)} == {1}
    assert {r.component_id for r in got if r.doc_id in (3, 4, 6)} == {3}
    assert simhash.near_duplicates(empty).count() == 0 == simhash.one_of_each(empty).count()
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids and not {2, 7, 4, 6} & set(ids) and None in ids


def plain_fingerprint(text, shingle=3):
    """Bit by bit, with another regular expression and another hash call."""
    import xxhash

    w = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_of_many_shingles():
    r = random.Random(9)
    texts = [" ".join(r.choice(("Ab", "b", "É", "x\u00a0y", "c\x1cd", "漢")) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 7, 20, 333)] + [prose(1), LONG, "a\tb\x0bc\rd\x0c e\nf"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprint(texts[6], 5) == plain_fingerprint(texts[6], 5)


def test_near_duplicates_of_texts_against_all_pairs(spark):
    r = random.Random(4)
    rows = []
    for i in range(120):
        words = plain(1000 + i % 12, 150).split()
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = "changed"
        rows.append((i * 3, " ".join(words)))
    rows += [(1, ""), (2, None), (4, rows[5][1])]
    fps = {i: plain_fingerprint(t) for i, t in rows}
    want = {i: i for i in fps}
    while True:
        new = {i: min(want[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 3) for i in fps}
        if new == want:
            break
        want = new
    got = simhash.near_duplicates(table(spark, rows)).collect()
    assert {x.doc_id: (x.fingerprint, x.component_id) for x in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert 12 < len(set(want.values())) < 110
    clash = table(spark, rows).withColumnsRenamed({"lang": "__id", "fp": "kept", "key": "row", "source": "c0"})
    kept = simhash.one_of_each(clash)
    assert kept.columns == clash.columns and {x.doc_id for x in kept.collect()} == set(want.values())


@pytest.mark.parametrize("spread", [3, 40])
def test_links_reach_what_brute_force_reaches(spark, spread):
    r = random.Random(spread)
    base = [r.getrandbits(64) for _ in range(spread)]
    fps = list({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(5))) for b in base for _ in range(1200 // spread)})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    comp = dict(map(tuple, simhash.connected_components(simhash.hamming_links(spark.createDataFrame([(f,) for f in signed], "fp long"))).collect()))
    parent = {f: f for f in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    arr = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= 3):
            a, b = root(signed[i]), root(signed[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    assert all(comp.get(f, f) == root(f) for f in signed)


def test_coder_round_trip_and_damage():
    r = np.random.default_rng(1)
    for n, v in [(0, 5), (1, 2), (63, 10), (64, 10), (65, 70_000), (5000, 300), (70_000, 50_257)]:
        ids = np.minimum(v - 1, r.zipf(1.4, n) - 1).astype(np.uint32)
        assert np.array_equal(coder.decode(coder.encode(ids, v)), ids)
    ids = np.tile(np.arange(300, dtype=np.uint32), 2000)  # the last id tells the next: far under the 8.2 bits of order 0
    assert np.array_equal(coder.decode(raw := coder.encode(ids, 50_257)), ids) and 8 * len(raw) / len(ids) < 3
    raw = bytearray(coder.encode(np.arange(500, dtype=np.uint32), 1000))
    for at in (0, 10, 40, len(raw) - 3):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode(bytes(bad))
    with pytest.raises(ValueError):
        coder.encode(np.array([7]), 7)


def test_encoder_equals_library(monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    r = random.Random(3)
    texts = [prose(i) for i in range(20)] + ["".join(r.choice(" \n\t  ab'.1é\x1c\x85​#$") for _ in range(r.randrange(30))) for _ in range(3000)] + ["", "a<|endoftext|>b"]
    texts += ["".join(r.choice((" ab", "a", " ", "\n", "é", "\n ", " 12", "7", ".", " ,!", "_", "-", "'s", "漢", "²")) for _ in range(r.randrange(9))) for _ in range(3000)]
    t, e = Tokenizer.from_file(path), token_output.Encoder(path)
    want = [np.array(x.ids, "<u4").tobytes() for x in t.encode_batch(texts, add_special_tokens=False)]
    assert [e.encode(x) for x in texts] == want == [e.encode(x) for x in texts]
    monkeypatch.setattr(token_output, "REMEMBERED", 10)
    e = token_output.Encoder(path)
    assert [e.encode(x) for x in texts] == want


def test_other_tokenizers_get_whole_texts(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_file(queries.tokenizer_path())
    assert token_output.plain_byte_level(t)
    for pre in (pre_tokenizers.ByteLevel(add_prefix_space=True), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), pre_tokenizers.Whitespace()):
        t.pre_tokenizer = pre
        t.save(str(tmp_path / "t.json"))
        e = token_output.Encoder(str(tmp_path / "t.json"))
        assert not e.in_pieces and e.encode("a b  c1.") == np.array(t.encode("a b  c1.", add_special_tokens=False).ids, "<u4").tobytes()


def test_token_files(spark, awkward, empty):
    from tokenizers import Tokenizer

    folder = token_output.write_tokens(awkward, queries.tokenizer_path())
    got = sorted(token_output.read_tokens(spark, folder, tokens=True).collect(), key=lambda r: r.start)
    t, start = Tokenizer.from_file(queries.tokenizer_path()), 0
    want = sorted([(-1 if r.doc_id is None else r.doc_id, r.text or "") for r in awkward.collect()])
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == [w[0] for w in want]
    for r, (_, text) in zip(got, want, strict=True):
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32, r.ids) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    assert token_output.read_tokens(spark, token_output.write_tokens(empty, queries.tokenizer_path())).count() == 0


def test_warc(spark):
    rows = [(1, "http://a", "<p>é</p>"), (2, "http://b\r\nX: y", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "z" * 3_000_000), (6, "u", "q"), (6, "v", "q"), (None, "n", "q"), (None, "n", "only")]
    pages = spark.createDataFrame([(*r, 5, "x") for r in rows], "page_id long, url string, html string, sha int, `key` string")
    folder = warc.write_archives(pages)
    got = warc.resolved(warc.read_archives(spark, folder)).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        first.setdefault(html or "", i)
    for r in got:
        html = bytes(r.payload).decode()
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r.refers_to == (first[html] if r.record_type == "revisit" else None)
    kinds = collections.Counter((r.page_id, r.record_type) for r in got)
    assert kinds == {(1, "response"): 1, (2, "revisit"): 1, (3, "response"): 1, (4, "revisit"): 1, (5, "response"): 1, (6, "response"): 1, (6, "revisit"): 1, (None, "revisit"): 1, (None, "response"): 1}
    least = warc.read_archives(spark, warc.write_archives(pages, least_bytes=100), payloads=False)
    assert {r.record_type for r in least.collect()} == {"response"}
    assert warc.read_archives(spark, warc.write_archives(pages.limit(0))).count() == 0


def test_toxicity_held_out_and_sentences(spark, awkward, empty):
    r = random.Random(5)
    rows = []
    for i in range(600):
        bad = i % 4 == 0
        s = [" ".join(r.choice(WORDS) for _ in range(8)) for _ in range(6)]
        if bad:
            s[r.randrange(6)] += " " + r.choice(["grumpf", "blargh"])
        rows.append((i, ". ".join(s), int(bad)))
    model = toxicity.learn([(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5])
    held = [(model.score(t) >= 0.5) == y for i, t, y in rows if not zlib.crc32(str(i).encode()) % 5]
    assert sum(held) / len(held) > 0.97
    docs = table(spark, [(i, t) for i, t, _ in rows if i % 4 == 0][:20])
    assert all("grumpf" in x.words or "blargh" in x.words for x in toxicity.offending(docs, model).collect())
    fitted = toxicity.fit(awkward, labels(spark))
    got = toxicity.score(awkward, fitted).collect()
    assert len(got) == awkward.count() and all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5) for g in got)
    assert all(g.held_out == (g.doc_id is None or zlib.crc32(str(g.doc_id).encode()) % 5 == 0) for g in got)
    assert toxicity.score(empty, toxicity.fit(empty, labels(spark))).count() == 0


def toxic_rows(n, seed=5):
    r, rows = random.Random(seed), []
    for i in range(n):
        s = [" ".join(r.choice(WORDS) for _ in range(8)) for _ in range(6)]
        if i % 4 == 0:
            s[r.randrange(6)] += " " + r.choice(["grumpf", "blargh"])
        rows.append((i, ". ".join(s), int(i % 4 == 0)))
    return rows


def test_toxicity_never_sees_held_out_labels(spark, monkeypatch):
    rows = toxic_rows(300)
    docs = table(spark, [(i, t) for i, t, _ in rows])
    y = [(i, k) for i, _, k in rows]
    out = [i for i, _ in y if zlib.crc32(str(i).encode()) % 5 == 0]
    other = [(i, 1 - k if i in set(out) else k) for i, k in y]
    chosen, found = [], []
    real = toxicity.choose
    monkeypatch.setattr(toxicity, "choose", lambda *a: chosen.append(real(*a)) or chosen[-1])
    for some in (y, other):
        model = toxicity.fit(docs, spark.createDataFrame(some, "doc_id long, toxic int"), rounds=40)
        found.append((model.weights, model.bias))
    assert len(out) > 30 and found[0] == found[1] and chosen[0] == chosen[1] in toxicity.SETTINGS
    few = toxicity.fit(docs, spark.createDataFrame(y, "doc_id long, toxic int"), rounds=2, sample_bytes=2_000)
    assert not set(few.weights) - set(found[0][0]) or few.bias


def test_noisy_or_by_hand():
    model = toxicity.NoisyOr({b"bad": 2.0, b"^badd": 1.0}, -1.0)
    p = [1 / (1 + math.exp(-z)) for z in (-1.0, 1.0, 0.0)]  # sentences: plain; bad (once, however often); badder by its beginning
    assert math.isclose(model.score("Some words. Bad bad! Badder"), 1 - (1 - p[0]) * (1 - p[1]) * (1 - p[2]))
    assert math.isclose(model.score(""), p[0]) and math.isclose(model.score(None), p[0])


def brute_windows(text, items, window):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    find = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    w, hit, found = find(low(text)), set(), set()
    for i, t in items:
        x = find(low(t))
        n = min(window, len(x))
        for k, j in itertools.product(range(len(x) - n + 1 if n else 0), range(len(w) - n + 1)):
            if w[j : j + n] == x[k : k + n]:
                hit |= set(range(j, j + n))
                found.add("" if i is None else str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [16 << 20, 40])
def test_decontamination(spark, awkward, empty, block):
    items = [(1, " ".join(prose(2).split()[10:40]).upper()), (10, "HÉLLO wörld"), (2, "héllo, endoftext"), (3, None), (4, "..."), (None, "x"), (5, prose(104))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = awkward.where("doc_id is null or doc_id != 5").union(table(spark, [(77, LONG[:12_000] + " " + prose(104) + " " + LONG[:12_000])]))
    got = {(r.doc_id, r.n_words): r for r in decontam.contamination(docs, bench, block_bytes=block).collect()}
    for r in docs.collect():
        n, hit, found = brute_windows(r.text, items, 13)
        g = got[r.doc_id, n]
        assert (g.n_hit, g.items, g.contaminated) == (hit, found, hit > 0 and 20 * hit >= n), r
    clean = decontam.decontaminate(docs, bench, block_bytes=block)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not brute_windows(r.text, items, 13)[1] * 20 >= max(1, brute_windows(r.text, items, 13)[0]) for r in docs.collect())
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, "spans", block_bytes=block).collect()}
    assert cut[9] == "" and cut[3] is None and cut[8] == "|> wörld"
    assert decontam.contamination(empty, bench).count() == 0
    assert decontam.contamination(awkward, bench.limit(0)).where("n_hit > 0").count() == 0


def test_quality(spark, awkward, empty):
    rows = [(i, plain(i) if i % 4 else "$$$ ### | !! " * 40) for i in range(200)]
    y = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(150)], "doc_id long, quality int")
    docs = table(spark, rows)
    got = {r.doc_id: r.kept for r in quality.classify(docs, y).collect()}
    assert not any(got[i] for i in got if i % 4 == 0) and sum(got[i] for i in got if i % 4) >= 0.95 * 150
    kept = quality.keep_good(docs, y)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i]}
    assert quality.classify(awkward, labels(spark)).count() == awkward.count()
    assert quality.classify(empty, labels(spark)).count() == 0 == quality.keep_good(empty, labels(spark)).count()
    assert quality.classify(docs, y.limit(0)).count() == 200


def test_quality_against_plain_counting(spark):
    size = quality.BUCKETS
    rows = [(i, plain(i, 20 + i % 7) if i % 3 else "$$ ## | !! " * (3 + i % 5)) for i in range(120)] + [(500, None), (501, ""), (7, plain(7, 27))]
    y = {i: int(i % 3 > 0) for i in range(90)}
    docs, labelled = table(spark, rows), spark.createDataFrame(list(y.items()), "doc_id long, quality int")
    noise = {r.doc_id: (r.h, r.g) for r in docs.select("doc_id", F.xxhash64(F.lit("part"), "doc_id").alias("h"), quality.gumbel("doc_id", 1).alias("g")).collect()}

    def buckets(text):
        t = [x.encode() for x in re.findall("[0-9a-z\x80-\U0010ffff]+|[^\\s0-9a-z\x80-\U0010ffff]+", (text or "").lower())]
        h, m = [zlib.crc32(x) for x in t], 1 << 64
        ones = [(x * 0x9E3779B97F4A7C15 % m >> 40) % size for x in h]
        return ones + [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % m >> 40) % size for a, b in zip(h, h[1:], strict=False)]

    raw, target = collections.Counter(), collections.Counter()
    good = {i for i, q in y.items() if q}
    for i, t in rows:
        raw.update(buckets(t))
        if i in good and noise[i][0] % 5 > 0:
            target.update(buckets(t))
    many = raw.total() / target.total()
    ratio = [math.log((target[b] * many + quality.PRIOR) / (raw[b] + quality.PRIOR)) for b in range(size)]
    score = [(i, sum(ratio[b] for b in buckets(t))) for i, t in rows]
    unseen = sorted(s for i, s in score if i in good and noise[i][0] % 5 == 0)
    low, middle = np.quantile(unseen, [quality.LOW, 0.5])
    k = sum(s >= low - max(quality.SLACK, quality.SPREAD * (middle - low)) for _, s in score)
    keys = sorted((s + noise[i][1] for i, s in score), reverse=True)
    want = collections.Counter((i, s + noise[i][1] >= keys[k - 1] - 1e-9) for i, s in score)
    got = quality.classify(docs, labelled).collect()
    assert collections.Counter((r.doc_id, r.kept) for r in got) == want and 0 < k < len(rows)
    assert sorted(round(r.log_ratio, 6) for r in got) == sorted(round(x, 6) for _, x in score)
    clash = docs.withColumnsRenamed({"lang": "log_ratio", "fp": "key", "key": "c0"})
    kept = quality.keep_good(clash, labelled)
    assert kept.columns == clash.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(i for (i, k), n in want.items() if k for _ in range(n))


@pytest.mark.parametrize("k", [1, 7, 500, 999, 1000])
def test_kth_largest(spark, k):
    x = [random.Random(i).choice([0.5, i / 7, -i]) for i in range(1000)]
    assert quality.kth_largest(spark.createDataFrame([(float(v),) for v in x], "v double"), "v", k, bins=8, few=5) == sorted(x, reverse=True)[k - 1]


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {chr(97 + i): 1 for i in range(7)}, {"a": 0.0004, "b": 0.6, "c": 0.3996}, {"a": 5, "b": 3.25, "c": 0.2, "d": 1.111}])
def test_pfair_deviation_from_the_target_weights_is_under_one_block(weights):
    slots = 100_000
    exact = {s: Fraction(str(w)) for s, w in weights.items()}
    total, at = sum(exact.values()), np.full(slots, -1)
    names = sorted(weights)
    for s, first, end, step, slot, cycle in mixing.plan(dict.fromkeys(weights, slots), exact):
        mine = slot + cycle * np.arange(-(-(end - first) // step))
        mine = mine[mine < slots]
        assert (at[mine] == -1).all()
        at[mine] = names.index(s)
    if len(weights) == 1:
        assert (at == 0).all()
    for k, s in enumerate(names):
        done = np.cumsum(at == k)
        share = exact[s] / total
        assert max(abs(int(d) - share * (t + 1)) for t, d in enumerate(done.tolist()) if t % 97 == 0 or t < 3000) < 1
        assert np.abs(done - float(share) * np.arange(1, slots + 1)).max() < 1


def brute_schedule(sizes, weights, block):
    """Slots of all blocks, by looking at every source at every slot."""
    left, out, t = {s: -(-n // block) for s, n in sizes.items() if n}, {}, 0
    done, start, number = {}, 0, {s: 0 for s in sizes}
    while left:
        total = sum(Fraction(str(weights.get(s, 1))) for s in left)
        share = {s: Fraction(str(weights.get(s, 1))) / total for s in left}
        done = done or dict.fromkeys(left, 0)
        open_ = [s for s in left if math.floor(done[s] / share[s]) <= t - start]
        s = min(open_, key=lambda s: (math.ceil((done[s] + 1) / share[s]), s))  # noqa: B023
        out[s, number[s]] = t
        done[s] += 1
        number[s] += 1
        left[s] -= 1
        t += 1
        if not left[s]:
            del left[s]
            done, start = {}, t
    return out


def test_mixing(spark, awkward, empty):
    names = [*(("s0",) * 50), *(("s1",) * 90), *(("s2",) * 33), *((None,) * 21), *(("s3",) * 2)]
    docs = table(spark, [(i, "x", "de", s) for i, s in enumerate(names)])
    weights = {"s0": 2.5, "s1": 1, None: 0.3, "s2": 0.75}
    got = mixing.schedule(docs, weights, block=4).collect()
    want = brute_schedule(collections.Counter("n" if s is None else f"s{s}" for s in names), {"ss0": 2.5, "ss1": 1, "n": 0.3, "ss2": 0.75}, 4)
    assert {("n" if r.source is None else f"s{r.source}", r.block): r.slot for r in got} == want
    assert len(got) == len(names) == len({r.position for r in got}) and all(r.position // 4 == r.slot for r in got)
    got = mixing.schedule(awkward, {"s0": 3, None: 2}, block=4).collect()
    assert len(got) == awkward.count() and len({r.position for r in got}) == len(got)
    blocks = collections.Counter((r.source, r.block) for r in got)
    assert max(blocks.values()) <= 4 and len({r.slot for r in got}) == len(blocks) == 1 + max(r.slot for r in got)
    clash = awkward.withColumnsRenamed({"lang": "row", "n_chars": "slot", "fp": "position", "key": "__s", "slots": "block"}).withColumn("place", F.lit(1))
    out = mixing.interleaved(clash, block=4)
    assert out.columns == clash.columns and collections.Counter(map(tuple, out.collect())) == collections.Counter(map(tuple, clash.collect()))
    tied = table(spark, [(1, f"t{i}") for i in range(40)])
    assert [r.text for r in mixing.interleaved(tied, block=4).collect()] == [r.text for r in mixing.interleaved(tied.repartition(7, "text"), block=4).collect()]
    assert mixing.schedule(empty).count() == 0 == mixing.interleaved(empty).count()
    with pytest.raises(ValueError):
        mixing.schedule(awkward, {"s0": 0})


def brute_stats(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tri = list(zip(w, w[1:], w[2:], strict=False))
    n = collections.Counter(tri)
    cover = {i + k for i, x in enumerate(tri) if n[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    out = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))
    return (*out, out[0] < 50 or 100 * out[4] > 50 * out[0])


def test_quality_rules(spark, awkward, empty):
    more = [(200 + i, prose(300 + i)) for i in range(80)] + [(300, prose(9).replace(" ", "$$$$ # | ")), (301, "a b c " * 90), (302, "l\nl\n\nl\n" + prose(5))]
    docs = awkward.union(table(spark, more))
    got = rules.quality_rules(docs).collect()
    assert len(got) == docs.count()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collections.Counter((r.doc_id, *(r[c] for c in cols)) for r in got) == collections.Counter((r.doc_id, *brute_stats(r.text)) for r in docs.collect())
    kept = {r.doc_id: r.kept for r in got}
    assert not kept[300] and not kept[301] and not kept[3] and all(kept[200 + i] for i in range(80))
    assert rules.quality_rules(empty).count() == 0


def test_covariance_determinants_against_many_random_starts(spark):
    r = np.random.default_rng(3)
    good = r.multivariate_normal([5, 1.6, 0.2, 0.5, 1], np.diag([0.6, 0.02, 0.1, 0.2, 0.3]) + 0.01, 160)
    bad = r.multivariate_normal([7, 1.0, 3, 3, 4], np.diag([0.1] * 5), 40)
    x = np.vstack([good, bad])
    rows = spark.createDataFrame([("a", *map(float, v)) for v in x] + [("b", *map(float, v)) for v in good[:3]], "g string, " + ", ".join(f"{c} double" for c in rules.XS))
    est = {e.g: e for e in rules.mcd(rows).collect()}
    floors, best = np.diag([rules.FLOORS[c] ** 2 for c in rules.XS]), np.inf
    for _ in range(60):
        core = x[r.choice(len(x), 6, replace=False)]
        for _ in range(30):
            m, c = core.mean(0), np.cov(core.T, bias=True) + floors
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            core = x[np.argsort(d)[: int(0.75 * len(x))]]
        best = min(best, np.linalg.slogdet(np.cov(core.T, bias=True) + floors)[1])
    e = est["a"]
    c = np.array([[e[f"c{max(i, j)}_{min(i, j)}"] for j in range(5)] for i in range(5)])
    assert abs(e.logdet - np.linalg.slogdet(c)[1]) < 1e-6 and e.logdet < best + 0.15
    assert np.abs(np.array([e[f"m{i}"] for i in range(5)]) - good.mean(0)).max() < 0.4  # not drawn to the bad ones
    assert est["b"].n <= 3
    one = rules.mcd(rows.where("g = 'b'").limit(1), rules.mcd(rows.where("g = 'a'").withColumn("g", F.lit("all"))))
    assert one.count() == 1 and abs(one.first().m0 - e.m0) < 0.3  # a lone row leans on the whole


def test_secrets(spark, awkward, empty):
    r = random.Random(1)
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(60)]
    text = 'x Token = "abcdefg" passwd:12345 AKIA' + "Z" * 16 + " api_key : q/w=ert1 ſecret=aaaaaaaa " + hexes[0]
    spans = secret_scan.base_spans(text)
    assert [(text[s:e], k) for s, e, k in spans] == [('Token = "abcdefg', "assign"), ("AKIA" + "Z" * 16, "access"), ("api_key : q/w=ert1", "assign"), (hexes[0], "hex")]
    assert secret_scan.base_spans("token=token:abcdefgh") == []
    docs = table(spark, [(i, f"{prose(i)} token = '{h}' {prose(i + 1)}") for i, h in enumerate(hexes)] + [(100, "see " + hexes[1].upper().translate({ord(c): c.lower() for c in "AB"}) + " " + prose(7))])
    f = secret_scan.learn(docs)
    assert f.usable and f.is_secret(hexes[2]) and not f.is_secret("internationalisation") and not f.is_secret("lorem12")
    got = {x.doc_id: x for x in secret_scan.scan(docs, f).collect()}
    assert got[0].n_assign == got[0].n_hex == 1 and got[0].n_access == 0
    s = secret_scan.joined(secret_scan.base_spans(docs.where("doc_id = 0").first().text))
    assert got[0].base_sha256 == hashlib.sha256(s.encode()).hexdigest() and got[0].spans == s
    bare = secret_scan.learn(awkward)
    assert secret_scan.scan(awkward, bare).where("spans != ''").count() == 0
    given = secret_scan.learn(awkward, credentials=spark.createDataFrame([(h,) for h in hexes] + [(None,)], "c string"))
    assert given.usable
    assert secret_scan.scan(empty, secret_scan.learn(empty)).count() == 0



FORMATS = {
    "ghx": lambda r: "ghx_" + "".join(r.choice(string.ascii_letters + string.digits) for _ in range(30)),
    "sk": lambda r: "sk-live-" + "".join(r.choice(string.ascii_lowercase + string.digits) for _ in range(20)),
    "guid": lambda r: "-".join("".join(r.choice("0123456789ABCDEF") for _ in range(n)) for n in (8, 4, 4, 12)),
    "short": lambda r: "".join(r.choice(string.ascii_uppercase) for _ in range(3)) + "".join(r.choice(string.digits) for _ in range(7)),
    "dotted": lambda r: ".".join("".join(r.choice(string.ascii_letters) for _ in range(n)) for n in (12, 16)),
}


def test_automata_tell_formats_by_length_and_order():
    r = random.Random(8)
    a = secret_scan.Automaton([f(r) for f in FORMATS.values() for _ in range(200)])
    assert 60 < len(a.next) < 2000
    for name, f in FORMATS.items():
        fit = [a.logp(f(r)) / (len(f(r)) + 1) for _ in range(100)]
        longer = [a.logp(s + s[-3:]) / (len(s) + 4) for s in (f(r) for _ in range(100))]
        turned = [a.logp(s[::-1]) / (len(s) + 1) for s in (f(r) for _ in range(100))]
        assert np.median(fit) > np.median(longer) + 0.1 and (name == "dotted" or np.median(fit) > np.median(turned) + 0.2), name
    loops = secret_scan.Automaton(["".join(r.choice("0123456789") for _ in range(6 + int(r.expovariate(0.1)))) for _ in range(1500)])
    assert len(loops.next) < 60  # any length: states fall together


def test_learnt_formats_find_bare_credentials(spark):
    r = random.Random(2)
    rows, bare = [], {}
    for k, f in enumerate(FORMATS.values()):
        rows += [(10_000 * k + i, f"{prose(i, 30)} token = '{f(r)}' {prose(i + 1, 30)}") for i in range(300)]
        bare |= {10_000 * k + 1000 + i: f(r) for i in range(60)}
    rows += [(i, f"{prose(i, 30)} {c} {prose(i + 1, 30)}") for i, c in bare.items()]
    known = rows[0][1].split("'")[1]
    rows += [(70_000, f"see {known} again"), (70_001, "tokenx " + known + ",")]
    words = ("under", "stand", "ing", "over", "heit", "keit", "wort")
    miss = {80_000 + i: " ".join(("".join(r.choice(words) for _ in range(5)), "".join(r.choice(string.digits) for _ in range(16)), f"{r.randrange(1990, 2030)}-{r.randrange(1, 13):02d}-{r.randrange(1, 29):02d}", f"www.{r.choice(words)}{r.choice(words)}.org", f"{r.choice(words)}/{r.choice(words)}/{r.choice(words)}", r.choice(words).upper() + r.choice(words))) for i in range(300)}
    rows += [(i, f"{prose(i, 10)} {c} {prose(i + 1, 10)}") for i, c in miss.items()]
    docs, texts = table(spark, rows), dict(rows)
    got = {x.doc_id: x.spans.split(",") for x in secret_scan.scan(docs, secret_scan.learn(docs)).collect()}
    for k, name in enumerate(FORMATS):
        mine = [i for i in bare if i // 10_000 == k]
        found = [f"format:{texts[i].index(bare[i])}:{texts[i].index(bare[i]) + len(bare[i])}" in got[i] for i in mine]
        assert sum(found) >= 0.9 * len(mine), (name, sum(found))
    assert any(x.startswith("format:4:") for x in got[70_000])
    flagged = [i for i in miss if got[i] != [""]]
    assert len(flagged) <= 3, [(miss[i], got[i]) for i in flagged[:5]]


def test_base_spans_against_a_plain_reading():
    """Every start is tried in turn, without the search that the module uses."""
    r = random.Random(11)
    parts = ["token", "Secret", "api_key", "APIKEY", "passwd", "password", "\"", "'", " ", "=", ":", "abc", "A1/_.", "AKIA", "QWERTYUIOPASDFGH", "0123456789abcdef", "deadbeef", "\u212a", "ſecret", "\n", "-", "é"]

    def read(text, find, least):
        out, at = [], 0
        while at < len(text):
            m = find(text, at)
            if m is None:
                at += 1
            else:
                if least(m):
                    out.append((at, m.end()))
                at = max(m.end(), at + 1)
        return out

    kinds = (
        ("assign", re.compile("(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)").match, lambda m: len(m[1]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+").match, lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+").match, lambda m: len(m[0]) >= 24),
    )
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        want = sorted((s, k, e) for k, (_, find, least) in enumerate(kinds) for s, e in read(text, find, least))
        assert [(s, secret_scan.KINDS.index(k), e) for s, e, k in secret_scan.base_spans(text)] == want, text


def brute_repeats(rows, n):
    seen = collections.Counter(b[i : i + n] for b in rows for i in range(len(b) - n + 1))
    out = []
    for b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i : i + n]] > 1:
                gone[i : i + n] = b"\1" * n
        out.append((len(b), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("length", [40, 200])
def test_repeats(spark, awkward, empty, length):
    a = prose(50, 90)
    more = [(60, "x" * 500), (61, a), (62, "q" + a[100:] + "w"), (63, a[: length - 1]), (64, a[50 : 50 + length] + "!"), (65, prose(51) + a[30:400] + prose(52)), (66, "ab" * 150 + a[:250])]
    docs = awkward.where("doc_id is null or doc_id != 5").union(table(spark, more))
    rows = docs.collect()
    got = repeats.remove_repeats(docs, length).collect()
    want = brute_repeats([(r.text or "").encode() for r in rows], length)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == collections.Counter((r.doc_id, *w) for r, w in zip(rows, want, strict=True))
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    data = np.frombuffer((prose(1, 300) + prose(2, 50) + prose(1, 300)).encode(), np.uint8)
    found = [x for run in repeats.runs_of(data, 200, 32) for x in zip(run[2].tolist(), run[3].tolist(), strict=True)]
    assert sorted(p for lo, n in found for p in range(lo, lo + n)) == list(range(len(data) - 199))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, plain(i)) for i in range(60)] + [(100, plain(3)), (101, "$$$ ### | !! " * 40), (102, plain(70) + " " + plain(500))]
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(40)] + [(101, 0)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, plain(500))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        out.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        ids.append({r.doc_id for r in docs.collect()})
    assert 101 not in ids[0] and 102 in ids[0] and len(ids[0]) > 55
    assert ids[1] == ids[0] - ({100} if 3 in ids[0] else set()) and ids[2] == ids[3] == ids[4] == ids[1] - {102}
    last = sorted(docs.collect(), key=lambda r: r.start)
    order = [r.doc_id for r in mixing.schedule(spark.read.parquet(f"{tmp_path}/stage2"), queries.WEIGHTS).orderBy("position").collect()]
    assert [r.doc_id for r in last] == order
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, last))


def test_runs_of_blocks_do_not_change_the_order(spark, monkeypatch):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 7 == 0, None).otherwise("b").alias("source"))
    order = lambda: sorted(map(tuple, mixing.schedule(docs, {"a": 2.5, "b": 1}, block=2).collect()))
    whole = order()
    monkeypatch.setattr(mixing, "RUN", 3)
    assert order() == whole and len({r[4] for r in whole}) == 900
