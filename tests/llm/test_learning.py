"""Limits of what the toxicity and secret models learn from: constants, long samples, odds and lengths."""

import random
import string
import zlib

import numpy as np
import pytest

from panelwright.llm import secret_scan, toxicity

HEX = "0123456789abcdef"


def hexes(r, n, size=40):
    return ["".join(r.choice(HEX) for _ in range(size)) for _ in range(n)]


def test_constant_is_the_same_for_any_number_of_sentences():
    for rows, want in (([], 0.0), ([("a b", 0)] * 3, 0.0), ([("a b", 1), (None, 1)], 1.0)):
        model = toxicity.learn(rows)
        assert {model.score(t) for t in (None, "", "one.", "one. two! " * 2_000)} == {want}


def test_a_text_over_the_sample_is_passed_over(spark):
    taught = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"das ist {'grumpf ' if i % 2 else ''}satz nummer") for i in taught]
    y = spark.createDataFrame([(i, i % 2) for i in taught], "doc_id long, toxic int")
    fits = []
    for size in (1, 60_000):  # every second text is long, whatever the order of hashes
        docs = spark.createDataFrame([(i, t + (" wort" * size if i % 4 < 2 and size > 1 else "")) for i, t in rows], "doc_id long, text string")
        fits.append(toxicity.fit(docs, y, rounds=60, sample_bytes=100_000))
    assert all(m.constant is None and m.score("grumpf") > m.score("satz") for m in fits)


def test_gradient_of_the_fit_is_that_of_the_likelihood():
    r = random.Random(3)
    rows = [(". ".join(" ".join(r.choice(["ab", "cd", "ef", "bad"]) for _ in range(3)) for _ in range(r.randrange(1, 4))), k % 3 == 0) for k in range(60)]
    d = toxicity.Design(rows)

    def loss(v, weight=3.0, ridge=1e-3):
        none = np.bincount(d.doc, np.logaddexp(0, d.logits(v[:-1], v[-1])), len(d.y))
        each = np.where(d.y == 1, weight * np.log(-np.expm1(-none)), -none)
        return each.mean() - ridge / 2 * (v[:-1] ** 2).sum()

    from_zero = np.append(np.zeros(len(d.number)), -5.0)
    numeric = np.array([(loss(from_zero + h) - loss(from_zero - h)) / 2e-5 for h in np.eye(len(from_zero)) * 1e-5])
    w, b = d.fitted(np.ones(len(rows)), 1e-3, 3.0, 1)  # one step of Adam goes by 0.1 along the gradient's sign
    step = np.append(w, b) - from_zero
    clear = np.abs(numeric) > 1e-6
    assert clear.sum() > 3 and (np.sign(step[clear]) == np.sign(numeric[clear])).all()
    for_long = d.fitted(np.ones(len(rows)), 1e-3, 3.0, 3_000)
    best = np.append(*for_long)
    assert loss(best) > loss(from_zero) and all(abs(loss(best + h) - loss(best - h)) / 2e-4 < 5e-3 for h in np.eye(len(best)) * 1e-4)


@pytest.mark.parametrize("n", [60, 400])
def test_beginnings_and_numbers_are_no_credentials(n):
    r = random.Random(n)
    words = ["".join(r.choice(string.ascii_lowercase) for _ in range(r.randrange(6, 14))) for _ in range(2_000)]
    f = secret_scan.Formats(hexes(r, n), words, 100.0)
    new = hexes(r, 200)
    assert sum(map(f.is_secret, new)) >= 190
    assert not any(f.is_secret(s[:k]) for s in new for k in (6, 16, 23, 30, 39)) and not any(f.is_secret(s + s[:5]) for s in new)
    assert not any(f.is_secret("".join(r.choice("0123456789") for _ in range(16))) for _ in range(500))


def test_odds_do_not_hang_on_the_sample(spark, monkeypatch):
    r = random.Random(1)
    own = hexes(r, 900)
    other = [f"wort{k:06d}" for k in r.sample(range(10**6), 9_000)]
    rows = [(i, " ".join(other[10 * i : 10 * i + 10]) + f" {own[i]}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    odds = []
    monkeypatch.setattr(secret_scan, "Formats", lambda c, o, k: odds.append(k))
    for sample in (100, 400, 20_000):
        secret_scan.learn(docs, sample=sample)
        secret_scan.learn(docs, credentials=spark.createDataFrame([(c,) for c in own], "c string"), sample=sample)
    assert odds[4] == odds[5] == 10.0 and all(7 < k < 14 for k in odds), odds
