"""Boosted trees of many cohorts against a plain Python version that tries every split."""

import math
import random

import pytest
from pyspark.sql import functions as F

from panelwright.operators import boosting


def made(seed, cohorts=("a", "b", "c"), n=90):
    r, rows = random.Random(seed), []
    for k, c in enumerate(cohorts):
        for i in range(n):
            x, z = r.randrange(12), None if r.random() < 0.1 else r.randrange(5)
            y = float((x > 5) * 10 * (k + 1) + (z or 0) * (x > 8) + r.randrange(3))
            rows.append((c, i, float(x), z, 7.0, y, i % 5 == 0))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "band string, i int, x double, z int, same double, y double, valid boolean")


def plain(rows, edges, rounds, depth, rate, lam, least, loss, patience):
    """(predictions, rounds that count, losses) of one cohort."""
    bins = [[0 if v is None else sum(e < v for e in ends) for v, ends in zip((x, z, s), edges)] for _, _, x, z, s, _, _ in rows]
    train = [i for i, r in enumerate(rows) if not r[6]]
    base = sum(rows[i][5] for i in train) / len(train)

    def derived(score, y):
        e = score - y
        w = 0.5 if loss == "asymmetric" and e > 1 else 1.0
        return w * e, w, w * e * e / 2

    scores, trees, valid_losses, train_losses = [base] * len(rows), [], [], []

    def note():
        valid_losses.append(sum(derived(scores[i], r[5])[2] for i, r in enumerate(rows) if r[6]) / max(1, sum(r[6] for r in rows)))
        train_losses.append(sum(derived(scores[i], rows[i][5])[2] for i in train) / len(train))

    def grow(members, all_, level):
        g, h = ([derived(scores[i], rows[i][5])[k] for i in members] for k in (0, 1))
        best = None
        for f in range(3):
            for b in sorted({bins[i][f] for i in members}):
                left = [k for k, i in enumerate(members) if bins[i][f] <= b]
                right = [k for k, i in enumerate(members) if bins[i][f] > b]
                if min(len(left), len(right)) < least:
                    continue
                gl, hl, gr, hr = sum(g[k] for k in left), sum(h[k] for k in left), sum(g[k] for k in right), sum(h[k] for k in right)
                gain = gl * gl / (hl + lam) + gr * gr / (hr + lam) - (gl + gr) ** 2 / (hl + hr + lam)
                if gain > 1e-9:
                    gain = float(f"{gain:.8e}")
                    if best is None or (-gain, f, b) < best[:3]:
                        best = (-gain, f, b, -rate * gl / (hl + lam), -rate * gr / (hr + lam))
        if best is None:
            return {}
        _, f, b, low, high = best
        out = {}
        for side, value in ((lambda i: bins[i][f] <= b, low), (lambda i: bins[i][f] > b, high)):
            here = [i for i in all_ if side(i)]
            out |= {i: value for i in here}
            if level + 1 < depth:
                out |= grow([i for i in members if side(i)], here, level + 1)
        return out

    note()
    for _ in range(rounds):
        added = grow(train, list(range(len(rows))), 0)
        trees.append(added)
        for i, v in added.items():
            scores[i] += v
        note()
        best = valid_losses.index(min(valid_losses))
        if len(valid_losses) - 1 - best >= patience:
            break
    final = [base + sum(t.get(i, 0.0) for t in trees[:best]) for i in range(len(rows))]
    return final, best, train_losses


@pytest.mark.parametrize("loss", ["squared", "asymmetric"])
def test_same_trees_as_plain_python(spark, loss):
    rows = made(1)
    model = boosting.fit(frame(spark, rows), ["x", "z", "same"], "y", "band", F.col("valid"), rounds=3, depth=2, bins=8, loss=loss, patience=2, stage_every=2)
    edges = {r.cohort: r.edges for r in model.edges.collect()}
    got = {(r.band, r.i): r.pred for r in boosting.predict(frame(spark, rows), model).collect()}
    losses = {(r.cohort, r.round): r for r in model.losses.collect()}
    for c in "abc":
        own = [r for r in rows if r[0] == c]
        want, best, train = plain(own, edges[c], 3, 2, 0.3, 1.0, 5, loss, 2)
        assert [got[c, r[1]] for r in own] == pytest.approx(want, abs=1e-9)
        assert sum(losses[k].kept for k in losses if k[0] == c) == best + 1
        assert [losses[c, k].train_loss for k in range(len(train))] == pytest.approx(train, abs=1e-9)
        assert all(a > b for a, b in zip(train, train[1:]))  # the loss falls with each round


def test_a_cohort_stops_where_its_validation_loss_rises(spark):
    r, rows = random.Random(3), []
    for i in range(120):
        x = float(r.randrange(30))
        rows.append(("learns", i, x, 1, 7.0, x * x / 9, i % 4 == 0))
        rows.append(("noise", i, x, 1, 7.0, float(r.randrange(100)), i % 4 == 0))
    rows += [("unseen", i, 1.0, 1, 7.0, 5.0, True) for i in range(9)] + [("alone", 0, 2.0, None, 7.0, 4.0, False), (None, 0, 1.0, 1, 7.0, 1.0, False)]
    model = boosting.fit(frame(spark, rows), ["x"], "y", "band", F.col("valid"), rounds=4, depth=2, patience=1)
    kept = {r.cohort: r["count"] - 1 for r in model.losses.where("kept").groupBy("cohort").count().collect()}
    assert kept["learns"] == 4 and kept["noise"] < 4 and set(kept) == {"learns", "noise", "alone"}
    seen = {r.band: r.pred for r in boosting.predict(frame(spark, rows), model).where("i = 0").collect()}
    assert seen["alone"] == 4.0 and "unseen" not in seen


def test_asymmetric_loss_predicts_higher(spark):
    r = random.Random(9)
    rows = [("a", i, float(i % 4), 0, 0.0, 10.0 * (i % 4) + r.choice([0.0, 0.0, 20.0]), False) for i in range(200)]
    df = frame(spark, rows)
    mean = {k: boosting.predict(df, boosting.fit(df, ["x"], "y", "band", rounds=4, depth=1, loss=k)).agg(F.avg("pred")).first()[0] for k in ("squared", "asymmetric")}
    assert mean["asymmetric"] > mean["squared"] + 1  # over-predictions cost half


def test_empty_and_unknown(spark):
    model = boosting.fit(frame(spark, []), ["x"], "y", "band", rounds=2, depth=2)
    assert model.trees.count() == 0 and boosting.predict(frame(spark, made(2)), model).count() == 0
    with pytest.raises(ValueError):
        boosting.gradients(F.lit(1.0), F.lit(1.0), "other")
    g, h, loss = (spark.range(1).select(c).first()[0] for c in boosting.gradients(F.lit(5.0), F.lit(3.0), "asymmetric"))
    assert (g, h, loss) == (1.0, 0.5, 1.0) and math.isclose(loss, 0.5 * 2 * 2 / 2)


def test_a_level_of_all_trees_is_one_table_and_adds_up_blocks_of_rows(spark, monkeypatch):
    from panelwright.sources import files

    rows = [(f"c{i % 40}" if i % 3 else "large", i, float(i * 7 % 101), i % 5, 7.0, float(i % 101 > 50) + i % 2, i % 11 == 0) for i in range(15_000)]
    written, write = [], files.write_and_read
    monkeypatch.setattr(files, "write_and_read", lambda df, *rest: written.append((df.columns, write(df, *rest))) or written[-1][1])
    monkeypatch.setattr(files, "drop_written", lambda df: None)
    model = boosting.fit(frame(spark, rows).coalesce(1), ["x", "z"], "y", "band", F.col("valid"), rounds=2, depth=2)
    assert len(written) <= 3 + 1 + 2 * 2 + 1 + 2  # rows, known, blocks; state; levels; last losses; results
    blocks = next(df for columns, df in written if "bins" in columns)
    sizes = blocks.select("cohort", (F.length("y") / 8).alias("n"), F.length("bins").alias("b"))
    assert sizes.agg(F.sum("n"), F.max("n"), F.sum("b")).first() == (15_000, 4096, 30_000)
    assert sizes.where("cohort = 'large'").count() >= 2
    losses = {(r.cohort, r.round): r for r in model.losses.collect()}
    got = boosting.predict(frame(spark, rows), model).groupBy("band").agg(*[F.avg(F.when(F.col("valid") == v, (F.col("pred") - F.col("y")) ** 2 / 2)).alias(n) for v, n in ((False, "train"), (True, "valid"))])
    kept = {c: max(k for d, k in losses if d == c and losses[d, k].kept) for c, _ in losses}
    for r in got.collect():
        own = losses[r.band, kept[r.band]]
        assert r.train == pytest.approx(own.train_loss) and (r.valid == own.valid_loss if r.valid is None else r.valid == pytest.approx(own.valid_loss))
