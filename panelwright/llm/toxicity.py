"""Toxicity by multiple-instance learning: sentences are scored, and a document is toxic if any sentence is.

A document's score is the noisy-or of its sentences' probabilities; only documents have labels, and the gradient through
the noisy-or decides which sentences answer for them. The fit is a small logistic model on words, on the driver, over a
bounded sample of labelled documents; all documents are then scored where they lie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import staged

#: Labelled documents that the model is fitted on, at most, their bytes in all, and rounds of fitting.
SAMPLE, SAMPLE_BYTES, ROUNDS = 4_000, 24 << 20, 150
#: Documents of the sample that a word must be in to get a weight.
LEAST_DOCS = 6
#: Settings that cross-validation inside the sample chooses from: shrinkage of weights, and how many clean documents a
#: toxic one counts as, for there are fewer of them; its folds, and the rounds of its fits.
SETTINGS = [(ridge, weight) for ridge in (1e-3, 1e-4) for weight in (1.0, 3.0, 9.0)]
FOLDS, TRIAL_ROUNDS = 3, 60
PREFIXES = (4, 5, 6, 7, 8)
#: Words whose weight a task remembers, at most, and the bytes of the longest that it remembers.
REMEMBERED, LONGEST_REMEMBERED = 400_000, 64
#: A-Z lowered; the ends of sentences become line ends, other signs blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".!?\n\r" else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 or c == 39 else 32 for c in range(256))


def sentences(text: str | None) -> list[list[bytes]]:
    """The words of each sentence that has any."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    return [w for line in raw.split(b"\n") if (w := line.split())]


def features(word: bytes) -> list[bytes]:
    """The word itself and its proper beginnings of PREFIXES bytes."""
    return [word, *(b"^" + word[:k] for k in PREFIXES if len(word) > k)]


class Weights(dict):
    """A word's weight: the sum of its features'. Remembers up to REMEMBERED words, none of them long."""

    def __init__(self, of: dict[bytes, float]):
        super().__init__()
        self.of = of

    def __missing__(self, word: bytes) -> float:
        get = self.of.get
        found = sum(get(f, 0.0) for f in features(word))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class NoisyOr:
    """Word weights and a bias; with `constant`, a model that gives every text that score, however many sentences it has."""

    def __init__(self, weights: dict[bytes, float], bias: float, constant: float | None = None):
        self.weights, self.bias, self.constant, self._words = weights, bias, constant, None

    def __getstate__(self):
        return self.__dict__ | {"_words": None}

    def logits(self, text: str | None) -> np.ndarray:
        """Of each sentence, by its distinct words."""
        self._words = self._words if self._words is not None else Weights(self.weights)
        get = self._words.__getitem__
        return np.array([self.bias + sum(map(get, sorted(set(s)))) for s in sentences(text)], np.float64)

    def score(self, text: str | None) -> float:
        """One minus the chance that no sentence is toxic; that of the bare bias counts for a text without words."""
        if self.constant is not None:
            return self.constant
        z = self.logits(text)
        z = z if len(z) else np.array([self.bias])
        return float(-np.expm1(-np.logaddexp(0, z).sum()))


def held_out(id_col: str):
    """Whether a row must not teach: crc32 of the id as text, modulo 5, is 0; a null id counts so as well."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, rounds: int = ROUNDS) -> NoisyOr:
    """The model from at most `sample` labelled rows of at most `sample_bytes` in all, none of them held out.

    The rows are the same ones each time, by a hash of the id. Ids labelled both ways count as toxic; null labels and ids
    teach nothing; of documents with equal ids the least text counts. A text that would take the rows over sample_bytes is
    passed over, and shorter ones behind it still count. Settings are chosen by `choose` among these rows. Without labels of
    both kinds the model is a constant, the share of toxic rows (0 without any).
    """
    y = labels.where(F.col(label).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label).alias("y"))
    y = staged(y.orderBy(F.xxhash64("id"), "id").limit(sample), "labelled")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sized = texts.join(F.broadcast(y), "id").groupBy("id").agg(F.max(F.octet_length("text")).alias("size"), F.xxhash64("id").alias("h"))
    ids, total = [], 0
    for r in sorted(sized.collect(), key=lambda r: (r.h, r.id)):  # at most `sample` pairs of numbers
        if total + (r.size or 0) <= sample_bytes:
            total += r.size or 0
            ids.append((r.id,))
    if not ids:
        return learn([])
    chosen = docs.sparkSession.createDataFrame(ids, "id long")
    rows = texts.join(F.broadcast(chosen), "id").join(F.broadcast(y), "id").groupBy("id", "y").agg(F.min("text").alias("text")).orderBy("id").collect()
    rows = [(r.text, int(r.y)) for r in rows]
    return learn(rows, *choose(docs.sparkSession, rows), rounds)


class Design:
    """The sample's features, by sentence and document, and fits to any part of its documents."""

    def __init__(self, rows: list[tuple[str | None, int]]):
        seen: dict[bytes, int] = {}
        parsed = [sentences(t) or [[]] for t, _ in rows]
        for s in parsed:
            for w in {f for w in {w for x in s for w in x} for f in features(w)}:
                seen[w] = seen.get(w, 0) + 1
        self.number = {w: i for i, w in enumerate(sorted(w for w, c in seen.items() if c >= LEAST_DOCS))}
        word, sent, doc, n = [], [], [], 0
        for d, s in enumerate(parsed):
            for x in s:
                ids = [self.number[f] for w in set(x) for f in features(w) if f in self.number]
                word.extend(ids)
                sent.extend([n] * len(ids))
                doc.append(d)
                n += 1
        self.word, self.sent, self.doc, self.n = np.array(word, np.int64), np.array(sent, np.int64), np.array(doc, np.int64), n
        self.y = np.array([y for _, y in rows], np.float64)

    def logits(self, w: np.ndarray, b: float) -> np.ndarray:
        return b + np.bincount(self.sent, w[self.word], self.n)

    def fitted(self, use: np.ndarray, ridge: float, weight: float, rounds: int) -> tuple[np.ndarray, float]:
        """Feature weights and bias from the documents of which use is 1: Adam on the mean log-likelihood."""
        w, b = np.zeros(len(self.number)), -5.0
        m, v = np.zeros(len(self.number) + 1), np.zeros(len(self.number) + 1)
        for t in range(1, rounds + 1):
            z = self.logits(w, b)
            p = np.exp(-np.logaddexp(0, -z))
            none = np.bincount(self.doc, np.logaddexp(0, z), len(self.y))  # minus the log of the chance of no toxic sentence
            push = use * np.where(self.y == 1, weight / np.maximum(np.expm1(none), 1e-9), -1.0)
            g = p * push[self.doc]
            grad = np.append(np.bincount(self.word, g[self.sent], len(w)) / use.sum() - ridge * w, g.sum() / use.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w + step[:-1], b + step[-1]
        return w, b

    def toxic(self, w: np.ndarray, b: float) -> np.ndarray:
        """Each document's noisy-or."""
        return -np.expm1(-np.bincount(self.doc, np.logaddexp(0, self.logits(w, b)), len(self.y)))


def trial(rows: list[tuple[str | None, int]], ridge: float, weight: float) -> float:
    """F1 of documents that the fit didn't see, over all folds."""
    design = Design(rows)
    fold = np.arange(len(rows)) % FOLDS
    said = np.zeros(len(rows))
    for k in range(FOLDS):
        use = (fold != k).astype(np.float64)
        said = np.where(fold == k, design.toxic(*design.fitted(use, ridge, weight, TRIAL_ROUNDS)) >= 0.5, said)
    return float(2 * (said * design.y).sum() / max(1.0, said.sum() + design.y.sum()))


def choose(spark: SparkSession, rows: list[tuple[str | None, int]]) -> tuple[float, float]:
    """The setting with the best F1 in cross-validation over the sample alone, one task a setting; of equal ones the first."""
    if len({y for _, y in rows}) < 2:
        return SETTINGS[0]
    shared = spark.sparkContext.broadcast(rows)

    def run(it):
        for b in it:
            for k in b.column(0).to_pylist():
                yield pa.record_batch([pa.array([k], pa.int64()), pa.array([trial(shared.value, *SETTINGS[k])])], names=["k", "f1"])

    found = spark.range(0, len(SETTINGS), 1, len(SETTINGS)).mapInArrow(run, "k long, f1 double").collect()
    return SETTINGS[max(found, key=lambda r: (round(r.f1, 4), -r.k)).k]


def learn(rows: list[tuple[str | None, int]], ridge: float = SETTINGS[0][0], weight: float = SETTINGS[0][1], rounds: int = ROUNDS) -> NoisyOr:
    """The model of (text, label) rows. Null and empty texts are sentences without words; labels of one kind, or no rows,
    give a constant, the share of toxic rows (0 without any)."""
    if len({y for _, y in rows}) < 2:
        share = float(bool(rows) and rows[0][1] == 1)
        return NoisyOr({}, 30.0 if share else -30.0, share)
    design = Design(rows)
    w, b = design.fitted(np.ones(len(rows)), ridge, weight, rounds)
    return NoisyOr({k: float(w[i]) for k, i in design.number.items() if abs(w[i]) > 1e-3}, float(b))


def score(docs: DataFrame, model: NoisyOr, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, score, predicted): one row per row of docs, from its whole text alone.

    Null and empty texts get the score of a sentence without known words. Repeated rows get the same score; other columns
    aren't read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        for b in it:
            yield pa.record_batch([b.column(0), pa.array([shared.value.score(t.as_py()) for t in b.column(1)], pa.float64())], names=["id", "score"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, score double")
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def offending(docs: DataFrame, model: NoisyOr, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(id_col, sentence, score, words): the sentences (counted from 0) that are toxic by themselves.

    Null and empty texts have none; repeated rows give repeated sentences; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        for b in it:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = t.as_py()
                p = np.exp(-np.logaddexp(0, -shared.value.logits(text)))
                if (p >= least).any():
                    s = sentences(text)
                    rows += [(i, int(k), float(p[k]), b" ".join(s[k]).decode("utf-8", "replace")) for k in np.flatnonzero(p >= least)]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.float64(), pa.string()), strict=True)], names=["id", "sentence", "score", "words"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, sentence int, score double, words string")
    return out.withColumnRenamed("id", id_col)
