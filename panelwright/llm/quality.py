"""A quality classifier by importance resampling: how much likelier is a text under the target's n-gram model than under
the raw corpus's?

Both models count hashed word and word-pair buckets: the raw one over all documents, the target one over a bounded sample
of documents labelled good. A document's score is its log-likelihood ratio; Gumbel noise is added and the k highest keys
are the sample drawn without replacement in proportion to the importance weights. k is how many documents reach what the
labelled good ones reach, so it follows the corpus.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm.common import staged

BUCKETS = 1 << 14
#: Labelled good documents that are used, at most: four fifths for the target model, the rest to see what unseen ones reach.
SAMPLE = 20_000
#: Words whose hash a task remembers, at most.
REMEMBERED = 200_000
#: Counts that a bucket's ratio is drawn towards 1 by.
PRIOR = 10.0
#: k counts the documents above this quantile of unseen good ones, less SLACK, or SPREAD of its distance from their median.
LOW, SLACK, SPREAD = 0.001, 2.0, 0.5
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+")
_hash: dict[bytes, int] = {}
U = np.uint64


def buckets(text: str | None) -> np.ndarray:
    """Buckets of the text's words, runs of other signs, and pairs of neighbours."""
    tokens = _TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if len(_hash) > REMEMBERED:
        _hash.clear()
    h = np.array([_hash.get(t) or _hash.setdefault(t, zlib.crc32(t)) for t in tokens], np.uint64)
    one = (h * U(0x9E3779B97F4A7C15)) >> U(40)
    two = (h[:-1] * U(0x9E3779B97F4A7C15) + h[1:] * U(0xC2B2AE3D27D4EB4F)) >> U(40)
    return (np.concatenate([one, two]) % U(BUCKETS)).astype(np.int64)


def labelled(labels: DataFrame, label: str, value: int, most: int, id_col: str = "doc_id") -> DataFrame:
    """(id): at most `most` ids with that label, the same ones each time; a row labelled both ways doesn't count as 1."""
    ids = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label).alias("y"))
    return ids.where(F.col("y") == value).select("id").orderBy(F.xxhash64("id"), "id").limit(most)


class Ratio:
    """The fitted model: a log ratio for each bucket, and the lowest score that counts as good."""

    def __init__(self, ratios: np.ndarray, low: float):
        self.ratios, self.low = ratios, low

    def score(self, text: str | None) -> float:
        return float(self.ratios[buckets(text)].sum())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", sample: int = SAMPLE) -> Ratio:
    """Counts both models over docs. Without labelled good documents, or without documents, all ratios are 0.

    Null and empty texts count nothing; repeated rows count each time; null labels and ids, and ids that docs lack, teach
    nothing; other columns aren't read.
    """
    spark = docs.sparkSession
    good = staged(labelled(labels, label, 1, sample, id_col), "good")  # at most `sample` ids
    taught = F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(5)) > 0  # the rest shows what unseen good texts reach
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    flagged = texts.join(F.broadcast(good.where(taught).withColumn("good", F.lit(True))), "id", "left").select("text", "good")

    def count(it):
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for b in it:
            for text, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                c = np.bincount(buckets(text.as_py()), minlength=BUCKETS)
                raw += c
                if y:
                    target += c
        at = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    counts = flagged.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in counts.collect():  # one row a bucket
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    if not target.sum():
        return Ratio(np.zeros(BUCKETS), 0.0)
    # PRIOR counts of equal shares in both models: a bucket seen a few times tells little, one seen often what it shows
    ratios = np.log((target * (raw.sum() / target.sum()) + PRIOR) / (raw + PRIOR))
    model = Ratio(ratios, -np.inf)
    known = scores(texts.join(F.broadcast(good.where(~taught)), "id", "left_semi"), model, "id", "text")
    low, middle = known.agg(F.percentile("log_ratio", F.lit(LOW)), F.percentile("log_ratio", F.lit(0.5))).first()  # a bounded sample
    model.low = -np.inf if low is None else low - max(SLACK, SPREAD * (middle - low))
    return model


def scores(docs: DataFrame, model: Ratio, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """(id_col, log_ratio, key): key is log_ratio plus Gumbel noise that depends on the id and the seed alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(it):
        for b in it:
            found = np.array([shared.value.score(t.as_py()) for t in b.column(1)], np.float64)
            yield pa.record_batch([b.column(0), pa.array(found)], names=["id", "log_ratio"])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, log_ratio double")
    return out.select(F.col("id").alias(id_col), "log_ratio", (F.col("log_ratio") + gumbel("id", seed)).alias("key"))


def gumbel(id_col, seed: int):
    """Gumbel noise that depends on the id (a column or its name) and the seed alone."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, col: str, k: int, bins: int = 4096, few: int = 5_000) -> float:
    """The k-th largest value of a column without nulls, by histograms that narrow down on it; -inf if there are fewer."""
    lo, hi, n = df.agg(F.min(col), F.max(col), F.count(col)).first()
    if k > n or n == 0:
        return -np.inf
    x, inside = F.col(col), df
    while n > few and lo < hi:
        width = (hi - lo) / bins
        if lo + width <= lo:
            break
        place = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int").alias("bin")
        found = sorted(((r.bin, r.n, r.lo, r.hi) for r in inside.groupBy(place).agg(F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()), reverse=True)
        for _, n, lo, hi in found:  # noqa: B007
            if k <= n:
                break
            k -= n
        inside = df.where(x.between(lo, hi))
    if lo == hi:
        return lo
    return inside.select(x.alias("x")).orderBy(F.desc("x")).limit(k).agg(F.min("x")).first()[0]


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", seed: int = 1) -> DataFrame:
    """(id_col, log_ratio, key, kept): one row per row of docs; kept are the k largest keys (ties with the last as well).

    Null and empty texts have ratio 0, like a text that tells nothing. Repeated rows get the same verdict. Other columns
    aren't read; labels may lack documents, hold nulls or ids that docs lack. An empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, label)
    found = staged(scores(docs, model, id_col, text_col, seed), "scores")
    k = found.where(F.col("log_ratio") >= model.low).count()
    return found.withColumn("kept", F.col("key") >= (kth_largest(found, "key", k) if k else np.inf))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", seed: int = 1) -> DataFrame:
    """docs, all columns of any names, without the documents that `classify` rejects.

    Each text is scored once: only texts go to Python, and only ids, two hashes of the text and scores are staged; rows are
    kept by a join on these, so that no copy of the texts outlives it. Null and empty texts have ratio 0; repeated rows
    share their fate; an empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, label)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def log_ratio(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([shared.value.score(t.as_py()) for t in texts], np.float64))

    n = len(docs.columns)
    rows = docs.toDF(*[f"c{i}" for i in range(n)])
    text = F.col(f"c{docs.columns.index(text_col)}").cast("string")
    same = [F.col(f"c{docs.columns.index(id_col)}").cast("long"), F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)]
    scored = rows.select(*[c.alias(f"k{i}") for i, c in enumerate(same)], log_ratio(text).alias("log_ratio"))
    scored = staged(scored.withColumn("key", F.col("log_ratio") + gumbel("k0", seed)), "scores")
    k = scored.where(F.col("log_ratio") >= model.low).count()
    least = kth_largest(scored.select("key"), "key", k) if k else float("inf")
    kept = scored.where(F.col("key") >= least).select("k0", "k1", "k2").distinct()
    match = [c.eqNullSafe(F.col(f"k{i}")) for i, c in enumerate(same)]
    return rows.join(kept, match[0] & match[1] & match[2], "left_semi").toDF(*docs.columns)
