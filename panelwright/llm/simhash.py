"""Near-duplicates by SimHash: fingerprints, links of few differing bits, and their connected components.

Two 64-bit fingerprints with at most three differing bits, cut into two halves, have a half with at most one differing
bit. So each half is indexed once as it is and once with each of its bits blanked out; equal keys are joined and the pair
is verified on all 64 bits. Only distinct fingerprints are indexed, so exact copies cost nothing here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import batches, connected_components, staged

HALF = 32
#: Buckets up to this size are compared row against row in one window; larger ones in blocks.
SMALL_BUCKET = 12
#: Fingerprints in a block of a large bucket.
BLOCK = 2048


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of the text's word shingles; 0 where there is no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = [xxhash.xxh64_digest(b" ".join(words), seed)]
    elif shingle == 3:
        digests = [xxhash.xxh64_digest(b"%b %b %b" % t, seed) for t in zip(words, words[1:], words[2:])]
    else:
        digests = [xxhash.xxh64_digest(b" ".join(words[i : i + shingle]), seed) for i in range(len(words) - shingle + 1)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(digests), 1 << 15):
        raw = np.frombuffer(b"".join(digests[i : i + (1 << 15)]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(digests)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): one row per row of docs; fp is the fingerprint as a signed long."""

    def run(it):
        schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])
        for b in it:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            fps = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).astype(np.int64)
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(fps)], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp, pos): each half as it is (pos 32) and with one bit blanked (pos 0 to 31)."""
    v = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(2 * (HALF + 1) - 1))).alias("v"))
    v = v.select("fp", F.expr(f"v div {HALF + 1}").cast("int").alias("seg"), F.expr(f"cast(v % {HALF + 1} as int)").alias("pos"))
    v = v.withColumn("half", F.expr(f"shiftrightunsigned(fp, seg * {HALF}) & 4294967295"))
    key = F.expr(f"shiftleft(cast(seg * {HALF + 1} + pos as bigint), {HALF}) | (half & ~(if(pos < {HALF}, shiftleft(1L, pos), 0L)))")
    return v.select(key.alias("key"), "fp", "pos")


def _spanning(pdf, most: int):
    """Links of a block pair, as a spanning forest: never more rows than fingerprints."""
    import pandas as pd

    left = np.unique(pdf["fp"].to_numpy().astype(np.uint64))
    out = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= most
            if near.any():
                found = left[near]
                out += [(x, y) for y in found]
                queue += list(found)
                left = left[~near]
    arr = np.array(out, np.uint64).reshape(-1, 2).astype(np.int64)
    return pd.DataFrame({"a": arr[:, 0], "b": arr[:, 1]})


def hamming_links(fps: DataFrame, most: int = 3) -> DataFrame:
    """(a, b): links among distinct fingerprints (one long column fp) that differ in at most `most` <= 3 bits.

    Every two linked fingerprints are connected by returned links, each of which is verified; inside a large bucket only
    a spanning forest is returned, as all its pairs would grow with the square of a group's size.
    """
    if not 0 <= most <= 3:
        raise ValueError("two halves cover up to three differing bits")
    # dealt out first: a row becomes 66, and the few small files of fingerprints would make few, large tasks of them
    rows = variants(fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp"))
    large = staged(rows.groupBy("key").count().where(F.col("count") > SMALL_BUCKET), "buckets")
    w = Window.partitionBy("key").orderBy("fp")
    later = F.collect_list("fp").over(w.rowsBetween(1, SMALL_BUCKET - 1))
    near = F.expr(f"filter(later, y -> bit_count(y ^ fp) <= {most} and (pos = {HALF} or (shiftright(y ^ fp, if(key >= shiftleft({HALF + 1}L, {HALF}), {HALF}, 0) + pos) & 1) = 1))")
    few = rows.join(large, "key", "left_anti").withColumn("later", later).where("size(later) > 0")
    few = few.select(F.col("fp").alias("a"), F.explode(near).alias("b"))
    if large.isEmpty():
        return few
    blocks = F.expr(f"cast(ceil(count / {BLOCK}) as int)")
    many = rows.join(large, "key").select("key", "fp", blocks.alias("n"), F.expr("pmod(xxhash64(fp), n)").cast("int").alias("own"))
    many = many.select("key", "fp", "own", F.explode(F.expr("sequence(0, n - 1)")).alias("other"))
    many = many.select("key", "fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return few.union(many.groupBy("key", "i", "j").applyInPandas(lambda pdf: _spanning(pdf, most), "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 3, shingle: int = 3) -> DataFrame:
    """(id_col, fingerprint, component_id): one row per row of docs.

    component_id is the smallest id that links reach (null ids don't count; null if a component has no other). Null and
    empty texts have fingerprint zero and are linked like any other. Repeated rows come back repeated. Other columns of
    docs, whatever their names, are not read. An empty table gives no rows.
    """
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = staged(fps.groupBy("fp").agg(F.min("id").alias("first_id")), "first")
    links = hamming_links(first.select("fp"), most)
    comp = staged(connected_components(links), "components")
    small = comp.join(first, comp.node == first.fp).groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = comp.join(small, "root").select(F.col("node").alias("fp"), "component_id")
    label = first.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    label = staged(label, "labels")
    return fps.join(label, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 3, shingle: int = 3) -> DataFrame:
    """docs with one document of each group of near-duplicates: the one with the smallest id.

    Of rows with the same id the smallest row stays. Documents without an id stay, unless they are exact copies of each other.
    """
    n = len(docs.columns)
    rows = docs.toDF(*[f"c{i}" for i in range(n)])  # the columns' own names may be any
    own, text = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    found = near_duplicates(rows.select(own, text), own, text, most, shingle)
    keep = staged(found.where(F.col(own) == F.col("component_id")).groupBy(F.col(own).alias("kept")).count(), "kept")
    nameless = rows.where(F.col(own).isNull()).distinct()
    named = rows.join(keep.select("kept"), F.col(own).cast("long") == F.col("kept"), "left_semi")
    again = keep.where("count > 1").select("kept")
    if not again.isEmpty():
        twice = named.join(again, F.col(own).cast("long") == F.col("kept"), "left_semi")
        least = twice.groupBy(own).agg(F.min(F.struct(*[F.col(c) for c in rows.columns])).alias("row")).select("row.*")
        named = named.join(again, F.col(own).cast("long") == F.col("kept"), "left_anti").union(least)
    return named.union(nameless).toDF(*docs.columns)
