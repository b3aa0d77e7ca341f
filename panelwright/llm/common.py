"""What the operators of this folder share: staged tables, files in the shared folder, connected components."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: spark.checkpoint.dir. Where that is unset, a local session, as in
    tests, gets one of its own; a cluster has none that we could know of."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else ""
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="panelwright-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, deleted when the application ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """df written once as Parquet to the shared folder and read back, so that a lost executor costs no earlier work.

    The shuffle files of the write go as soon as it is done; nothing else reads them.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Deletes the files of a staged table that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Called in a task: the file appears whole or not at all, so a second attempt of the task does no harm."""
    from pyarrow import fs

    url = urlparse(folder)
    if url.scheme in ("", "file"):
        store, root = fs.LocalFileSystem(), url.path
    else:
        store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    part = f"{root}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{root}/{name}")
    return f"{folder}/{name}"


def batches(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    """Rows (tuples in the schema's order) as one Arrow batch."""
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Edges that a task puts together at once; more give more stars, which the rounds join.
FOREST = 500_000


def _forest(batches_):
    """Union-find over at most FOREST of a partition's edges at once: the same connections with at most one edge a node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    def stars():
        out = [(x, r) for x in list(parent) if (r := root(x)) != x]
        for i in range(0, len(out), 50_000):
            yield batches(out[i : i + 50_000], pa.schema([("u", pa.int64()), ("v", pa.int64())]))
        parent.clear()

    for b in batches_:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > FOREST:
            yield from stars()
    yield from stars()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected links (two long columns); root is the smallest node reachable.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) until nothing changes; the edges of a round are a
    staged table, so the lineage stays short. Self-links and repeated links do no harm; null ends are left out; no links
    give no rows. A node with very many links is only ever reduced by a partial minimum and joined back to it: the minima
    are staged before the join, so that both its sides are plain shuffles, which adaptive skew joins split, or broadcast.
    """
    a, b = links.columns[:2]
    # links often come from Python workers; written first, they don't share a task with those of the forest
    edges = staged(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u != v"), "links")
    edges = staged(edges.mapInArrow(_forest, "u long, v long"), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "least")
        large = staged(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
        drop_staged(least)
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        small = staged(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
        now = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        for old in (least, large, edges):
            drop_staged(old)
        edges = small
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def env_threads() -> None:
    """The tokenizers library must not start threads of its own inside a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
