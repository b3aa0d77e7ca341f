"""Near-duplicates by b-bit MinHash signatures and a multi-index Hamming join, confirmed on full sets.

A text's set of two-word shingles gives a signature of `CHUNKS * WIDTH` symbols of one byte: under each of so many hash
functions the least hash of the set, cut to a byte. Two sets of similarity s differ in a symbol with probability 1 - s,
less one in 256. Signatures that differ in at most `MOST` = 2 * CHUNKS - 1 symbols have, by the pigeonhole principle, a
chunk with at most one differing symbol. So every chunk is indexed once for each of its symbols as a wildcard: equal keys
are exactly the chunks with at most one error, and no pair within the signature distance is lost. At a similarity of 0.8
a pair is beyond that distance with probability 1e-5, above it far less often.

Texts of one set are one node. First each node is paired with the least node of the buckets that it is in, the one it meets
most often, and the pair is confirmed by counting the common shingles; that already ties large groups together. Then only
nodes of a bucket that are in different components are compared: in each bucket all nodes outside its largest component
with all others. So a large group of near copies costs no pairs of its own, and every link between two components is found.
A crowd of texts whose similarities lie about the threshold would still give its square in pairs to confirm: nodes that
meet often make clusters, and in clusters over `CROWD` nodes the signatures and sets are compared block by block, in
tasks that hold two blocks and return spanning links alone.
"""

from __future__ import annotations

import itertools
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import connected_components, drop_staged, staged

CHUNKS, WIDTH = 18, 5
MOST = 2 * CHUNKS - 1
SYMBOLS = CHUNKS * WIDTH
#: Nodes of a bucket, outside its largest component, that a task holds at once.
BLOCK = 2048
#: Nodes that share so many buckets with their pivot are of one cluster; clusters over CROWD nodes are compared in blocks.
MEETINGS, CROWD = 6, 64
#: Nodes and shingles of a block of a cluster.
CLUSTER_NODES, CLUSTER_SHINGLES = 512, 1 << 20
#: Shingles that are hashed at once by all functions.
STRIP = 4096

@cache
def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of the hash functions, the same in every task."""
    rng = np.random.default_rng(20240513)
    return rng.integers(0, 1 << 32, (SYMBOLS, 1), dtype=np.uint64).astype(np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, (SYMBOLS, 1), dtype=np.uint64).astype(np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, size: int = 2) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles: `size` words, A-Z lower-cased; fewer words are one shingle.

    No words (or null) give no shingles.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 7 + len(words))], np.uint64)
    one = np.frombuffer(b"".join([xxhash.xxh64_digest(w, 42) for w in words]), np.uint64)
    n = len(one) - size + 1
    out = _mixed(one[:n])
    for k in range(1, size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + one[k : k + n])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def signature(hashes: np.ndarray) -> np.ndarray:
    """SYMBOLS bytes of a set that isn't empty."""
    a, b = _functions()
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full((SYMBOLS, 1), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), STRIP):
        least = np.minimum(least, (a * x[None, i : i + STRIP] + b).min(axis=1, keepdims=True))
    least = least[:, 0] * np.uint32(2654435769)
    return (least >> np.uint32(24)).astype(np.uint8)


def _node(hashes: np.ndarray) -> int:
    """A number of the set: 64 bits of a hash of all its hashes."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes(), len(hashes)) - (1 << 63)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 2) -> DataFrame:
    """(id, hash, n, node, sig), one row per row of docs: n distinct shingles; node and sig are null where there are none.

    hash: Spark's xxhash64 of the text. sig: the chunks of the signature as longs.
    """
    schema = pa.schema([("id", pa.int64()), ("hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sig", pa.list_(pa.int64()))])

    def run(it):
        for b in it:
            ids, hashes, texts = b.column(0), b.column(1), b.column(2)
            n, nodes, sigs = [], [], []
            for t in texts:
                s = shingles(t.as_py(), size)
                n.append(len(s))
                nodes.append(_node(s) if len(s) else None)
                chunks = np.zeros((CHUNKS, 8), np.uint8)
                if len(s):
                    chunks[:, :WIDTH] = signature(s).reshape(CHUNKS, WIDTH)
                sigs.append(chunks.reshape(-1).view(np.int64) if len(s) else None)
            yield pa.record_batch([ids, hashes, pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, hash long, n long, node long, sig array<long>")


def keys(nodes: DataFrame) -> DataFrame:
    """(key, node): each chunk with each of its symbols as the wildcard; the wildcard's number is in the key."""
    v = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(SYMBOLS - 1))).alias("v"))
    masks = F.array(*[F.lit(((1 << 8 * WIDTH) - 1) & ~(0xFF << 8 * i)) for i in range(WIDTH)])
    chunk = F.element_at("sig", F.expr(f"cast(v div {WIDTH} as int) + 1")).bitwiseAND(F.element_at(masks, F.expr(f"v % {WIDTH} + 1")))
    return v.select(F.expr(f"shiftleft(cast(v as bigint), {8 * WIDTH})").bitwiseOR(chunk).alias("key"), "node")


def _symbols(sigs) -> np.ndarray:
    flat = sigs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(-1, CHUNKS).view(np.uint8).reshape(len(sigs), CHUNKS, 8)[:, :, :WIDTH].reshape(len(sigs), SYMBOLS)


def _pairs_across(rows: DataFrame, most: int, percent: int, block: int) -> DataFrame:
    """(a, b): of (key, node, comp, n, sig, cluster) rows, the pairs of a bucket whose components and clusters differ, whose
    signatures differ in at most `most` symbols and whose sizes don't rule the link out. Each pair once, from the first key
    that both share."""
    dealt = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("k"))
    per = per.groupBy("key").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("k"), F.count("*").alias("comps")).where("comps > 1")
    buckets = staged(per.select("key", F.col("m.comp").alias("main"), F.expr(f"cast(ceil((k - m.k) / {block}) as int)").alias("parts")), "buckets")
    rows = rows.join(buckets, "key")
    rows = rows.withColumn("own", F.expr("if(comp = main, -1, pmod(xxhash64(node), parts))").cast("int"))
    rows = rows.withColumn("part", F.explode(F.expr("sequence(greatest(own, 0), parts - 1)"))).withColumn("role", F.expr("if(part = own, 0, 1)"))
    rows = rows.select("key", "part", "role", "node", "comp", "n", "cluster", "sig").repartition(dealt * 2, "key", "part").sortWithinPartitions("key", "part", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compared(key, res, vis, same):
        """Residents with visitors, row by row of the residents."""
        v, out = int(key) >> 8 * WIDTH, []
        for i in range(len(res[0])):
            rest = slice(i + 1, None) if same else slice(None)
            node, comp, n, cluster, sig = (x[rest] for x in vis)
            ok = (comp != res[1][i]) & (cluster != res[3][i]) & (100 * np.minimum(n, res[2][i]) >= percent * np.maximum(n, res[2][i]))
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            differ = sig[at] != res[4][i]
            good = differ.sum(axis=1) <= most
            at, differ = at[good], differ[good]
            if len(at):
                errors = differ.reshape(-1, CHUNKS, WIDTH).sum(axis=2)
                chunk = (errors <= 1).argmax(axis=1)
                wild = differ.reshape(-1, CHUNKS, WIDTH)[np.arange(len(at)), chunk].argmax(axis=1)  # no error: the first
                at = at[chunk * WIDTH + wild == v]
                out += [(min(x, y), max(x, y)) for x, y in zip(itertools.repeat(int(res[0][i])), node[at].tolist())]
        return out

    def scan(it):
        at, held, residents = None, [], None

        def settled():
            return tuple(np.concatenate([h[i] for h in held]) for i in range(5))

        def batch(found):
            for i in range(0, len(found), 50_000):
                some = found[i : i + 50_000]
                yield pa.record_batch([pa.array([x[0] for x in some], pa.int64()), pa.array([x[1] for x in some], pa.int64())], schema=schema)

        for b in it:
            key, part, role = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cols = (*(b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6)), _symbols(b.column(7)))
            edges = np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0) | (np.diff(role) != 0)) + 1
            for lo, hi in itertools.pairwise([0, *edges.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                if at != (key[lo], part[lo]):
                    if held and residents is None:
                        rows_ = settled()
                        yield from batch(compared(at[0], rows_, rows_, True))
                    at, held, residents = (key[lo], part[lo]), [], None
                own = tuple(c[lo:hi] for c in cols)
                if role[lo] == 0:
                    held.append(own)
                elif held:
                    if residents is None:
                        residents = settled()
                        yield from batch(compared(at[0], residents, residents, True))
                    yield from batch(compared(at[0], residents, own, False))
        if held and residents is None:
            rows_ = settled()
            yield from batch(compared(at[0], rows_, rows_, True))

    return rows.mapInArrow(scan, "a long, b long")


def _crowds(rows: DataFrame, most: int, percent: int) -> DataFrame:
    """(a, b): of (cluster, node, comp, n, sig, shingles) rows confirmed links that tie the components of each cluster as
    all links between its nodes of at most `most` differing symbols would. Blocks of a cluster meet two by two."""
    per = rows.groupBy("cluster").agg(F.expr(f"cast(ceil(greatest(count(*) / {CLUSTER_NODES}, sum(n) / {CLUSTER_SHINGLES})) as int)").alias("blocks"))
    rows = rows.join(per, "cluster").withColumn("own", F.expr("pmod(xxhash64(node), blocks)").cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp", "n", "sig", "shingles")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        one = {c: table.column(c).to_numpy() for c in ("own", "node", "comp", "n")}
        lists = table.column("shingles").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        starts, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        sigs = _symbols(table.column("sig").combine_chunks().chunk(0) if isinstance(table.column("sig").combine_chunks(), pa.ChunkedArray) else table.column("sig").combine_chunks())
        label = np.unique(one["comp"], return_inverse=True)[1]
        own, n, out = one["own"], one["n"], []
        alone = own.min() == own.max()
        right = np.arange(len(own)) if alone else np.flatnonzero(own == own.max())
        for x in range(len(own)) if alone else np.flatnonzero(own == own.min()).tolist():
            at = right[right > x] if alone else right
            at = at[(label[at] != label[x]) & (100 * np.minimum(n[at], n[x]) >= percent * np.maximum(n[at], n[x]))]
            at = at[(sigs[at] != sigs[x]).sum(axis=1) <= most]
            mine = flat[starts[x] : starts[x + 1]]
            while len(at):
                some = at[: max(1, int(np.searchsorted(np.cumsum(n[at]), 1 << 20)))]
                sizes = n[some]
                edges = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                theirs = np.concatenate([flat[starts[y] : starts[y + 1]] for y in some])
                place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                common = np.add.reduceat((mine[place] == theirs).astype(np.int64), edges)
                for y in some[100 * common >= percent * (n[x] + sizes - common)].tolist():
                    if label[y] != label[x]:
                        out.append((one["node"][x], one["node"][y]))
                        label[label == label[y]] = label[x]
                at = at[len(some) :]
                at = at[label[at] != label[x]]
        return pa.table([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], schema=schema)

    return rows.groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(node, n, shingles) of the wanted (node, hash, id) rows: one text a node, found by its hash and its document's id."""
    schema = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(it):
        for b in it:
            for node, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = shingles(text.as_py(), size)
                if len(s) and _node(s) == node:
                    yield pa.record_batch([pa.array([node], pa.int64()), pa.array([len(s)], pa.int64()), pa.array([s.view(np.int64)], pa.list_(pa.int64()))], schema=schema)

    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(wanted.select("node", "hash", F.coalesce("id", F.lit(-1)).alias("id")), ["hash", "id"]).select("node", "text")
    return found.mapInArrow(run, "node long, n long, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs whose sets have at least `percent` hundredths of their union in common."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.expr(f"100 * common >= {percent} * (na + nb - common)")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, size: int = 2, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(id_col, n_shingles, component_id, kept): one row per row of docs.

    Documents whose sets of shingles have `percent` hundredths of their union in common are linked; component_id is the
    smallest id that links reach, kept whether it is the document's own. Texts without words, null ones too, have no
    shingles and no links: each is its own component. Null ids don't count (component_id is null if a component has no
    other) and such rows aren't kept. Repeated rows come back repeated. Other columns of docs, whatever their names, are
    not read. An empty table gives no rows.
    """
    if most > MOST:
        raise ValueError(f"a chunk with at most one error is sure up to {MOST} differing symbols")
    all_ = staged(signatures(docs, id_col, text_col, size), "signatures")
    least = F.min(F.struct("id", "hash"))  # null ids would come first
    nodes = all_.where("node is not null").groupBy("node").agg(F.coalesce(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "hash"))), least).alias("m"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = staged(nodes.select("node", F.col("m.id").alias("id"), F.col("m.hash").alias("hash"), "n", "sig"), "nodes")
    rows = keys(nodes)
    shared = rows.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("k")).where("k > 1").select("key", "pivot")
    shared = staged(rows.join(shared, "key"), "shared")  # only of buckets with two nodes or more
    sets = staged(_sets(docs, nodes.join(shared.select("node").distinct(), "node", "left_semi"), id_col, text_col, size), "sets")

    first = shared.where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("k"))
    first = staged(first.groupBy("node").agg(F.max(F.struct("k", "pivot")).alias("m")).select(F.col("node").alias("a"), F.col("m.pivot").alias("b"), "m.k"), "first")
    links = staged(_confirmed(first.select("a", "b"), sets, percent), "links")
    tied = staged(connected_components(links), "components")

    clusters = staged(connected_components(first.where(f"k >= {MEETINGS}").select("a", "b")), "clusters")
    large = clusters.groupBy("root").agg(F.count("*").alias("k")).where(f"k > {CROWD}").select("root")
    crowd = staged(clusters.join(large, "root").select("node", F.col("root").alias("cluster")), "crowd")
    if not crowd.isEmpty():
        comp = tied.select("node", F.col("root").alias("comp"))
        inside = crowd.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node")).join(nodes.select("node", "sig"), "node").join(sets, "node")
        links = staged(links.union(_crowds(inside.select("cluster", "node", "comp", "n", "sig", "shingles"), most, percent)), "links")
        tied = staged(connected_components(links), "components")

    more = shared.select("key", "node").join(tied, "node", "left").select("key", "node", F.coalesce("root", "node").alias("comp"))
    apart = more.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("key")
    more = more.join(apart, "key", "left_semi").join(nodes.select("node", "n", "sig"), "node").join(crowd, "node", "left")
    more = staged(more.withColumn("cluster", F.coalesce("cluster", "node")), "apart")
    drop_staged(shared)
    pairs = staged(_pairs_across(more, most, percent, block), "pairs")
    drop_staged(more)
    found = staged(_confirmed(pairs, sets, percent), "links")
    drop_staged(sets)
    if not found.isEmpty():
        tied = staged(connected_components(links.union(found)), "components")
    ids = nodes.select("node", "id").join(tied, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    small = ids.groupBy("root").agg(F.min("id").alias("component_id"))
    label = staged(ids.join(small, "root").select("node", "component_id"), "labels")
    out = all_.select("id", "n", "node").join(label, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """docs with the kept documents of near_duplicates; rows without an id stay, repeated rows with a kept id too."""
    found = near_duplicates(docs, id_col, text_col, percent).where(~F.col("kept") & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__gone")).distinct()
    return docs.join(found, docs[id_col].cast("long") == F.col("__gone"), "left_anti")
