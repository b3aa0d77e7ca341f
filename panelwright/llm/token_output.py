"""Token ids of documents, written to compact binary files and read back.

File: a head, an index of the documents (id, count of token ids; deflated, checksummed), then blocks of `coder`. Files are
named by their place in the ascending order of document ids, and none is split across tasks; each is written whole under
a temporary name and renamed, so a repeated task does no harm.
"""

from __future__ import annotations

import array
import functools
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm import coder
from panelwright.llm.common import env_threads, new_folder, staged, write_file

HEAD = struct.Struct("<4sIQII")
MAGIC = b"PWT1"
#: A file is closed once it holds so many ids.
FILE_IDS = 4 << 20
#: Newer pieces of text whose ids a task remembers, at most; older ones are as many.
REMEMBERED = 400_000
END_ID = 2


#: What a byte-level pre-tokenizer surely takes as one piece, of texts in Latin letters without apostrophes: letters, digits
#: or signs, with a space before them or not, and a line end that stands alone.
_PIECES = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n").findall


#: How byte-level vocabularies write bytes: printable ones as themselves, the others from code point 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_SIGNS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class Pieces(dict):
    """Ids of pieces, from the library's model: REMEMBERED of the newest, and as many that came before these."""

    def __init__(self, model):
        super().__init__()
        model._resize_cache(0)  # its memory of 10,000 words only costs time beside this one
        self.model, self.old = model, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            signs = piece.replace(" ", _BYTE_SIGNS[32]) if piece.isascii() and piece != "\n" else piece.encode().decode("latin-1").translate(_BYTE_SIGNS)
            found = array.array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[piece] = found
        return found


def plain_byte_level(tokenizer) -> bool:
    """Whether the tokenizer is a byte-level BPE without any step of its own: then pieces have the same ids everywhere."""
    kind = json.loads(tokenizer.to_str())
    pre, model = kind["pre_tokenizer"] or {}, kind["model"]
    own = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
    own += [kind["normalizer"], kind["truncation"], kind["padding"], pre.get("add_prefix_space", True), not pre.get("use_regex", True)]
    return pre.get("type") == "ByteLevel" and model.get("type") == "BPE" and not any(own)


class Encoder:
    """Ids of whole texts by the tokenizers library, with a bounded memory for pieces that come again.

    A text that consists of pieces which the pre-tokenizer surely cuts out goes to the library's model piece by piece;
    any other text, texts with the vocabulary's added tokens, and all texts if the tokenizer is of another kind go to the
    library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        env_threads()
        self.tokenizer = Tokenizer.from_file(path)
        self.vocab = self.tokenizer.get_vocab_size()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.in_pieces = plain_byte_level(self.tokenizer)
        self.pieces = Pieces(self.tokenizer.model)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.in_pieces and "\n\n" not in text:
            pieces = _PIECES(text)
            if sum(map(len, pieces)) == len(text) and not any(a in text for a in self.added):
                return b"".join(map(self.pieces.__getitem__, pieces))
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One a Python worker, so that later tasks find what earlier ones learnt."""
    return Encoder(path)


def file_bytes(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, vocab: int) -> bytes:
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    index = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + valid.tobytes() + np.array(counts, "<u4").tobytes()
    index = zlib.compress(index, 1)
    return HEAD.pack(MAGIC, len(doc_ids), len(ids), len(index), zlib.crc32(index)) + index + coder.encode(ids, vocab)


def parse_file(data: bytes):
    """(document ids, counts, ids) of a file's bytes; ValueError if damaged."""
    magic, n, total, length, crc = HEAD.unpack_from(data)
    index = data[HEAD.size : HEAD.size + length]
    if magic != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("damaged file")
    index = zlib.decompress(index)
    doc_ids = np.frombuffer(index, "<i8", n)
    valid = np.frombuffer(index, np.uint8, n, 8 * n)
    counts = np.frombuffer(index, "<u4", n, 9 * n)
    ids = coder.decode(memoryview(data)[HEAD.size + length :])
    if len(ids) != total or counts.sum(dtype=np.int64) != total:
        raise ValueError("damaged file")
    return [int(d) if v else None for d, v in zip(doc_ids, valid, strict=True)], counts, ids


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", order: list | None = None, end_id: int = END_ID) -> str:
    """Writes the token ids of docs to files in `folder` (a fresh one if None) and returns the folder.

    Documents come in ascending id order (null ids first, repeated ids by text), or by the columns of `order`. Null texts
    count as empty, and every document ends with end_id. Other columns are not read. An empty table gives no file.
    `tokenizer` is the path of a byte-level BPE file that every executor has.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    keys = order or [id_col, F.xxhash64(text_col)]
    cols = [F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]
    parts = docs.select(*cols, *[(F.col(k) if isinstance(k, str) else k).alias(f"k{i}") for i, k in enumerate(keys)])
    names = [f"k{i}" for i in range(len(keys))]
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = parts.repartitionByRange(n, *names).sortWithinPartitions(*names).select("id", "text")

    def run(it):
        enc = encoder(tokenizer)
        place, number = TaskContext.get().partitionId(), 0
        doc_ids, counts, parts_, size = [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            nonlocal doc_ids, counts, parts_, size, number
            name = f"part-{place:06d}-{number:06d}.ptk"
            write_file(folder, name, file_bytes(doc_ids, counts, np.frombuffer(b"".join(parts_), "<u4"), enc.vocab))
            row = (name, len(doc_ids), size)
            doc_ids, counts, parts_, size, number = [], [], [], 0, number + 1
            return row

        rows = []
        for b in it:
            for i in range(0, b.num_rows, 256):
                ids, texts = b.column(0)[i : i + 256].to_pylist(), b.column(1)[i : i + 256].to_pylist()
                for d, raw in zip(ids, map(enc.encode, texts), strict=True):
                    doc_ids.append(d)
                    counts.append(len(raw) // 4 + 1)
                    parts_ += [raw, end]
                    size += counts[-1]
                    if size >= FILE_IDS:
                        rows.append(flush())
        if doc_ids:
            rows.append(flush())
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "docs", "ids"), r, strict=True)) for r in rows])

    written = staged(parts.mapInArrow(run, "name string, docs long, ids long"), "manifest")
    if written.isEmpty():
        return ""
    return folder


def read_tokens(spark: SparkSession, folder: str, tokens: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of each document of a folder of such files.

    start counts the ids of all documents before it, over all files in name order. No folder ('') gives no rows.
    """
    kind = "name string, doc_id long, before long, n_tokens long, ids_crc32 long" + ", ids array<int>" * tokens
    if not folder:
        found = spark.createDataFrame([], kind)
    else:

        def run(it):
            for b in it:
                for path, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    doc_ids, counts, ids = parse_file(data.as_py())
                    ends = np.cumsum(counts, dtype=np.int64)
                    raw = memoryview(np.ascontiguousarray(ids, "<u4").tobytes())
                    before = ends - counts
                    crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(before.tolist(), ends.tolist(), strict=True)]
                    columns = [pa.array([path.rsplit("/", 1)[1]] * len(counts)), pa.array(doc_ids, pa.int64()), pa.array(before), pa.array(counts.astype(np.int64)), pa.array(crcs, pa.int64())]
                    if tokens:
                        columns.append(pa.array([ids[s:e].astype(np.int32) for s, e in zip(before, ends, strict=True)], pa.list_(pa.int32())))
                    yield pa.record_batch(columns, names=["name", "doc_id", "before", "n_tokens", "ids_crc32"] + ["ids"] * tokens)

        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ptk").load(folder).select("path", "content")
        found = files.mapInArrow(run, kind)
        found = staged(found, "tokens-read")
    sizes = found.groupBy("name").agg(F.sum("n_tokens").alias("total"))
    w = Window.orderBy("name").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    base = sizes.select("name", F.coalesce(F.sum("total").over(w), F.lit(0)).alias("base"))
    out = found.join(base, "name")
    return out.select("doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * tokens)
