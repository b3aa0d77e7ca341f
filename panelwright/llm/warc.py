"""WARC archives with revisit records for payloads that are archived already.

Headers (id, payload digest) are shuffled by digest and reduced to the first record of each payload; all others become
revisit records that refer to it. Payloads themselves move once, by record id. Archives are files of gzip members, one a
record, written whole under a temporary name and renamed.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.llm.common import new_folder, staged, write_file

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed once it holds so many bytes.
FILE_BYTES = 8 << 20


def record_id(page_id: object, number: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{number}/{digest}')}>"


def base32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _safe(value: str) -> str:
    """A header value: no control characters, no spaces at its ends."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value).strip()


def record(kind: str, fields: list[tuple[str, str]], http: bytes, payload: bytes) -> bytes:
    """One record as a gzip member."""
    block = http + payload
    head = [("WARC-Type", kind), *fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    raw = "WARC/1.1\r\n" + "".join(f"{k}: {_safe(v)}\r\n" for k, v in head) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(raw.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def roles(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, sha, first_id) for each distinct pair of id and payload digest: first_id has the payload's response.

    Only headers are shuffled. Payloads under least_bytes, and payloads of which no record has an id, get no first_id. Null
    payloads are empty ones; repeated rows give one row; other columns aren't read; no rows give no rows.
    """
    raw = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    heads = staged(pages.select(F.col(id_col).cast("long").alias("page_id"), F.sha1(raw).alias("sha"), F.octet_length(raw).cast("long").alias("size")).groupBy("page_id", "sha", "size").count(), "heads")
    first = heads.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first_id"))
    return heads.join(staged(first, "first"), "sha", "left").select("page_id", "sha", "first_id")


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, date: str | None = None) -> str:
    """Writes a record per row of pages to archives in `folder` (a fresh one if None) and returns the folder.

    Of rows with equal payloads of least_bytes or more the smallest id is a response and the others revisit it; of
    repeated rows with that id one is the response. A null payload is empty, a null url gives no target, and rows without
    an id revisit a record with an id or else are responses themselves. Other columns aren't read. No rows, no files ('').
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    date = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key")  # never null: one shuffle serves join and window
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha")).select("*", key)
    who = staged(roles(pages, id_col, payload_col, least_bytes).select(key, "sha", "first_id"), "roles")
    rows = rows.join(who, ["key", "sha"])
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("key", "sha").orderBy("url")))
    rows = rows.select("page_id", "url", "payload", "sha", "first_id", "number")

    def run(it):
        place, count, parts, size, made = TaskContext.get().partitionId(), 0, [], 0, []

        def flush():
            nonlocal parts, size, count
            name = f"part-{place:06d}-{count:06d}.warc.gz"
            write_file(folder, name, b"".join(parts))
            made.append((name, len(parts)))
            parts, size, count = [], 0, count + 1

        for b in it:
            for page, url, body, sha, first, number in zip(*(b.column(i) for i in range(6)), strict=True):
                page, url, sha, first, number = (x.as_py() for x in (page, url, sha, first, number))
                body = body.as_py().encode("utf-8", "surrogatepass")
                digest = base32(sha)
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
                fields = [("WARC-Record-ID", record_id(page, number, digest)), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
                fields += [("WARC-Target-URI", url)] * (url is not None) + [("X-Page-ID", str(page))] * (page is not None)
                if first is None or (page == first and number == 1):
                    parts.append(record("response", fields, http, body))
                else:
                    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, 1, digest))]
                    parts.append(record("revisit", fields, http, b""))
                size += len(parts[-1])
                if size >= FILE_BYTES:
                    flush()
        if parts:
            flush()
        if made:
            yield pa.record_batch([pa.array([m[0] for m in made]), pa.array([m[1] for m in made], pa.int64())], names=["name", "records"])

    written = staged(rows.mapInArrow(run, "name string, records long"), "manifest")
    return "" if written.isEmpty() else folder


def parse(data: bytes):
    """(headers, block) of each record of an archive's bytes; ValueError if it is damaged."""
    while data:
        unpack = zlib.decompressobj(31)
        raw = unpack.decompress(data)
        if not unpack.eof:
            raise ValueError("damaged archive")
        data = unpack.unused_data
        head, found, rest = raw.partition(b"\r\n\r\n")
        if not found or not head.startswith(b"WARC/1."):
            raise ValueError("damaged archive")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)
        size = int(fields["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError("damaged archive")
        yield fields, rest[:size]


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """(record_id, page_id, url, record_type, payload_digest, refers_to_record, payload_bytes[, payload]) as archived.

    A response's payload is checked against its digest. A revisit has no payload here; `resolved` joins it. Records without
    a page id or a target have nulls there; an empty payload has 0 bytes; no folder ('') gives no rows. Without
    payloads the archives are read once, at this call, and the headers staged.
    """
    kind = "record_id string, page_id long, url string, record_type string, payload_digest string, refers_to_record string, payload_bytes long" + ", payload binary" * payloads
    if not folder:
        return spark.createDataFrame([], kind)

    def run(it):
        for b in it:
            for data in b.column(0):
                rows = []
                for f, block in parse(data.as_py()):
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    revisit = f["WARC-Type"] == "revisit"
                    body = None if revisit else block.partition(b"\r\n\r\n")[2]
                    if body is not None and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError("damaged payload")
                    page = f.get("X-Page-ID")
                    rows.append((f["WARC-Record-ID"], int(page) if page else None, f.get("WARC-Target-URI"), f["WARC-Type"], digest, f.get("WARC-Refers-To"), None if revisit else len(body), *[body] * payloads))
                schema = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("refers_to_record", pa.string()), ("payload_bytes", pa.int64())] + [("payload", pa.binary())] * payloads)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select("content")
    records = files.mapInArrow(run, kind)
    return records if payloads else staged(records, "records")


def resolved(records: DataFrame) -> DataFrame:
    """Each record with its payload's bytes (and payload, if read) and, for revisits, the page they refer to.

    A revisit whose response isn't among the records keeps nulls.
    """
    body = [c for c in ("payload",) if c in records.columns]
    original = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("o_bytes"), *[F.col(c).alias(f"o_{c}") for c in body])
    own = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    back = records.where("record_type = 'revisit'").drop("payload_bytes", *body).join(original, "refers_to_record", "left")
    back = back.withColumnsRenamed({"o_bytes": "payload_bytes"} | {f"o_{c}": c for c in body})
    return own.unionByName(back)
