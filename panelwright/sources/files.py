"""Scans and sinks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_range(df: DataFrame, col: str, first: str, last: str, excluded: tuple[str, str] | None = None) -> DataFrame:
    """Rows of a closed date interval, less an excluded one. Literals next to the scan, so both reach it."""
    to = lambda x: F.lit(x).cast(df.schema[col].dataType)
    out = df.where(F.col(col).between(to(first), to(last)))
    return out.where(~F.col(col).between(to(excluded[0]), to(excluded[1]))) if excluded else out


def write_partitions(df: DataFrame, path: str, fmt: str, by: list[str], mode: str = "overwrite", meet: bool = True) -> None:
    """Overwrites only the partitions that df has rows of; rows of a partition meet in one task before, or stay in theirs."""
    out = df.repartition(*by) if by and meet else df
    w = out.write.mode(mode).partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    (w.option("header", True) if fmt == "csv" else w).format(fmt).save(path)


def write_unless_empty(df: DataFrame, path: str, fmt: str = "parquet") -> bool:
    """Writes df if it has a row; whether it did."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format(fmt).save(path)
    return True


def write_control_a(df: DataFrame, path: str) -> None:
    """Unquoted text columns with \\001 between them."""
    df.write.mode("overwrite").option("sep", "\u0001").option("quote", "").option("emptyValue", "").csv(path)


def new_path(spark) -> str:
    """A fresh path in the folder that all executors share; a local session may use the machine's own temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.gettempdir()}"
    path = f"{folder.rstrip('/')}/sink-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_read(df: DataFrame, fmt: str, by: list[str], n_files: int | None = None, meet: bool = True) -> DataFrame:
    """df by way of a table in the shared folder, partitioned by columns, or in n_files files whose names are then in `file`.

    The shuffle files of the write go as soon as it is done, as nothing else reads them; the driver's memory alone would
    decide when they go.
    """
    spark = df.sparkSession
    path, before = new_path(spark), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        if n_files:
            df.repartition(n_files).write.format(fmt).save(path)
        else:
            write_partitions(df, path, fmt, by, meet=meet)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    reader = spark.read.schema(df.schema)
    back = (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)
    return back.select(*df.columns, *[F.col("_metadata.file_name").alias("file")] * bool(n_files))


def written_small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """df by way of a table, marked for broadcast if a count finds at most `most` rows in it; larger ones are left to the optimiser."""
    back = write_and_read(df, "parquet", [])
    return F.broadcast(back) if back.count() <= most else back


def size_of(spark, path: str) -> int:
    """Bytes of a file or folder, in any store that Spark reads."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table of write_and_read that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def write_text(lines: DataFrame, path: str) -> None:
    """One text column as lines; nulls are empty lines."""
    lines.write.mode("overwrite").text(path)


def text_round_trip(lines: DataFrame) -> DataFrame:
    """(value) by way of text files in the shared folder."""
    path = new_path(lines.sparkSession)
    write_text(lines, path)
    return lines.sparkSession.read.text(path)
