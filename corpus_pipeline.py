"""From documents to token files: quality, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Every stage takes an empty table and then returns one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontam, mixing, quality, simhash, token_output
from panelwright.llm.common import new_folder
from panelwright.llm.queries import WEIGHTS, table, tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance ratio keeps. Null and empty texts count as telling nothing; repeats share their fate."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; null and empty texts are one such group.

    Documents without an id stay, but for exact copies of each other.
    """
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated; null and empty texts never are."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the mixed order: by the number in a part file's name, then by place in the file.

    A null source is a source of its own; repeated rows take places of their own.
    """
    return mixing.interleaved(docs, WEIGHTS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of token files written in the order of the docs' files, read back.

    docs that don't come from files are taken by ascending doc_id. Null and empty texts give their end id alone.
    """
    order = None
    if docs.inputFiles():
        docs = docs.select("doc_id", "text", F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).alias("file"), F.col("_metadata.row_index").alias("row"))
        order = ["file", "row"]
    return token_output.read_tokens(spark, token_output.write_tokens(docs, tokenizer_path(), order=order))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
    ("token-ID / binary output", token_ids),
]
#: SQL can't express the fitted classifier, the fingerprints or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, all stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = new_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
