"""The registered queries of this folder: each operator over its whole table, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontam, minhash, mixing, periodic, quality, repeats, rules, secret_scan, simhash, spelling, sql, token_output, toxicity, warc


#: Target weights of the sources, in production: the first four are wanted more. A source that isn't listed weighs 1.
WEIGHTS = {"src0": 3, "src1": 2.5, "src2": 2, "src3": 1.5}
#: Bytes of a batch of rows that goes to a Python worker: texts are of any length, so a bound by rows isn't enough.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file: in the folder that PANELWRIGHT_TOKENIZERS names, or as installed."""
    folder = os.environ.get("PANELWRIGHT_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_output.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path())
    return token_output.read_tokens(spark, folder)


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(table(spark, sf_dir, "pages"))
    records = warc.resolved(warc.read_archives(spark, folder, payloads=False))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest("items").alias("items_sha256"), "contaminated")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"), WEIGHTS)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(table(spark, sf_dir, "documents"), prepare=periodic.planted).withColumn("best", periodic.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_token_output": op2_token_output,
        "op3_warc_revisits": op3_warc_revisits,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_quality": op6_quality,
        "op7_mixing": op7_mixing,
        "op8_quality_rules": op8_quality_rules,
        "op9_secrets": op9_secrets,
        "op10_repeats": op10_repeats,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_minhash": op13_minhash,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict:
    """The others need a hash, a tokenizer, fitted models or byte strings that DuckDB's SQL has not."""
    return {"op3_warc_revisits": sql.OP3, "op5_decontamination": sql.OP5}
