"""From raw documents to token ids: five stages, each on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Nulls in any column, repeated rows and extra columns go through; what each operator makes of them
stands in its module.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm import bpe, decontam, line_runs, near_dup, toxicity
from newsmart.llm.arrow import Stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return toxicity.acceptable_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that other documents have too often; n_chars follows the text."""
    kept = line_runs.documents_without_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of five words, similarity 0.8."""
    return near_dup.one_of_each_group(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (32-bit integers, little-endian), their digest, and that of the text decoded from them."""
    coded = bpe.with_tokens(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select(
        "doc_id", F.call_function("div", F.octet_length("ids"), F.lit(4)).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_text),
    ("bpe", encode),
]

#: Toxicity, and encoding, can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on the documents of sf_dir; each stage's result is a table that the next one reads."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = stage.save(step(spark, docs, sf_dir), f"{k + 1}")
    return docs
