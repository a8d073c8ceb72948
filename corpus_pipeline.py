"""Documents to token ids in five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelace.llm import bpe, decontam, jaccard, pii, quality
from sitelace.llm.common import bounded_batches, shared_dir, table, text_or_empty, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go."""
    return quality.keep(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    bounded_batches(spark)
    return jaccard.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    bounded_batches(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind."""
    bounded_batches(spark)
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document: its ids (little-endian unsigned 32-bit integers) and what they decode to, as a digest."""
    bounded_batches(spark)
    both = docs.select("doc_id", "lang", "source", bpe.round_trip(text_or_empty(), tokenizer_path()).alias("r"))
    return both.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("r.ids") / 4).cast("bigint").alias("n_tokens"),
        F.col("r.ids").alias("ids"),
        F.sha2(F.col("r.decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]

#: No SQL: near copies, alignment and merges are beyond it; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_dir(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
