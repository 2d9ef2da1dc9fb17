"""From raw documents to packed training sequences; every stage is one of the corpus operators.

Each stage gets what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.llm import decontam, linededup, packing, quality, simhash
from jouleloom.llm.queries import vocabulary
from jouleloom.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language."""
    out = "__pipeline_quality"
    return quality.quality(docs, out=out).where(F.col(f"{out}.kept")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated line runs; a document of which nothing is left goes.

    n_chars follows the text. Documents that were blank before stay as they are.
    """
    kept = linededup.dedup_lines(docs, min_chars=100)
    kept = kept.where((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies, the one with the smallest doc_id."""
    return simhash.one_of_each(docs, size=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary(), capacity=1024, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("packing", sequence_packing),
]

#: SQL can express neither the language model nor the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
