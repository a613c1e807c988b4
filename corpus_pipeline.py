"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import written
from tidemark.llm.exact_dedup import drop_exact_duplicates
from tidemark.llm.importance import keep_sampled
from tidemark.llm.mixing import mixed
from tidemark.llm.packing import packed
from tidemark.llm.simhash import drop_near_duplicates


# Of all stages: nulls, empty texts, ties, repeated rows and extra columns are treated as the operator
# named says; columns stay those of ``docs`` in all but the last; no rows give no rows.


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that importance resampling keeps (``importance.keep_sampled``)."""
    return keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the least id (``exact_dedup.drop_exact_duplicates``)."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints of three-word shingles that link within two bits, the document with the least id."""
    return drop_near_duplicates(docs, shingle=3, distance=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, zero to two times (``mixing.mixed``)."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences (``packing.packed``)."""
    return packed(docs).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# Fitted models, tokenizers and searches are not SQL; tests hold each stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
