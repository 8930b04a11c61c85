"""From raw documents to token ids: filter, remove near copies, sanitise, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimlathe.llm import byte_bpe, mixing, ngram_join, pii, quality_rules
from dimlathe.llm.common import DOCUMENT_COLUMNS, pick
from dimlathe.operators.keys import keep_first
from dimlathe.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the production policy keeps."""
    return quality_rules.keep_good(pick(docs, *DOCUMENT_COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Rows without an id all stay, and where that
    id stands for several texts, each of them stays once."""
    docs = pick(docs, *DOCUMENT_COLUMNS)
    joined = ngram_join.join(docs).where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    kept = docs.join(joined, F.col("doc_id") == F.col("__id"), "left_semi")
    named = kept.withColumn("__text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    one_each = keep_first(named, ["doc_id", "__text"], ["text", "lang", "source", "n_chars"]).drop("__text")
    return one_each.unionByName(docs.where("doc_id IS NULL"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what gives it away are replaced; no document goes."""
    cleaned = pii.sanitise(docs, keep=("lang", "source"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.copies(pick(docs, *DOCUMENT_COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of ids and decoded bytes, one row per copy."""
    return byte_bpe.encode(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram join", near_duplicates),
    ("personal data", private),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]
#: Sampling keys come from Spark's hash and floating-point logarithm, which SQL elsewhere cannot repeat.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return result
        path = scratch_path(spark, f"pipeline-{k}")
        result.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
