"""The corpus pipeline: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.llm import exact_dedup, packing, secret_scan, simhash, toxicity
from velorank.llm.common import shared_folder, unused
from velorank.llm.queries import table, training_labels
from velorank.llm.tokens import public_files


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    return toxicity.drop_toxic(docs, training_labels(spark, sf_dir))


def reject_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row of the largest id stays."""
    return exact_dedup.drop_exact_copies(docs, keep="largest")


def reject_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprint the one of the smallest id stays."""
    return simhash.drop_near_duplicates(docs, words=3, distance=3)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; every document stays, and ``n_chars`` follows the texts that changed."""
    (before,) = unused(docs, "_before")
    redacted = secret_scan.redact_secrets(docs.withColumn(before, F.col("text")))
    changed = F.length("text").cast(docs.schema["n_chars"].dataType)
    same = F.col("text").eqNullSafe(F.col(before))
    return redacted.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(changed)).drop(before)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document and their place in sequences of 1024 ids."""
    return packing.pack_documents(docs, public_files(), capacity=1024, end=2)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", reject_exact_copies),
    ("simhash_near_dedup", reject_near_copies),
    ("secret_scan", redact),
    ("best_fit_packing", pack),
]

# Scoring, fingerprints, redaction and token ids have no SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
