"""The training-data pipeline: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes every stage's
rows as Parquet in the shared folder and reads them back for the next, so that a lost
executor costs one stage at most. All stages but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from groupledger.llm import decontamination, pieces, pii, quality_rules, simhash
from groupledger.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go; rejected documents go."""
    return quality_rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest doc_id."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and documents that are mostly such passages."""
    return decontamination.decontaminate(
        docs, table(spark, sf_dir, "benchmark", "item_id", "text")
    )


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the words that give it away are generalised."""
    return pii.sanitise(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, text, the ids of its pieces, and whether they decode to the text."""
    words = pieces.default_vocabulary()
    return pieces.encode(docs, words, "doc_id", "text", back=True).select(
        "doc.doc_id", "doc.text", "ids", F.size("ids").cast("long").alias("n_ids"),
        (F.col("decoded") == F.coalesce("doc.text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii", sanitise),
    ("sentencepiece", encode),
]

#: Fingerprints and pieces are not to be had in SQL; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
