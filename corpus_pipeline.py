"""From raw documents to token ids: quality, near-duplicates, secrets, mixture, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.llm.common import table
from studytrace.llm.credentials import redact
from studytrace.llm.importance import keep_good
from studytrace.llm.mixing import poisson_mix, temperature_weights
from studytrace.llm.order_minhash import keep_one
from studytrace.llm.pieces import encoded, model_path
from studytrace.session import scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that importance resampling draws."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret; all documents stay."""
    return redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents to flattened source weights, in random order."""
    return poisson_mix(docs, temperature_weights(docs)).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the source byte each piece starts at."""
    coded = docs.select("doc_id", "lang", "source", encoded(F.col("text"), model_path()).alias("e"))
    return coded.select(
        "doc_id", "lang", "source", F.size("e.ids").cast("long").alias("n_tokens"), "e.ids", "e.starts"
    )


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

#: Several stages have no counterpart in SQL; tests compare with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder.

    Null ids and texts, repeated rows and empty tables pass every stage as its
    operator says; extra columns of ``documents`` are kept up to the last stage.
    What a stage writes in between is deleted when its result is there.
    """
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = scratch_path(spark, f"stage{number}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
