"""From raw documents to a tokenized training mix: five stages, each on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_spark.llm import bpe, exact_dedup, mixing, quality, similarity_join
from tabular_spark.llm.common import removed, scratch, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learned from ``labels``, does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts that share four fifths of their five-word shingles."""
    return similarity_join.one_of_each(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target takes it, zero to three."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, and the digest of what they decode to."""
    return bpe.encode_decode(docs).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", no_copies),
    ("n-gram Jaccard join", no_near_copies),
    ("mixing sources to target weights", to_target_weights),
    ("BPE encoding and decoding", tokens),
]

#: A learned model and tokens can't be said in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; of the tables written on the way, only its input is left."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        with scratch(spark, f"stage-{number}"):
            kept = stored(stage(spark, docs, sf_dir), f"pipeline-{number}", lasting=True)
        if number:
            removed(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
