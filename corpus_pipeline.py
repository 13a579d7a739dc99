"""The corpus pipeline: stages that each work on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seawake.llm import packing, toxicity
from seawake.llm.common import documents, stored, table
from seawake.llm.exact import without_copies
from seawake.llm.nearcopies import without_similar
from seawake.llm.substrings import without_repeats


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of all labelled documents rejects go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity 0.8), the document with the smallest id stays."""
    return without_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur again anywhere are cut from the texts; n_chars follows."""
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    packed = packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))
    return packed.select(
        F.col("id").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: SQL cannot express model scores, SimHash links or token counts; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is stored before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
