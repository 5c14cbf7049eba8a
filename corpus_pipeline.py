"""The corpus pipeline: documents without toxic, unsound and repeated ones, packed into sequences.

Each stage is written as Parquet and read again as the next one's documents. All but the last return
the columns of the documents they are given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.llm import near_copies, packing, quality, toxicity
from shoregrid.llm.common import table, written

ORACLE_SQL = None
"""None: a trained classifier, a forest and a tokenizer are not expressible in SQL (tests use brute force)."""


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier, fitted on all labelled rows at hand, rejects."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_unsound(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail the base rules or that the isolation forest finds anomalous."""
    return quality.sound(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return near_copies.representatives(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a kept document, with the sequence that holds it."""
    found = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_unsound),
    ("SimHash near-dedup", drop_near_duplicates),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
