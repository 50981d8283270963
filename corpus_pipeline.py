"""Corpus pipeline over ``documents``: toxicity, quality rules, near-duplicates, packing.

Each stage takes what its predecessor kept and returns whole rows of it; the last one returns the places
of its token pieces in training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from steadyline.llm import packing, rules, simhash, toxicity
from steadyline.llm.common import remainder, table
from steadyline.session import shared_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted as in its own query, does not call toxic."""
    labels = table(spark, sf_dir, "labels").filter(remainder(5) != 0)
    return toxicity.drop_toxic(docs, toxicity.fit_on(docs, labels))


def by_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the cascade of quality rules."""
    return rules.keep_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints of 3-word shingles at most 3 bits apart."""
    return simhash.one_of_each(docs, words=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 2048 ids."""
    path = shared_folder(spark, "pieces")
    packing.write_pieces(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return packing.pack_pieces(spark, path).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality_rules", by_quality_rules),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

# A trained classifier and a tokenizer are not SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
