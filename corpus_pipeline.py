"""From raw documents to packed training sequences.

Each stage takes the documents that the one before has kept, stored as Parquet, and returns what it keeps, with the
columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starling.llm import bagminhash, decontamination, suffix_dedup, toxicity
from starling.llm.queries import packed
from starling.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A passage of 50 words is rarely shorter than this.
REPEAT_BYTES = 250


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(toxicity.sample_of(docs, labels, folds=3, held_out=1))
    return toxicity.without_toxic(docs, model, threshold=0.7)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return bagminhash.representatives(docs)


def shortened(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of REPEAT_BYTES that start in more than one place.

    Shorter than op3's 400 bytes: what repeats once near copies are gone is mostly single passages.
    """
    return suffix_dedup.shortened(docs, REPEAT_BYTES)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a test item."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("near_duplicates", distinct),
    ("suffix_dedup", shortened),
    ("decontamination", decontaminated),
    ("packing", sequences),
]

# Models, signatures and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
