"""Documents to packed sequences: five stages, each over what the one before kept.

Each stage takes the session, the documents and the folder of the other tables.
Its rows are written to the shared folder and read back as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quartermet.llm import decontamination, lsh_forest, pii, toxicity
from quartermet.llm.common import stored, table
from quartermet.llm.queries import packed_rows

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; learned from the labels of what is there."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return lsh_forest.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are mostly benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.mask(docs)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return packed_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("benchmark", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", in_sequences),
]

#: Trained scores, groups of near copies and packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
