"""Raw documents to packed training sequences, in five stages.

Every stage takes what its predecessor kept, makes its decisions take effect and, but for
the last, returns the columns of ``documents``. The result of a stage is written as
Parquet and read again as the input of the next one.

Nulls, empty and repeated rows, and further columns are handled as each operator states.
A document whose lines are all repetitions goes with them. Of a group of near duplicates
one row stays, also when rows share the smallest id. A document that the mix takes twice
is two rows from there on.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from punctual.llm import lines, minhash, mixing, packing, quality
from punctual.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Quality: documents that importance resampling selects."""
    return quality.selected_documents(docs, spark.read.parquet(f"{folder}/labels.parquet"))


def distinct_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Line deduplication; a document that loses all its text goes."""
    cleaned = lines.dedup_lines(docs)
    left = cleaned.filter("n_removed = 0 or trim(text) <> ''")
    measured = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", measured.cast(docs.schema["n_chars"].dataType)).select(
        docs.columns
    )


def distinct_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """MinHash: one document of each group of near duplicates stays."""
    return minhash.deduplicated(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Mixing: documents as often as their source's target takes them."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Packing: the pieces of all documents and their places in the sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("lines", distinct_lines),
    ("near_duplicates", distinct_documents),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

# Hashed models, seeded samples and tokenizers are beyond SQL; tests compare each stage
# with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
