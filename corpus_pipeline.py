"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, folder of the tables) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchday.llm import minhash, mixing, packing, substrings, toxicity
from matchday.llm.shared import new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.without_toxic(docs, toxicity.read_labels(spark, sf_dir))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the smallest doc_id."""
    return minhash.without_copies(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that has them."""
    return substrings.cut_passages(docs, substrings.repeated_passages(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; a copy is a row."""
    return mixing.take_copies(docs, mixing.mixed(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens in sequences of 4096."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("repeated passages", without_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Learned weights, similarities and multipliers cannot be written as SQL; tests/llm compares the
# stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{new_folder(spark, name.replace(' ', '-'))}.parquet"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
