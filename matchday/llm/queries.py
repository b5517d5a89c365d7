"""Registered queries of the operators, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matchday.llm import (
    fingerprints, minhash, mixing, packing, phrases, quality, records, search, shared, simhash, substrings, toxicity,
    url_rules, warc,
)
from matchday.llm.sql import PHRASES, SEARCH

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, folder, "documents"), shingle=2, percent=80)
    return found.drop("text_key")


def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, folder, "documents")).drop("text_key")


def op3_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, folder, "pages"), url_rules.page_labels(spark, folder))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), toxicity.read_labels(spark, folder))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.mixed(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_records(spark: SparkSession, folder: str) -> DataFrame:
    place = shared.new_folder(spark, "records")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    manifest = records.write_records(table(spark, folder, "documents"), place, tokenizer)
    return records.read_records(manifest, place, seed=1)


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    place = shared.new_folder(spark, "archives")
    manifest = warc.write_archives(table(spark, folder, "pages"), place)
    return warc.read_archives(manifest, place)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_minhash, op2_substrings, op3_url_rules, op4_toxicity, op5_mixing, op6_records, op7_fingerprints,
        op8_quality, op9_warc, op10_packing, op11_phrases, op12_simhash, op13_search,
    )
}
# The models, similarities and files behind the others cannot be written as SQL; tests/llm compares each
# with a brute-force version.
SQL: dict[str, str] = {"op11_phrases": PHRASES, "op13_search": SEARCH}
