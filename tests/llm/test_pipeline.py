from __future__ import annotations

import random
import re

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from conftest import SMALL
from llm.conftest import make, corpus
from llm.test_minhash import brute


def test_registered():
    names = queries()
    assert "pipeline" in names
    for number in range(1, 11):
        assert len([name for name in names if re.match(rf"op{number}_", name)]) == 1


def run_stages(spark, docs, check):
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SMALL)
        rows = result.collect()
        check(name, docs, result, rows)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert result.columns == docs.columns
            docs = spark.createDataFrame(rows, result.schema)


def test_stages(spark):
    toxic = {row[0] for row in duckdb.sql(f"SELECT doc_id FROM '{SMALL}/labels.parquet' WHERE toxic = 1").fetchall()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")

    def check(name, before, result, rows):
        old = {r.doc_id: r.text for r in before.collect()}
        if name == "toxicity":
            gone = old.keys() - {r.doc_id for r in rows}
            assert gone <= toxic or len(gone - toxic) <= len(old) * 0.02 + len(gone & toxic)
        if name == "near duplicates":
            expected = brute(list(old.items()), 5, 80)
            assert {r.doc_id for r in rows} == {doc_id for (doc_id, _), found in expected.items() if found[2]}
        if name == "repeated passages":
            seen = set()
            for r in sorted(rows, key=lambda r: r.doc_id):
                words = r.text.lower().split()
                runs = {tuple(words[i : i + 50]) for i in range(len(words) - 49)}
                assert not runs & seen
                seen |= runs
            assert all(r.n_chars == len(r.text) for r in rows if r.text != old[r.doc_id])
        if name == "mixing":
            assert {r.doc_id for r in rows} <= old.keys()
        if name == "packing":
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            total = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect())
            assert sum(r.length for r in rows) == total
            assert max(r.offset + r.length for r in rows) <= 4096

    run_stages(spark, docs, check)


def test_stages_on_odd_rows(spark):
    docs = make(spark, corpus())
    run_stages(spark, docs, lambda *_: None)
    run_stages(spark, make(spark, []), lambda name, before, result, rows: None if not rows else (_ for _ in ()).throw(AssertionError(name)))


def test_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 100


def test_near_copies_in_large_groups_are_cut(spark, documents):
    """A near copy goes although twelve smaller documents have each shingle that it shares."""
    rng = random.Random(24)
    def rare(count):
        return [f"w{rng.randrange(10**6)}" for _ in range(count)]

    passage = rare(52)
    parts = [passage[:26]] * 12 + [passage[26:]] * 12 + [passage, [*passage[:25], "other", *passage[26:]]]
    texts = [(rare(60), words, rare(60)) for words in parts]
    docs = documents([(i, " ".join(sum(text, []))) for i, text in enumerate(texts)])
    left = {row.doc_id: row.text for row in corpus_pipeline.without_repeated_passages(spark, docs, "").collect()}
    whole = {i: " ".join(sum(text, [])) for i, text in enumerate(texts)}
    assert left == {**whole, 25: " ".join(texts[25][0] + texts[25][2])}
