from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from conftest import SMALL
from matchday.llm import search as module
from matchday.llm.queries import SQL
from matchday.llm.search import Cell, block_cuts, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, top):
    vectors = [(doc_id, Counter(terms(text)), len(terms(text))) for doc_id, text in documents if terms(text)]
    size, total = len(vectors), sum(n for *_, n in vectors)
    df = Counter(term for _, vector, _ in vectors for term in vector)
    asked = {}
    for item, text in items:
        asked[item] = min(asked.get(item, text), text, key=lambda x: (x or "").encode())
    result = []
    for item, text in asked.items():
        scores = []
        for doc_id, vector, n in vectors:
            m = 100 - 75 + 75 * n * size // total
            score = sum(
                math.floor(1000 * math.log((2 * size + 2) / (2 * df[term] + 1)))
                * (1000000000 * vector[term] // (1000 * vector[term] + 8 * m))
                for term in terms(text) if term in vector
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        ranked = sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top]
        result += [(item, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(ranked, 1)]
    return sorted(map(str, result))


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def tables(seed, documents=400):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 80)))) for i in range(documents)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(150)]
    docs += [(2000, None), (2001, ""), (2002, "-- !\n"), (None, docs[3][1]), (None, "T5 t6,t7"), docs[0], docs[0]]
    docs += [(2003, "Éa é日本x T1\x0bt2_t3"), (2004, "t250 " * 5000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere else"), (53, "t1 t1 t1 T1"), (None, "t9 É"), (54, "a"), (54, "É日本x t2"), (55, "éa Éa")]
    return docs, items


def frames(spark, docs, items):
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(4).selectExpr("*", "1 as key", "2 as terms", "'a' as item_id")
    right = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as body", "2 as doc_id")
    return left, right


@pytest.mark.parametrize("top", [1, 10])
def test_against_all_documents(spark, top):
    docs, items = tables(top)
    assert rows_of(search(*frames(spark, docs, items), top)) == brute(docs, items, top)


def test_groups_of_items(spark, monkeypatch):
    docs, items = tables(5, 100)
    monkeypatch.setattr(module, "ITEM_BYTES", 1000)
    assert rows_of(search(*frames(spark, docs, items))) == brute(docs, items, 10)


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "benchmark"))
    found = search(docs, items).collect()
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    assert sorted(map(tuple, found)) == sorted(con.execute(SQL["op13_search"]).fetchall())


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert search(docs.where("doc_id > 5"), items).collect() == []
    assert search(docs, items.where("doc_id > 5")).collect() == []
    assert rows_of(search(docs, items)) == brute([(1, "a b")], [(1, "a")], 10)


def cell_of(rng, documents, names, spread):
    """A cell whose documents come in families, and the vectors."""
    family = [rng.choice(names, size=8, replace=False) for _ in range(spread)]
    vectors = []
    for i in range(documents):
        own = np.unique(np.append(family[i * spread // documents], rng.choice(names, size=2)))
        vectors.append((own, rng.integers(1, 900_000, len(own))))
    keys = np.sort(rng.integers(0, spread, documents) * 1000)
    starts = np.append(0, np.cumsum([len(own) for own, _ in vectors]))
    flat = [np.concatenate([vector[i] for vector in vectors]) for i in (0, 1)]
    return Cell.built(np.arange(documents), np.zeros(documents, bool), keys, *flat, starts), vectors


@pytest.mark.parametrize("table", [24_000_000, 4_000])
def test_skipped_blocks_hold_nothing_better(monkeypatch, table):
    monkeypatch.setattr(module, "CELL_TABLE", table)
    rng = np.random.default_rng(4)
    cells, vectors = cell_of(rng, 500, np.arange(0, 120, 2), 12)
    cells, opened = list(cells), 0
    assert (len(cells) > 1) == (table < 24_000_000)
    for _ in range(60):
        asked, weights = np.unique(rng.integers(0, 125, 6)), None
        weights = rng.integers(0, 5_000, len(asked))
        query = dict(zip(asked.tolist(), weights.tolist()))
        first = 0
        for cell in cells:
            size = len(cell.ids)
            scores = [sum(query.get(t, 0) * v for t, v in zip(*map(np.ndarray.tolist, vectors[first + i]))) for i in range(size)]
            best = sorted(scores, reverse=True)[:5]
            for least in (1, max(1, best[-1]), best[0] + 1):
                places, found = cell.search(asked, weights, least, 5)
                opened += len(found)
                assert [scores[i] for i in places.tolist()] == found.tolist()
                assert len(set(places.tolist())) == len(places)
                assert sorted(found.tolist(), reverse=True)[:5] == [score for score in best if score >= least]
            first += size


def test_summaries_are_bounds_of_their_blocks():
    cells, _ = cell_of(np.random.default_rng(1), 300, np.arange(50), 5)
    (cell,) = cells
    members = 0
    for term in range(len(cell.terms)):
        for block in range(cell.list_starts[term], cell.list_starts[term + 1]):
            own = cell.members[cell.block_starts[block] : cell.block_starts[block + 1]]
            members += len(own)
            entry = slice(cell.sum_starts[block], cell.sum_starts[block + 1])
            summary = dict(zip(cell.sum_places[entry].tolist(), cell.sum_values[entry].tolist()))
            assert len(own) < module.LEAST and not summary or len(own) >= module.LEAST and summary
            for place in own.tolist():
                vector = slice(cell.starts[place], cell.starts[place + 1])
                assert term in cell.places[vector]
                for one, value in zip(cell.places[vector].tolist(), cell.values[vector].tolist()):
                    assert not summary or summary[one] * module.STEP >= value > 0
    assert members == len(cell.places)


def test_blocks_part_where_keys_differ_first():
    keys = np.array([0, 0, 1, 1, 8, 9, 9, 9, 9, 9, 15])
    assert block_cuts(keys, 4).tolist() == [0, 4, 5, 9, 10]
    assert block_cuts(keys, 100).tolist() == [0]
