from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from conftest import SMALL
from llm.conftest import corpus, prose
from matchday.llm.components import components
from matchday.llm.minhash import distinct_shingles, near_duplicates, signatures, without_copies
from matchday.llm.shared import BATCH_ROWS, stored
from matchday.llm.words import word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(size, len(words)) or 1
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    """{(doc_id, text): (n_shingles, component_id, kept)} by all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    found = {}
    for i, (doc_id, text) in enumerate(rows):
        component = lowest.get(find(i)) if sets[i] else doc_id
        found[doc_id, text] = (len(sets[i]), component, doc_id == component)
    return found


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, documents, size):
    rows = corpus()
    result = near_duplicates(documents(rows), size, 80).drop("text_key").collect()
    expected = brute(rows, size, 80)
    assert sorted(map(str, (tuple(r) for r in result))) == sorted(
        str((doc_id, *expected[doc_id, text])) for doc_id, text in rows
    )


def test_given_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    expected = brute(rows, 2, 80)
    result = near_duplicates(table, 2, 80).drop("text_key").collect()
    assert sorted(tuple(r) for r in result) == sorted((doc_id, *expected[doc_id, text]) for doc_id, text in rows)


def test_links_beside_the_first_node(spark, documents):
    """Chains of copies, each a little further, and a bucket whose first node is like none of the others."""
    import random

    rng = random.Random(2)
    words = prose(rng, 200, 10_000).split()
    rows = []
    for i in range(60):
        for _ in range(4):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**9)}"
        rows.append((rng.randrange(10**9), " ".join(words)))
    result = near_duplicates(documents(rows), 2, 80).drop("text_key").collect()
    expected = brute(rows, 2, 80)
    assert sorted(tuple(r) for r in result) == sorted((doc_id, *expected[doc_id, text]) for doc_id, text in rows)


def test_empty(spark, documents):
    empty = documents([])
    assert near_duplicates(empty).collect() == []
    assert without_copies(empty).columns == empty.columns


def test_without_copies(spark, documents):
    rows = corpus()
    docs = documents(rows)
    left = without_copies(docs)
    expected = brute(rows, 5, 80)
    assert left.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(
        str((doc_id, text)) for doc_id, text in rows if expected[doc_id, text][2]
    )


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    off = []
    for n in (3, 20, 300, 3000):
        for share in (0.2, 0.5, 0.8):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.int64).astype(np.uint64)
            common = int(round(share * n))
            one, other = pool[:n], np.concatenate([pool[:common], pool[n : 2 * n - common]])
            real = common / (2 * n - common)
            a, b = signatures([one, other], 1024)
            off.append(((a == b).mean() - real) / np.sqrt(real * (1 - real) / 1024 + 1e-9))
    assert max(map(abs, off)) < 4


def test_signature_by_definition():
    """Each element gives every place its rank and a fraction; places take the least."""
    elements = distinct_shingles(b"a b c d e f g", 2)
    alone = np.stack([signatures([elements[i : i + 1]], 16)[0] for i in range(len(elements))])
    assert all(sorted((row >> np.uint64(48)).tolist()) == list(range(16)) for row in alone)
    assert (signatures([elements], 16)[0] == alone.min(axis=0)).all()


def test_components(spark):
    import random

    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, rng.randrange(8, 60)) for _ in range(30)]
    links += [(200, 200), (301, 300), (300, 301), (300, 301)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161))
    assert all(found[b] == 7 for a, b in links if a == 7)
    assert found[301] == found[300] == 300
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_word_hashes():
    texts = [b"", None, b" \n ", b"a", b"A a A \x00b", b"x" * 100 + b" y\x0b" + b"x" * 99, b"x" * 64 + b" " + b"x" * 65]
    texts += ["wörter ÄÖ, über\u00a0alles 漢字 ".encode() * 3, b"abcdefgh abcdefghi abcdefg\x00 abcdefg"]
    known: dict[bytes, int] = {}
    for text in texts:
        words, hashes = (text or b"").lower().split(), word_hashes(text).tolist()
        assert len(words) == len(hashes)
        assert all(known.setdefault(word, value) == value for word, value in zip(words, hashes))
    assert len(set(known.values())) == len(known)


def test_rows_that_hold_much_come_in_small_batches(spark):
    """Batches have as many rows as asked for at most, and the session's own setting holds again afterwards."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(BATCH_ROWS)
    made = [stored(spark.range(5_000).mapInArrow(sizes, "n long"), "sizes", at_once) for at_once in (1_000, None)]
    few, all_rows = ([row.n for row in table.collect()] for table in made)
    assert max(few) <= 1_000 and sum(few) == sum(all_rows) == 5_000
    assert spark.conf.get(BATCH_ROWS) == before
