from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SMALL
from llm.conftest import corpus
from matchday.llm.components import components
from matchday.llm.simhash import fingerprint, linked, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(len(words) - size + 1) if size
    ]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_roots(marks):
    """Smallest member of each mark's component, by all pairs."""
    root = {mark: mark for mark in marks}

    def find(mark):
        while root[mark] != mark:
            mark = root[mark]
        return mark

    for one, other in combinations(sorted(root), 2):
        if (one ^ other).bit_count() <= 3:
            low, high = sorted((find(one), find(other)))
            root[high] = low
    return {mark: find(mark) for mark in root}


def brute(rows):
    marks = [brute_fingerprint(text) for _, text in rows]
    roots, lowest = brute_roots(marks), {}
    for (doc_id, _), mark in zip(rows, marks):
        if doc_id is not None:
            lowest[roots[mark]] = min(doc_id, lowest.get(roots[mark], doc_id))
    return [(doc_id, f"{mark:016x}", lowest.get(roots[mark])) for (doc_id, _), mark in zip(rows, marks)]


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_hash_is_the_one_spark_has(spark):
    text = "Ähre b c"
    word = spark.range(1).select(F.xxhash64(F.lit("Ähre b c"))).first()[0]
    assert fingerprint(text.encode()) == word % 2**64


def test_against_all_pairs(spark, documents):
    rows = corpus()
    assert rows_of(near_duplicates(documents(rows))) == sorted(map(str, brute(rows)))


def test_given_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(row) for row in table.select("doc_id", "text").collect()]
    assert rows_of(near_duplicates(table)) == sorted(map(str, brute(rows)))


def walks(seed, families, steps):
    """Marks in families whose members differ from an earlier one by 0 to 5 bits."""
    rng = random.Random(seed)
    marks = []
    for _ in range(families):
        family = [rng.getrandbits(64)]
        for _ in range(steps):
            mark = rng.choice(family)
            for bit in rng.sample(range(64), rng.randrange(6)):
                mark ^= 1 << bit
            family.append(mark)
        marks += family
    return [*marks, 0, 1, 7, 15, 2**64 - 1, 2**64 - 8, 2**63, 2**63 + 3]


# crowd 4 sends nearly all, 40 some of the marks to the ball of two bits
@pytest.mark.parametrize("crowd", [4, 40, 4096])
def test_links_connect_what_all_pairs_connect(spark, crowd):
    marks = set(walks(3, 25, 25))
    signed = [mark - 2**64 if mark >= 2**63 else mark for mark in marks]
    links = linked(spark.createDataFrame([(mark,) for mark in signed], "mark long").repartition(3), crowd)
    pairs = [(a % 2**64, b % 2**64) for a, b in links.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    groups = {}
    for node, root in components(links).collect():
        groups.setdefault(root, set()).add(node % 2**64)
    wanted = {}
    for mark, root in brute_roots(marks).items():
        wanted.setdefault(root, set()).add(mark)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(own) for own in wanted.values() if len(own) > 1)


def test_every_pair_of_three_bits_is_found(spark):
    rng = random.Random(5)
    pairs = []
    for bits in [(0, 20, 63), (20, 21, 22), (0, 1, 2), (41, 42, 43), (5, 30, 60), (61, 62, 63)]:
        mark = rng.getrandbits(63)
        pairs.append((mark, mark ^ sum(1 << bit for bit in bits)))
    rows = [(mark - 2**64 if mark >= 2**63 else mark,) for pair in pairs for mark in pair]
    found = {frozenset((a % 2**64, b % 2**64)) for a, b in linked(spark.createDataFrame(rows, "mark long")).collect() if a != b}
    assert found == set(map(frozenset, pairs))


def test_group_of_many_near_copies(spark, documents):
    """A third of the rows are near copies of one text; all partitions and batches meet."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(4000)]
    rows = []
    for i in range(300):
        words = list(base)
        words[rng.randrange(len(words))] = f"e{i}"
        rows.append((i, " ".join(words) if i % 3 == 0 else f"alone {i} " + " ".join(rng.choices(base, k=60))))
    assert rows_of(near_duplicates(documents(rows))) == sorted(map(str, brute(rows)))


def test_empty_table(spark, documents):
    assert near_duplicates(documents([(1, "a")]).where("doc_id > 5")).collect() == []
    assert rows_of(near_duplicates(documents([(2, None), (1, ""), (None, " "), (3, "a b")]))) == sorted(
        map(str, brute([(2, None), (1, ""), (None, " "), (3, "a b")]))
    )
