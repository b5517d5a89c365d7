from __future__ import annotations

import random
import re

from conftest import SMALL
from llm.conftest import SCHEMA, corpus
from matchday.llm.mixing import mixed, sized, take_copies, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Targets as they are told: share by weight, cut at the cap, give on what is left, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        rest = [s for s in order if s not in full]
        whole = sum(weight[s] for s in rest)
        goal = {s: left * weight[s] / whole for s in rest}
        above = [s for s in rest if goal[s] > cap * sizes[s]]
        if not above:
            return full | goal
        full |= {s: cap * sizes[s] for s in above}


def rows_of(seed=1, hot=True):
    rng = random.Random(seed)
    sources = ["s", "b", "\u00e9", "Z", "a b", None, ""]
    rows = []
    for i, (doc_id, text) in enumerate(corpus()):
        rows.append((doc_id, text, None, sources[0] if hot and i % 3 else rng.choice(sources), 1))
    for i in range(600):
        rows.append((1000 + i, "w " * rng.randint(0, 90), "en", rng.choice(sources), 0))
    rows.append((5000, None, "en", "empty", 0))
    return rows


def check(rows, result, near=0.01):
    sizes, found = {}, {}
    for doc_id, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    goal = shares(sizes)
    assert len(result) == len(rows)
    for r in result:
        assert r.source_size == sizes[r.source] and abs(r.target - goal[r.source]) < 1e-6 * (1 + goal[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        found.setdefault(r.source, []).append(r)
    for source, own in found.items():
        off = abs(sum(r.taken for r in own) - goal[source])
        assert off <= max(near * goal[source], min((r.size for r in own if r.size), default=0)), (source, off, goal[source])


def test_rules_and_reruns(spark):
    rows = rows_of()
    table = spark.createDataFrame(rows, SCHEMA)
    result = mixed(table.selectExpr("*", "1 as size", "2 as target")).collect()
    check(rows, result)
    again = mixed(table.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, result))


def test_given_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    # ten documents a source
    check(rows, mixed(table).collect(), near=0.1)


def test_targets(spark):
    rng = random.Random(2)
    for _ in range(5):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 10**6]) for i in range(rng.randint(1, 12))} | {None: 5}
        table = spark.createDataFrame([(1, s, n) for s, n in sizes.items()], "doc_id long, source string, size long")
        found = {r.source: r.target for r in targets(table).collect()}
        expected = shares(sizes)
        assert found.keys() == expected.keys()
        assert all(abs(found[s] - expected[s]) <= 1e-9 * (1 + expected[s]) for s in found)


def test_long_documents_follow_the_tilt(spark):
    """A source that is taken more than once takes long documents more often, and the other way round."""
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 60), "en", "ab"[i % 2], 0) for i in range(2000)]
    result = mixed(spark.createDataFrame(rows, SCHEMA), weights=(2, 1), share=1.2).collect()
    mean = {}
    for source in "ab":
        own = [r for r in result if r.source == source]
        for name, part in (("short", [r for r in own if r.size < 20]), ("long", [r for r in own if r.size > 40])):
            mean[source, name] = sum(r.copies for r in part) / len(part)
    assert 2 > mean["a", "long"] > mean["a", "short"] > 1 and mean["b", "long"] < mean["b", "short"] < 1


def test_copies_are_taken(spark, documents):
    docs = documents([row for row in corpus() if row[0] is not None])
    mix = mixed(docs)
    taken = take_copies(docs, mix)
    assert taken.columns == docs.columns
    words = sized(taken).groupBy().sum("size").first()[0]
    assert words == mix.groupBy().sum("taken").first()[0]


def test_empty(spark, documents):
    docs = documents([])
    assert mixed(docs).collect() == [] and take_copies(docs, mixed(docs)).collect() == []
