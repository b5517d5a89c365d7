from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from conftest import SMALL
from matchday.llm.phrases import collocations
from matchday.llm.pieces import Words, byte_table
from matchday.llm.queries import SQL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support, top):
    """Everything by counting all runs of one to four words."""
    totals, counts = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    result = []
    for lang, own in counts.items():
        candidates = [phrase for phrase, count in own.items() if len(phrase) > 1 and count >= support]
        scored = []
        for phrase in candidates:
            a = own[phrase]
            if any(
                len(other) > len(phrase) and 100 * own[other] >= 80 * a
                and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for other in candidates
            ):
                continue
            cuts = [(2000000 * a // (own[phrase[:k]] + own[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), own[phrase[:k]], own[phrase[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(result)


def texts(seed, count):
    rng = random.Random(seed)
    words = ["the", "of", "The", "New", "York", "city", "é", "ÉÜ", "x\x01y", " ", "b-c", "ß", "it's", "日本"]
    marks = [" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "!", " ? ", ";", ":"]
    rows = []
    for i in range(count):
        picked = [rng.choice(words) if rng.random() < 0.8 else f"r{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        text = "".join(word + rng.choice(marks) for word in picked)
        if rng.random() < 0.4:
            text += " new york city of the " * rng.randrange(1, 4)
        rows.append((i, text, rng.choice(["en", "en", "de", None, "und", ""])))
    return [*rows, (None, None, "en"), (1, "", None), (2, " \t\n..", "xx"), rows[0], rows[0], (9, "aa " * 500, "one")]


def frame(spark, rows):
    whole = [(doc_id, text, lang, "s", 0) for doc_id, text, lang in rows]
    return spark.createDataFrame(whole, SCHEMA).repartition(3).selectExpr("*", "1 as n", "'z' as phrase", "2 as w1", "3 as size")


# few buckets are all full, so that nothing is pruned
@pytest.mark.parametrize(("support", "top", "buckets"), [(3, 2000, 20), (5, 7, 12), (2, 50, 3)])
def test_against_all_runs(spark, support, top, buckets):
    rows = texts(support, 150)
    found = collocations(frame(spark, rows), support=support, top=top, buckets=buckets)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, support, top)


def test_support_beyond_a_byte(spark):
    rows = [(i, "one two three. two three four", "en") for i in range(300)]
    found = collocations(frame(spark, rows), support=300, buckets=10)
    assert sorted(tuple(row) for row in found.collect()) == brute(rows, 300, 2000)


def test_given_documents(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [tuple(row) for row in table.select("doc_id", "text", "lang").collect()]
    found = sorted(tuple(row) for row in collocations(table, support=8).collect())
    assert found and found == brute(rows, 8, 2000)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    answer = con.execute(SQL["op11_phrases"].replace(">= 30", ">= 8")).fetchall()
    assert sorted(answer) == found


def test_empty_table(spark):
    assert collocations(frame(spark, [(1, "a b", "en")]).where("doc_id > 5"), buckets=8).collect() == []


def test_words_of_many_texts():
    table = byte_table(b"\t", b".")
    words = Words([b"", b"A b", b"b.\tC\xc3\x89", b" ", b"a"], table)
    named = [words.dictionary[i].as_py() for i in words.ids.tolist()]
    assert named == [b"a", b"b", b"b", b"c\xc3\x89", b"a"]
    assert words.text.tolist() == [1, 1, 2, 2, 4]
    assert words.joined.tolist() == [True, False, False, False, False]
    assert len(Words([], table).ids) == len(Words([b"", b". "], table).ids) == 0
