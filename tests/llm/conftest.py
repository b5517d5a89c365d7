from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    """Documents from (doc_id, text) or whole rows, with a column whose name operators use too."""
    whole = [
        row if len(row) == 5 else (row[0], row[1], "en", "s", None if row[1] is None else len(row[1])) for row in rows
    ]
    df = spark.createDataFrame(whole, SCHEMA).repartition(3)
    return df.selectExpr("*", "1 as node", "2 as strength", "3 as _doc", "'x' as text_key", "4 as part")


@pytest.fixture
def documents(spark):
    return lambda rows: make(spark, rows)


def prose(rng: random.Random, count: int, words: int = 400) -> str:
    vocabulary = [f"w{i}" for i in range(words)]
    return " ".join(rng.choices(vocabulary, k=count))


ODD_TEXTS = [None, "", "  \n\t ", "One", "one two", "ONE two", "é ü x", "a\x1cb c", "x " * 3, "\n\nline\nline\n line\n"]


def corpus(seed: int = 7) -> list[tuple]:
    """Odd texts, copies, near copies, shared passages, a long text, repeated rows, and rows without id."""
    rng = random.Random(seed)
    texts = list(ODD_TEXTS)
    base = [prose(rng, n) for n in (30, 60, 120, 200, 200, 300)]
    texts += base + base[:3]
    for text in base[2:] * 4:
        words = text.split()
        for _ in range(rng.choice([1, 2, 4, 9])):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    passage = prose(rng, 70)
    for _ in range(5):
        texts.append(f"{prose(rng, rng.randrange(5, 80))} {passage} {prose(rng, rng.randrange(5, 80))}")
    texts.append(prose(rng, 20_000, 5_000))
    rows = [(i * 3, text) for i, text in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[0], rows[5], (None, base[2]), (None, None), (None, "alone " + prose(rng, 90))]
