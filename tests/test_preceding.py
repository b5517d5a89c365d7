"""Split groups against plain windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchday.operators import split
from matchday.operators.preceding import before, look_back, running_total
from matchday.operators.split import CHUNK, find_cuts, with_chunk

ORDER = ["day", "id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot team, a hot day inside it, small teams, rows without team, null values and null days."""
    draw = random.Random(7)
    rows = []
    for i in range(3_000):
        team = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"t{draw.randrange(60)}"
        day = 5 if draw.random() < 0.4 else draw.randrange(30) if draw.random() < 0.95 else None
        # a side that ends early, so that its last rows are carried over many chunks
        side = "A" if day is not None and day < 3 else draw.choice("HH")
        rows.append((team, side, day, i, None if i % 17 == 0 else draw.randrange(4)))
    return spark.createDataFrame(rows, "team string, side string, day int, id int, v int").cache()


@pytest.mark.parametrize("fanout", [4, 1024])
@pytest.mark.parametrize("rows_per_chunk", [1, 3, 40, 500])
def test_look_back(skewed, same, monkeypatch, rows_per_chunk, fanout):
    monkeypatch.setattr(split, "FANOUT", fanout)

    def add(df, group):
        return df.withColumns(
            {
                "any5": F.sum("v").over(before(group, ORDER, 5)),
                "side5": F.sum("v").over(before([*group, "side"], ORDER, 5)),
                "side2": F.count("v").over(before([*group, "side"], ORDER, 2)),
            }
        )

    cuts = find_cuts(skewed, ["team"], ORDER, rows_per_chunk)
    assert cuts.needed
    got = look_back(skewed, ["team"], ORDER, 5, add, ["v"], ["side"], cuts)
    same(got, add(skewed, ["team"]))


@pytest.mark.parametrize("rows_per_chunk", [1, 3, 40, 500])
def test_running_total(skewed, same, rows_per_chunk):
    cuts = find_cuts(skewed, ["team"], ORDER, rows_per_chunk)
    window = before(["team"], ORDER)
    expected = skewed.withColumns({"a": F.sum("v").over(window), "b": F.sum("id").over(window)})
    same(running_total(skewed, ["team"], ORDER, {"a": "v", "b": "id"}, cuts), expected)


def test_chunks_are_even_and_in_order(skewed):
    cuts = find_cuts(skewed, ["team"], ORDER, 64)
    hot = with_chunk(skewed, cuts).where("team = 'hot'")
    sizes = [row["count"] for row in hot.groupBy(CHUNK).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 3 * 64
    spans = hot.groupBy(CHUNK).agg(F.min(F.struct(*ORDER)).alias("lo"), F.max(F.struct(*ORDER)).alias("hi"))
    rows = sorted(spans.collect(), key=lambda row: row[CHUNK])
    as_key = lambda s: (s["day"] is not None, s["day"] or 0, s["id"])
    assert all(as_key(a["hi"]) < as_key(b["lo"]) for a, b in zip(rows, rows[1:]))


def test_number_of_cuts_is_bounded(skewed):
    cuts = find_cuts(skewed, ["team"], ORDER, 1, max_chunks=20)
    assert cuts.groups.agg(F.sum(split.LAST_CHUNK)).first()[0] <= 20


def test_small_tables_use_the_plain_window(skewed):
    cuts = find_cuts(skewed, ["team"], ORDER)
    assert not cuts.needed and cuts.digits == ()


def test_large_table_of_small_groups_is_not_split(skewed):
    small = skewed.where("team <> 'hot'")
    assert not find_cuts(small, ["team"], ORDER, 400).needed
