"""Sums kept across batches against sums over all rows."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from matchday.streaming import running_totals, snapshots
from matchday.streaming.running_totals import LEVELS, add_up, blocks_of, blocks_up_to, totals_before

SCHEMA = "id int, grp string, day date, points int, goals bigint"
SUMS = ["points", "goals"]


def test_blocks_make_up_prefixes(spark):
    """A day lies in exactly one of the blocks of every prefix that holds it, and in none of the others."""
    days = [1, 2, 3, 7, 8, 9, 100, 733_000, 733_001, (1 << LEVELS) - 1]
    df = spark.createDataFrame([(day,) for day in days], "day bigint")
    rows = df.select("day", blocks_of(F.col("day")).alias("of"), blocks_up_to(F.col("day")).alias("to")).collect()
    assert max(len(row["of"]) for row in rows) <= LEVELS + 1
    for row in rows:
        assert sum(end & -end for end in row["to"]) == row["day"]
        for other in rows:
            assert len(set(row["of"]) & set(other["to"])) == (row["day"] <= other["day"])
        assert 1 << LEVELS in row["of"]


def brute(rows, asked):
    """rows: newest by id. Sums over earlier days, and over all."""
    result = []
    for grp, day in asked:
        own = [r for r in rows.values() if r[1] == grp and (r[3] is not None or r[4] is not None)]
        early = [r for r in own if day is not None and r[2] is not None and r[2] < day]
        made = [sum(r[i] or 0 for r in part) if part else None for part, i in ((early, 3), (early, 4), (own, 3))]
        result.append((grp, day, *made))
    return sorted(map(str, result))


def random_rows(rng, count):
    start = date(1999, 12, 20)
    return [
        (
            rng.randrange(60), rng.choice(["a", "a", "a", "b", None, ""]),
            None if rng.random() < 0.05 else start + timedelta(days=rng.randrange(-40, 40)),
            None if rng.random() < 0.2 else rng.randrange(-3, 9), None if rng.random() < 0.2 else rng.randrange(5),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("compact_after", [None, 2])
def test_late_and_corrected_rows(spark, tmp_path, compact_after):
    rng = random.Random(compact_after or 1)
    table = str(tmp_path / "table")
    write = add_up(table, ["id"], ["grp"], "day", SUMS)
    newest = {}
    for number in range(5):
        batch = {row[0]: row for row in random_rows(rng, 25)}
        newest |= batch
        df = spark.createDataFrame(list(batch.values()), SCHEMA).withColumn("more", F.lit(1))
        write(df, number)
        write(df, number)
        if number == compact_after:
            running_totals.compact(spark, table, ["id"], ["grp"], SUMS)
            assert snapshots.vacuum(spark, table, running_totals.PARTS) == 9
    asked = [(grp, day) for grp in ("a", "b", None, "", "none") for day in (date(1999, 12, 1), date(2000, 1, 5), date(9999, 12, 31), date(1, 1, 1), None)]
    df = spark.createDataFrame(asked, "grp string, day date").withColumn("points", F.lit("x"))
    found = totals_before(spark, table, df, ["grp"], "day", {"p": "points", "g": "goals"}, {"all_p": "points"})
    got = sorted(str(tuple(row)) for row in found.select("grp", "day", "p", "g", "all_p").collect())
    assert got == brute(newest, asked)
    # repeated rows stay, each with its sums
    assert totals_before(spark, table, df.union(df), ["grp"], "day", {"p": "points"}).count() == 2 * len(asked)


def test_a_late_row_changes_few_sums(spark, tmp_path):
    table = str(tmp_path / "table")
    write = add_up(table, ["id"], ["grp"], "day", SUMS)
    rows = [(i, "a", date(2000, 1, 1) + timedelta(days=i), 1, 1) for i in range(300)]
    write(spark.createDataFrame(rows, SCHEMA), 0)
    write(spark.createDataFrame([(999, "a", date(2000, 1, 2), 5, 0)], SCHEMA), 1)
    log = snapshots.read_log(spark, table)
    assert snapshots.read(spark, table, "sums", log[1:]).count() <= LEVELS + 1
    # the same row again as another batch changes none
    write(spark.createDataFrame([(999, "a", date(2000, 1, 2), 5, 0)], SCHEMA), 2)
    assert snapshots.read(spark, table, "sums", snapshots.read_log(spark, table)[2:]).count() == 0


def test_nothing_yet(spark, tmp_path):
    table = str(tmp_path / "table")
    empty = spark.createDataFrame([], SCHEMA)
    add_up(table, ["id"], ["grp"], "day", SUMS)(empty, 0)
    assert running_totals.compact(spark, table, ["id"], ["grp"], SUMS) is None
    with pytest.raises(ValueError):
        totals_before(spark, table, empty, ["grp"], "day", {"p": "points"})
