"""Eight hand-sized matches with known results."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from matchday import schema
from matchday.plans import job_a, job_b, strict

# id, date, home, away, fthg, ftag, ftr, hf, af, hy, ay, hr, ar
MATCHES = [
    (1, "2008-08-16", "A", "B", 2, 1, "H", 10, 12, 1, 2, 0, 0),
    (2, "2008-08-17", "C", "D", 0, 0, "D", 8, 9, 0, 1, 0, 1),
    (3, "2008-08-23", "A", "C", 1, 3, "A", 11, 7, 2, 0, 1, 0),
    (4, "2008-08-24", "B", "D", 2, 2, "D", 9, 9, 1, 1, 0, 0),
    (5, "2008-08-30", "A", "D", 4, 0, "H", None, 10, 1, 3, 0, 0),
    (6, "2008-08-31", "B", "A", 0, 1, "A", 12, 8, 2, 1, 0, 0),
    (7, "2008-09-13", "A", "B", 2, 2, "D", 10, 10, 0, 0, 0, 0),
    (8, "2008-09-14", "C", "A", 1, 0, None, 9, 9, 1, 1, 0, 0),
]
NULL = None
EXPECTED = {
    "GD": [1, 0, -2, 0, 4, -1, 0, 1],
    "HomeResultScore": [3, 1, 0, 1, 3, 0, 1, 0],
    "AwayResultScore": [0, 1, 3, 1, 0, 3, 1, 0],
    "HTP": [0, 3, 5, 8, 10, 13, 16, 18],
    "HGL5": [NULL, NULL, 2, NULL, 3, 2, 7, 0],
    "AGL5": [NULL, NULL, NULL, 0, 2, NULL, 1, 1],
    "HTHF5": [NULL, NULL, 3, NULL, 3, 1, 6, 1],
    "ATAF5": [NULL, NULL, NULL, 1, 2, NULL, 0, 3],
    "HDIL5_fouls": [NULL, NULL, 30, NULL, 97, 28, 97, 16],
    "ADIL5_fouls": [NULL, NULL, NULL, 53, 81, NULL, 44, 26],
    "HDIL5": [NULL, NULL, 5, NULL, 40, 5, 45, 0],
    "ADIL5": [NULL, NULL, NULL, 30, 35, NULL, 10, 5],
    "HTFL5": [NULL, NULL, 3, 0, 3, 1, 9, 4],
    "ATFL5": [NULL, NULL, 1, 1, 2, 6, 1, 10],
    "HT_PTS_HOME": [7, 1, 7, 1, 7, 1, 7, 1],
    "HT_PTS_AWAY": [4, 1, 4, 4, 4, 4, 4, 1],
    "HTSP": [11, 2, 11, 5, 11, 5, 11, 2],
    "AT_PTS_AWAY": [1, 2, 3, 2, 2, 3, 1, 3],
    "AT_PTS_HOME": [4, 5, 0, 5, 5, 0, 4, 0],
    "ATSP": [5, 7, 3, 7, 7, 3, 5, 3],
    "HTASG": [9, 1, 9, 2, 9, 2, 9, 1],
    "ATASG": [3, 2, 3, 2, 2, 1, 3, 1],
    "SGD": [6, -1, 6, 0, 7, 1, 6, 0],
}
STRICT = {
    "home_points_before": [0, 0, 3, 0, 3, 1, 9, 4],
    "away_points_before": [0, 0, 1, 1, 2, 6, 1, 10],
    "home_season_points": [10, 4, 10, 2, 10, 2, 10, 4],
    "away_season_points": [2, 2, 4, 2, 2, 10, 2, 10],
}


def records(spark, season="0809"):
    """The matches as text records."""
    fields = "id int, date string, HomeTeam string, AwayTeam string, FTHG int, FTAG int, FTR string, " + (
        "HF int, AF int, HY int, AY int, HR int, AR int"
    )
    rows = spark.createDataFrame(MATCHES, fields)
    given = {name: F.col(name).cast("string") for name in rows.columns if name not in ("id", "date")}
    given["Date"] = F.date_format(F.to_date("date"), "dd/MM/yyyy")
    given["Season"], given["League"], given["Div"] = F.lit(season), F.lit("E0"), F.lit("E0")
    return rows.select(
        "id",
        *[given.get(name, F.lit(None).cast("string")).alias(name) for name in schema.MESSAGE_FIELDS],
    )


def matches(spark):
    rows = spark.createDataFrame(
        [(m[0], datetime.datetime.fromisoformat(m[1]), *m[2:]) for m in MATCHES],
        "match_id bigint, match_ts timestamp_ntz, home_team string, away_team string, fthg int, ftag int,"
        "ftr string, hf int, af int, hy int, ay int, hr int, ar int",
    )
    return rows.withColumns(
        {"match_date": F.to_date("match_ts"), "season": F.lit("0809"), "league": F.lit("E0")}
    )


def values(df, column, key="id"):
    return [row[column] for row in df.orderBy(key).select(key, column).collect()]


@pytest.mark.parametrize("rows_per_chunk", [1_000, 2])
def test_table_b(spark, rows_per_chunk):
    table = job_b.features(records(spark), ["id"], rows_per_chunk).cache()
    assert table.columns == ["id", *schema.JOB_B_COLUMNS]
    for name in schema.JOB_B_COLUMNS:
        if name in EXPECTED:
            assert values(table, name) == EXPECTED[name], name


@pytest.mark.parametrize("rows_per_chunk", [1_000, 2])
def test_table_a(spark, rows_per_chunk):
    # the compat filter compares the code, so the season has to be 2008 or more as a number
    table = job_a.features(records(spark, "2122"), ["id"], rows_per_chunk).cache()
    assert len(table.columns) == 31 and "Season" not in table.columns
    names = {"HTFL5": "HTHF5", "ATFL5": "ATAF5", "HDIL5": "HDIL5_fouls", "ADIL5": "ADIL5_fouls", "ATP": "HTP"}
    for name in ["GD", "HTP", "ATP", "HGL5", "AGL5", "HTFL5", "ATFL5", "HDIL5", "ADIL5"]:
        expected = [value if value is not None else 0 for value in EXPECTED[names.get(name, name)]]
        assert values(table, name) == expected, name


def test_table_a_drops_codes_below_2008(spark):
    assert job_a.features(records(spark, "0809"), ["id"]).count() == 0


@pytest.mark.parametrize("rows_per_chunk", [1_000, 2])
def test_strict(spark, rows_per_chunk):
    table = strict.features(matches(spark), rows_per_chunk).cache()
    # the match without a result is left out, and it had no points to count
    assert values(table, "match_id", "match_id") == [1, 2, 3, 4, 5, 6, 7]
    for name, expected in STRICT.items():
        got = values(table, name, "match_id")
        assert [value or 0 for value in got] == expected[:7], name


def test_strict_by_natural_key(spark, same):
    key = ["season", "league", "match_date", "home_team", "away_team"]
    by_id = strict.features(matches(spark))
    by_key = strict.features(matches(spark), key=key, time=["match_date"])
    same(by_id, by_key)


def test_tables_differ_in_what_they_call_form(spark):
    """HTFL5 is same-venue form in table A and any-venue form in table B."""
    a = values(job_a.features(records(spark, "2122"), ["id"]), "HTFL5")
    b = values(job_b.features(records(spark, "2122"), ["id"]), "HTFL5")
    assert a != [value or 0 for value in b]
