from __future__ import annotations

import random

from pyspark.sql import functions as F

from matchday.operators import teams

MATCHES = "match_id long, season string, day int, home string"
ROWS = "season string, day int, team string, points int"


def test_attach_by_date_is_the_join(spark, same, monkeypatch):
    """All rows of a team's date for each match of it, copies, nulls and matches that find nothing included."""
    rng = random.Random(5)
    one_of = lambda *values: rng.choice([*values, None])
    matches = spark.createDataFrame(
        [(rng.randrange(60), one_of("a", "b"), one_of(1, 2, 9), one_of("x", "y")) for _ in range(80)], MATCHES
    )
    long = spark.createDataFrame([(one_of("a", "b"), one_of(1, 2), one_of("x", "y"), one_of(0, 1, 3)) for _ in range(300)], ROWS)
    right = long.select(*[F.col(name).alias(f"r_{name}") for name in ("season", "day", "team")], F.col("points").alias("form"))
    equal = [F.col("season") == F.col("r_season"), F.col("day") == F.col("r_day"), F.col("home") == F.col("r_team")]
    joined = matches.join(right, equal, "left").select(*matches.columns, "form")
    assert joined.count() > 200 and joined.where("form is null").count() > 10
    for at_once in (1, 3, 4096):
        monkeypatch.setattr(teams, "TIMES_AT_ONCE", at_once)
        same(teams.attach_by_date(matches, long, ["season", "day"], "home", {"form": "points"}), joined)


def test_rows_of_a_date_meet_by_their_values(spark, monkeypatch):
    """A match meets each value of its team's date once, however many rows have it."""
    matches = spark.range(50).selectExpr("id as match_id", "'a' as season", "1 as day", "'x' as home")
    long = spark.range(400).selectExpr("'a' as season", "1 as day", "'x' as team", "cast(id % 4 as int) as points")
    met, real = [], teams.repeated

    def noted(df, times):
        met.append(df.count())
        return real(df, times)

    monkeypatch.setattr(teams, "repeated", noted)
    found = teams.attach_by_date(matches, long, ["season", "day"], "home", {"form": "points"})
    assert met == [200]
    assert found.columns == ["match_id", "season", "day", "home", "form"]
    counts = {(r.match_id, r.form): r["count"] for r in found.groupBy("match_id", "form").count().collect()}
    assert counts == {(i, form): 100 for i in range(50) for form in range(4)}
