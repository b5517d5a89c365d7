"""Pre-match features that mean what their names say.

Form, points and goals of a match use earlier matches only. The league is part of every group,
matches without a result take no place among the last five, and matches of the same day do not
count towards points so far.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.functions import scalars
from matchday.operators.preceding import before, look_back
from matchday.operators.split import ROWS_PER_CHUNK, Cuts, find_cuts
from matchday.operators.teams import SIDE, by_match, by_side
from matchday.operators.totals import attach, totals, totals_before_day

LAST = 5
GROUP = ["season", "league", "team"]
KEY = ["match_id"]
TIME = ["match_ts"]
DAY = "match_date"
IN_FRAME = ("points", "goals", "discipline")
PER_SIDE = [
    "form5_any", "form5_venue", "goals5_venue", "discipline5_venue",
    "points_before", "goals_before", "conceded_before", "season_points",
]


def team_rows(
    matches: DataFrame,
    weights: dict[str, int] = scalars.CARD_WEIGHTS,
    key: list[str] = KEY,
    time: list[str] = TIME,
    values: tuple[str, ...] = ("points", "goals", "conceded", "discipline"),
) -> DataFrame:
    """Two rows per match: what each team got out of it.

    Only the named ``values`` are made: Spark does not prune fields that are built in an explode.
    """

    def side(code: str, team: str, goals: str, conceded: str, letter: str) -> dict[str, Column]:
        made = {
            "points": scalars.points(F.col("ftr"), code),
            "goals": F.col(goals),
            "conceded": F.col(conceded),
            "discipline": scalars.discipline(
                weights, F.col(f"{letter}y"), F.col(f"{letter}r"), F.col(f"{letter}f")
            ),
        }
        return {"team": F.col(team), **{name: made[name] for name in values}}

    return by_side(
        matches,
        list(dict.fromkeys([*key, *time, DAY, "season", "league"])),
        {
            "H": side("H", "home_team", "fthg", "ftag", "h"),
            "A": side("A", "away_team", "ftag", "fthg", "a"),
        },
    )


def row_order(key: list[str], time: list[str]) -> list[str]:
    """Order of a team's rows; the last columns only decide between equal times."""
    return [name for name in dict.fromkeys([*time, *key, SIDE]) if name not in GROUP]


def last_five(teams: DataFrame, order: list[str], cuts: Cuts) -> DataFrame:
    """Add form, goals and discipline over the team's five rows before each one."""

    def add(df: DataFrame, group: list[str]) -> DataFrame:
        anywhere, venue = before(group, order, LAST), before([*group, SIDE], order, LAST)
        return df.withColumns(
            {
                "form5_any": F.sum("points").over(anywhere),
                "form5_venue": F.sum("points").over(venue),
                "goals5_venue": F.sum("goals").over(venue),
                "discipline5_venue": F.sum("discipline").over(venue),
            }
        )

    return look_back(teams, GROUP, order, LAST, add, list(IN_FRAME), [SIDE], cuts)


def by_day(teams: DataFrame) -> DataFrame:
    """Per team and day: points and goals up to the day before (null on a team's first day), and
    the points of the whole season."""
    sums = {"points_before": "points", "goals_before": "goals", "conceded_before": "conceded"}
    return totals_before_day(
        teams,
        GROUP,
        DAY,
        {name: F.col(column) for name, column in sums.items()},
        whole={"season_points": "points_before"},
    )


def season_points(teams: DataFrame) -> DataFrame:
    """Per team: points of the whole season, home and away."""
    return totals(teams, GROUP, {"season_points": F.col("points")})


def features(
    matches: DataFrame,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    weights: dict[str, int] = scalars.CARD_WEIGHTS,
    key: list[str] = KEY,
    time: list[str] = TIME,
) -> DataFrame:
    """One row per played match, with ``home_`` and ``away_`` columns for each name in PER_SIDE.

    ``key`` identifies a match, ``time`` orders matches and ``key`` decides between equal times.
    """
    played = matches.where(F.col("ftr").isNotNull())
    teams = team_rows(played, weights, key, time, IN_FRAME)
    order = row_order(key, time)
    # where groups are cut does not matter, so the keys of all matches do, and cost less to read
    total = 2 * matches.count()
    cuts = find_cuts(team_rows(matches, key=key, time=time, values=()), GROUP, order, rows_per_chunk, total=total)
    rows = last_five(teams, order, cuts)
    results = team_rows(played, key=[], time=[], values=("points", "goals", "conceded"))
    rows = attach(rows, by_day(results), [*GROUP, DAY], total > rows_per_chunk, null_safe=[DAY])
    sides = {"home": "H", "away": "A"}
    per_match = by_match(
        rows,
        key,
        {f"{name}_{column}": (code, column) for name, code in sides.items() for column in PER_SIDE},
    )
    # null-safe and to the left: a match whose key has a null is a match, too
    names = {name: f"_{name}" for name in key}
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()])
    joined = played.join(per_match.withColumnsRenamed(names), same, "left").drop(*names.values())
    return joined.withColumn(
        "goal_diff_before",
        (F.col("home_goals_before") - F.col("home_conceded_before"))
        - (F.col("away_goals_before") - F.col("away_conceded_before")),
    )
