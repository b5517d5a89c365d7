"""Feature table A: same-venue form of the last five games and league points so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday import schema
from matchday.functions import scalars
from matchday.operators.preceding import before, look_back, running_total
from matchday.operators.split import ROWS_PER_CHUNK, find_cuts

LAST = 5


def typed(records: DataFrame) -> DataFrame:
    """Text records to typed matches of the seasons that the compat filter keeps."""
    rows = scalars.cast_stats(records, schema.STATS)
    rows = rows.withColumn("Date", scalars.match_date(F.col("Date"), scalars.COMPAT, fallback=True))
    return rows.where(scalars.season_from(F.col("Season"), 2008, scalars.COMPAT))


def venue_sums(
    team: str,
    group: list[str],
    order: list[str],
    sums: dict[str, str],
    empty: int | None = None,
):
    """Step for ``look_back``: sums over a team's last five games in this role."""

    def add(df: DataFrame, entity: list[str]) -> DataFrame:
        window = before(entity, order, LAST)
        return df.withColumns(
            {name: or_zero(F.sum(column).over(window), empty) for name, column in sums.items()}
        )

    return {"entity": [*group, team], "order": order, "n": LAST, "add": add, "needs": list(sums.values())}


def or_zero(value: Column, empty: int | None) -> Column:
    return value if empty is None else F.coalesce(value, F.lit(empty))


def features(records: DataFrame, tie: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """All 30 columns of table A and the ``tie`` columns, from text records.

    ``tie`` orders matches of one date and makes the result repeatable: with Kafka, partition and
    offset. The windows run over the records given, so a micro-batch sees itself only.
    """
    matches = typed(records)
    order = ["Date", *tie]
    base = matches.withColumns(
        {
            "GD": scalars.goal_diff(F.col("FTHG"), F.col("FTAG")),
            "_home_points": scalars.points(F.col("FTR"), "H"),
            "_away_points": scalars.points(F.col("FTR"), "A"),
            "_home_index": scalars.discipline(scalars.FOUL_WEIGHTS, F.col("HY"), F.col("HR"), F.col("HF")),
            "_away_index": scalars.discipline(scalars.FOUL_WEIGHTS, F.col("AY"), F.col("AR"), F.col("AF")),
        }
    )
    needed = [name for name in schema.JOB_A_WISHED if name in base.columns]
    helpers = ["_home_points", "_away_points", "_home_index", "_away_index"]
    base = base.select(*dict.fromkeys([*needed, "Season", *tie, *helpers]))

    home = venue_sums(
        "HomeTeam", ["Season"], order,
        {"HGL5": "FTHG", "HTFL5": "_home_points", "HDIL5": "_home_index"}, empty=0,
    )
    away = venue_sums(
        "AwayTeam", ["Season"], order,
        {"AGL5": "FTAG", "ATFL5": "_away_points", "ADIL5": "_away_index"}, empty=0,
    )
    total = base.count()
    season = find_cuts(base, ["Season"], order, rows_per_chunk, total=total)
    rows = running_total(
        base, ["Season"], order, {"_home_before": "_home_points", "_away_before": "_away_points"}, season
    )
    for side in (home, away):
        cuts = find_cuts(base, side["entity"], order, rows_per_chunk, total=total)
        rows = look_back(rows, **side, cuts=cuts, source=base)
    league_points = or_zero(F.col("_home_before"), 0) + or_zero(F.col("_away_before"), 0)
    rows = rows.withColumns({"HTP": league_points, "ATP": league_points})
    return scalars.select_available(rows, [*tie, *schema.JOB_A_WISHED])
