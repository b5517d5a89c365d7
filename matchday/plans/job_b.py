"""Feature table B: form at the venue and anywhere, season points and goals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday import schema
from matchday.functions import scalars
from matchday.operators.preceding import before, look_back
from matchday.operators.split import ROWS_PER_CHUNK, find_cuts
from matchday.operators.teams import SIDE, by_match, by_side
from matchday.operators.totals import attach, totals

LAST = 5


def typed(records: DataFrame) -> DataFrame:
    """Text records to matches with points and discipline index."""
    rows = scalars.cast_stats(records, schema.SHORT_STATS)
    return rows.withColumns(
        {
            "MatchDate": scalars.match_date(F.col("Date"), scalars.COMPAT),
            "HomeResultScore": scalars.points(F.col("FTR"), "H"),
            "AwayResultScore": scalars.points(F.col("FTR"), "A"),
            "HDI": scalars.discipline(scalars.CARD_WEIGHTS, F.col("HY"), F.col("HR")),
            "ADI": scalars.discipline(scalars.CARD_WEIGHTS, F.col("AY"), F.col("AR")),
        }
    )


def form(
    matches: DataFrame, key: list[str], rows_per_chunk: int = ROWS_PER_CHUNK, total: int | None = None
) -> DataFrame:
    """The eight last-five columns per match, in one pass over narrow (match, side) rows.

    One shuffle by (season, team) serves the windows over any venue and over the same venue, a
    second one by match brings the two sides together.
    """

    def side(team: str, goals: str, points: str, index: str) -> dict:
        names = {"team": team, "goals": goals, "points": points, "discipline": index}
        return {name: F.col(column) for name, column in names.items()}

    long = by_side(
        matches,
        [*key, "Season", "MatchDate"],
        {
            "H": side("HomeTeam", "FTHG", "HomeResultScore", "HDI"),
            "A": side("AwayTeam", "FTAG", "AwayResultScore", "ADI"),
        },
    )
    entity, order = ["Season", "team"], ["MatchDate", *key, SIDE]

    def add(df: DataFrame, group: list[str]) -> DataFrame:
        anywhere, venue = before(group, order, LAST), before([*group, SIDE], order, LAST)
        return df.withColumns(
            {
                "any5": F.when(F.col("MatchDate").isNotNull(), F.sum("points").over(anywhere)),
                "points5": F.sum("points").over(venue),
                "goals5": F.sum("goals").over(venue),
                "discipline5": F.sum("discipline").over(venue),
            }
        )

    total = matches.count() if total is None else total
    teams = {code: {"team": F.col(team)} for code, team in (("H", "HomeTeam"), ("A", "AwayTeam"))}
    keys = by_side(matches, [*key, "Season", "MatchDate"], teams)
    cuts = find_cuts(keys, entity, order, rows_per_chunk, total=2 * total)
    rows = look_back(long, entity, order, LAST, add, ["points", "goals", "discipline"], [SIDE], cuts)
    return by_match(
        rows,
        key,
        {
            "HGL5": ("H", "goals5"), "AGL5": ("A", "goals5"),
            "HTHF5": ("H", "points5"), "ATAF5": ("A", "points5"),
            "HDIL5": ("H", "discipline5"), "ADIL5": ("A", "discipline5"),
            "HTFL5": ("H", "any5"), "ATFL5": ("A", "any5"),
        },
    )


def season_sums(matches: DataFrame, large: bool) -> DataFrame:
    """Season points and goals by home team and by away team, with their sums and difference.

    The names are kept: HT_PTS_AWAY holds the points of the visitors at that ground.
    """
    home = {"HT_PTS_HOME": "HomeResultScore", "HT_PTS_AWAY": "AwayResultScore", "HTASG": "FTHG"}
    away = {"AT_PTS_AWAY": "AwayResultScore", "AT_PTS_HOME": "HomeResultScore", "ATASG": "FTAG"}
    rows = matches
    for team, sums in (("HomeTeam", home), ("AwayTeam", away)):
        keys = ["Season", team]
        summary = totals(matches, keys, {name: F.col(column) for name, column in sums.items()})
        rows = attach(rows, summary, keys, large)
    return rows.withColumns(
        {
            "HTSP": F.col("HT_PTS_HOME") + F.col("HT_PTS_AWAY"),
            "ATSP": F.col("AT_PTS_HOME") + F.col("AT_PTS_AWAY"),
            "SGD": F.col("HTASG") - F.col("ATASG"),
        }
    )


def features(records: DataFrame, key: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """All 45 columns of table B and the ``key`` columns, from text records.

    ``key`` identifies a match and orders matches of one date: with Kafka, partition and offset.
    Form is brought back by this key. For a feed without copies that equals a join on season, date
    and team, without the products such a join makes of repeated rows.
    """
    matches = typed(records)
    total = matches.count()
    rows = season_sums(matches, total > rows_per_chunk)
    rows = rows.join(form(matches, key, rows_per_chunk, total), key, "left")
    return rows.select(*key, *schema.JOB_B_COLUMNS)
