"""The registered queries. Each reads whole tables from ``folder`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday import schema
from matchday.functions import scalars
from matchday.operators import records as whole
from matchday.operators.preceding import before, look_back, running_total
from matchday.operators.split import ROWS_PER_CHUNK, find_cuts
from matchday.operators.teams import SIDE, attach_by_date, by_match, by_side
from matchday.operators.totals import attach, totals, totals_before_day
from matchday.plans import job_a, job_b, strict
from matchday.sources.fixture import matches, records
from matchday.sources.messages import land, land_flagged, to_messages

ORDER = ["match_ts", "match_id"]
KEY = ["season", "league"]
FIRST_YEAR, LAST_YEAR = 2008, 2023


def json_landing(spark: SparkSession, folder: str) -> DataFrame:
    sent = to_messages(matches(spark, folder).drop("match_ts"))
    arrived = sent.select(F.col("value").cast("binary").alias("value"))
    numbers = ["fthg", "ftag", "hf", "af", "hy", "ay", "hr", "ar"]
    text = ["season", "league", "home_team", "away_team", "ftr"]
    rows = land(arrived, schema.text_schema(["match_id", "match_date", *text, *numbers]))
    return scalars.cast_stats(rows, numbers).select(
        F.col("match_id").try_cast("bigint").alias("match_id"),
        F.try_to_date("match_date", "yyyy-MM-dd").alias("match_date"),
        *text,
        *numbers,
    )


def to_json_messages(spark: SparkSession, folder: str) -> DataFrame:
    rows = matches(spark, folder).drop("match_ts").withColumn("id", F.col("match_id"))
    return to_messages(rows, ["id"]).select(F.col("id").alias("match_id"), "value")


def cast_stats(spark: SparkSession, folder: str) -> DataFrame:
    match = F.col("match_id")
    text = (
        F.when(match % 41 == 0, "x")
        .when(match % 7 == 0, F.concat(F.col("fthg").cast("string"), F.lit(".0")))
        .otherwise(F.col("fthg").cast("string"))
    )
    rows = matches(spark, folder).select("match_id", text.alias("fthg"))
    return scalars.cast_stats(rows, ["fthg"])


def parse_match_date(spark: SparkSession, folder: str) -> DataFrame:
    short = F.date_format("match_date", "dd/MM/yy")
    text = F.when(F.col("match_id") % 2 == 0, short).otherwise(F.date_format("match_date", "dd/MM/yyyy"))
    rows = matches(spark, folder).select("match_id", text.alias("text"))
    return rows.select("match_id", scalars.match_date(F.col("text")).alias("match_date"))


def parse_match_date_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Compat dates: the year as written, and with the year in front where day, month, year does not fit."""
    match, date = F.col("match_id"), F.col("match_date")
    text = (
        F.when(match % 5 == 0, F.date_format(date, "yyyy/M/d"))
        .when(match % 5 == 1, F.lit("31/02/2020"))
        .when(match % 5 == 2, F.date_format(date, "d/M/yyyy"))
        .otherwise(F.date_format(date, "dd/MM/yyyy"))
    )
    return matches(spark, folder).select(
        "match_id", scalars.match_date(text, scalars.COMPAT, fallback=True).alias("match_date")
    )


def season_filter_compat(spark: SparkSession, folder: str) -> DataFrame:
    rows = matches(spark, folder).where(scalars.season_from(F.col("season"), 2008, scalars.COMPAT))
    return rows.select("match_id", "season")


def season_filter_strict(spark: SparkSession, folder: str) -> DataFrame:
    rows = matches(spark, folder).where(scalars.season_from(F.col("season"), 2015, scalars.STRICT))
    return rows.select("match_id", "season")


def match_points(spark: SparkSession, folder: str) -> DataFrame:
    return matches(spark, folder).select(
        "match_id",
        scalars.points(F.col("ftr"), "H").alias("home_points"),
        scalars.points(F.col("ftr"), "A").alias("away_points"),
    )


def goal_diff(spark: SparkSession, folder: str) -> DataFrame:
    gd = scalars.goal_diff(F.col("fthg"), F.col("ftag"))
    return matches(spark, folder).select("match_id", gd.alias("gd"))


def _indices(weights: dict[str, int]) -> dict:
    return {
        side: scalars.discipline(weights, F.col(f"{side}y"), F.col(f"{side}r"), F.col(f"{side}f"))
        for side in ("h", "a")
    }


def discipline_fouls(spark: SparkSession, folder: str) -> DataFrame:
    index = _indices(scalars.FOUL_WEIGHTS)
    return matches(spark, folder).select("match_id", index["h"].alias("hdi"), index["a"].alias("adi"))


def discipline_cards(spark: SparkSession, folder: str) -> DataFrame:
    index = _indices(scalars.CARD_WEIGHTS)
    return matches(spark, folder).select("match_id", index["h"].alias("hdi"), index["a"].alias("adi"))


def select_available(spark: SparkSession, folder: str) -> DataFrame:
    return scalars.select_available(
        matches(spark, folder), ["match_id", *[name.lower() for name in schema.JOB_A_WISHED]]
    )


def _rolling(spark, folder, side: str, weights: dict, names: list[str], empty: int | None, **split) -> DataFrame:
    """Goals, points and discipline over a team's last five games on one side."""
    home = side == "H"
    team, goals = ("home_team", "fthg") if home else ("away_team", "ftag")
    rows = matches(spark, folder).select(
        *ORDER,
        "season",
        team,
        F.col(goals).alias("goals"),
        scalars.points(F.col("ftr"), side).alias("points"),
        _indices(weights)["h" if home else "a"].alias("index"),
    )
    sums = dict(zip(names, ["goals", "points", "index"]))
    step = job_a.venue_sums(team, ["season"], ORDER, sums, empty)
    cuts = find_cuts(rows, step["entity"], ORDER, **split)
    return look_back(rows, **step, cuts=cuts).select("match_id", *names)


def rolling_home_a(spark: SparkSession, folder: str) -> DataFrame:
    return _rolling(spark, folder, "H", scalars.FOUL_WEIGHTS, ["hgl5", "htfl5", "hdil5"], 0)


def rolling_away_a(spark: SparkSession, folder: str) -> DataFrame:
    return _rolling(spark, folder, "A", scalars.FOUL_WEIGHTS, ["agl5", "atfl5", "adil5"], 0)


def rolling_home_b(spark: SparkSession, folder: str) -> DataFrame:
    return _rolling(spark, folder, "H", scalars.CARD_WEIGHTS, ["hgl5", "hthf5", "hdil5"], None)


def rolling_away_b(spark: SparkSession, folder: str) -> DataFrame:
    return _rolling(spark, folder, "A", scalars.CARD_WEIGHTS, ["agl5", "ataf5", "adil5"], None)


def rolling_home_b_split(spark: SparkSession, folder: str) -> DataFrame:
    """As ``rolling_home_b``, with groups cut into chunks of a dozen rows as if they were large."""
    names = ["hgl5", "hthf5", "hdil5"]
    return _rolling(spark, folder, "H", scalars.CARD_WEIGHTS, names, None, rows_per_chunk=12)


def _team_points(spark: SparkSession, folder: str) -> DataFrame:
    sides = {
        side: {"team": F.col(team), "points": scalars.points(F.col("ftr"), side)}
        for side, team in (("H", "home_team"), ("A", "away_team"))
    }
    return by_side(matches(spark, folder), [*ORDER, "match_date", "season", "league"], sides)


def team_long(spark: SparkSession, folder: str) -> DataFrame:
    return _team_points(spark, folder).select("match_id", SIDE, "season", "match_date", "team", "points")


def _team_form(spark: SparkSession, folder: str, **split) -> DataFrame:
    rows = _team_points(spark, folder).select(*ORDER, SIDE, "season", "match_date", "team", "points")
    entity, order = ["season", "team"], [*ORDER, SIDE]

    def add(df: DataFrame, group: list[str]) -> DataFrame:
        return df.withColumn("any5", F.sum("points").over(before(group, order, 5)))

    all_matches = matches(spark, folder)
    teams = {side: {"team": F.col(team)} for side, team in (("H", "home_team"), ("A", "away_team"))}
    keys = by_side(all_matches, [*ORDER, "season"], teams)
    cuts = find_cuts(keys, entity, order, total=2 * all_matches.count(), **split)
    return look_back(rows, entity, order, 5, add, ["points"], cuts=cuts)


def _form(spark: SparkSession, folder: str, **split) -> DataFrame:
    rows = _team_form(spark, folder, **split).drop("match_date")
    return by_match(rows, ["match_id"], {"htfl5": ("H", "any5"), "atfl5": ("A", "any5")})


def form_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """Compat: form of the home team by season, date and team, once for each of its rows of that date."""
    rows = matches(spark, folder).select("match_id", "season", "match_date", "home_team")
    form = _team_form(spark, folder)
    joined = attach_by_date(rows, form, ["season", "match_date"], "home_team", {"htfl5": "any5"})
    return joined.select("match_id", "htfl5")


def form_any_venue(spark: SparkSession, folder: str) -> DataFrame:
    return _form(spark, folder)


def form_any_venue_split(spark: SparkSession, folder: str) -> DataFrame:
    return _form(spark, folder, rows_per_chunk=12)


def _season_cum(spark: SparkSession, folder: str, **split) -> DataFrame:
    rows = matches(spark, folder).select(
        *ORDER,
        "season",
        scalars.points(F.col("ftr"), "H").alias("home_points"),
        scalars.points(F.col("ftr"), "A").alias("away_points"),
    )
    cuts = find_cuts(rows, ["season"], ORDER, **split)
    rows = running_total(rows, ["season"], ORDER, {"home": "home_points", "away": "away_points"}, cuts)
    so_far = F.coalesce("home", F.lit(0)) + F.coalesce("away", F.lit(0))
    return rows.select("match_id", so_far.alias("htp"), so_far.alias("atp"))


def season_cum_compat(spark: SparkSession, folder: str) -> DataFrame:
    return _season_cum(spark, folder)


def season_cum_compat_split(spark: SparkSession, folder: str) -> DataFrame:
    return _season_cum(spark, folder, rows_per_chunk=50)


def season_cum_strict(spark: SparkSession, folder: str) -> DataFrame:
    group = ["season", "league"]
    so_far = totals_before_day(
        _team_points(spark, folder), [*group, "team"], "match_date", {"points_before": F.col("points")}
    )
    rows = matches(spark, folder).select("match_id", "match_date", *group, "home_team", "away_team")
    large = rows.count() > ROWS_PER_CHUNK
    for team, name in (("home_team", "htp"), ("away_team", "atp")):
        side = so_far.withColumnsRenamed({"team": team, "points_before": name})
        rows = attach(rows, side, [*group, team, "match_date"], large)
    return rows.select("match_id", "htp", "atp")


def season_points_compat(spark: SparkSession, folder: str) -> DataFrame:
    names = {"season": "Season", "home_team": "HomeTeam", "away_team": "AwayTeam", "fthg": "FTHG", "ftag": "FTAG"}
    rows = matches(spark, folder).select(
        "match_id",
        *[F.col(name).alias(new) for name, new in names.items()],
        scalars.points(F.col("ftr"), "H").alias("HomeResultScore"),
        scalars.points(F.col("ftr"), "A").alias("AwayResultScore"),
    )
    kept = ["HT_PTS_HOME", "HT_PTS_AWAY", "HTSP", "AT_PTS_AWAY", "AT_PTS_HOME", "ATSP"]
    sums = job_b.season_sums(rows, rows.count() > ROWS_PER_CHUNK)
    return sums.select("match_id", *[F.col(name).alias(name.lower()) for name in kept])


def season_points_strict(spark: SparkSession, folder: str) -> DataFrame:
    return strict.season_points(_team_points(spark, folder))


def season_goal_diff(spark: SparkSession, folder: str) -> DataFrame:
    rows = matches(spark, folder).select("match_id", "season", "home_team", "away_team", "fthg", "ftag")
    large = rows.count() > ROWS_PER_CHUNK
    for team, goals, name in (("home_team", "fthg", "htasg"), ("away_team", "ftag", "atasg")):
        keys = ["season", team]
        rows = attach(rows, totals(rows, keys, {name: F.col(goals)}), keys, large)
    return rows.select("match_id", "htasg", "atasg", (F.col("htasg") - F.col("atasg")).alias("sgd"))


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    leagues = matches(spark, folder).select("league").distinct()
    return whole.manifest(leagues, FIRST_YEAR, LAST_YEAR)


def season_league_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _manifest(spark, folder)


def missing_files(spark: SparkSession, folder: str) -> DataFrame:
    return whole.missing(_manifest(spark, folder), matches(spark, folder), KEY)


def publish_report(spark: SparkSession, folder: str) -> DataFrame:
    return whole.publish_report(_manifest(spark, folder), matches(spark, folder), KEY)


def dedup_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = matches(spark, folder).drop("match_ts")
    return whole.drop_copies(rows.union(rows), ["match_id"])


def latest_match(spark: SparkSession, folder: str) -> DataFrame:
    """A corrected match replaces the earlier version."""
    rows = matches(spark, folder).select("match_id", "fthg", F.lit(1).alias("version"))
    corrected = rows.where(F.col("match_id") % 5 == 0).select(
        "match_id", (F.col("fthg") + 1).alias("fthg"), F.lit(2).alias("version")
    )
    return whole.latest(rows.union(corrected), ["match_id"], [F.desc("version")])


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    sent = to_messages(matches(spark, folder).withColumn("id", F.col("match_id")), ["id"])
    cut = F.when(F.col("id") % 37 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    arrived = sent.select("id", cut.cast("binary").alias("value"))
    fields = schema.text_schema(["match_id", "season", "home_team", "away_team", "fthg"])
    rows = land_flagged(arrived, fields, ["season", "home_team", "away_team"], ["id"])
    goals = F.when(~F.col("quarantined"), scalars.to_int(F.col("fthg")))
    return rows.select(F.col("id").alias("match_id"), "quarantined", goals.alias("fthg"))


def features_a(spark: SparkSession, folder: str) -> DataFrame:
    rows = job_a.features(records(spark, folder), ORDER)
    return rows.drop("match_ts").withColumnsRenamed(_lower(rows))


def features_b(spark: SparkSession, folder: str) -> DataFrame:
    rows = job_b.features(records(spark, folder), ORDER)
    return rows.drop("match_ts").withColumnsRenamed(_lower(rows))


def _lower(df: DataFrame) -> dict[str, str]:
    # ``AS`` is a keyword in SQL text, so the statistics get a plain suffix in the lowered form
    return {name: "away_shots" if name == "AS" else name.lower() for name in df.columns}


def features_strict(spark: SparkSession, folder: str) -> DataFrame:
    return strict.features(matches(spark, folder)).drop("match_ts")


def features_strict_split(spark: SparkSession, folder: str) -> DataFrame:
    return strict.features(matches(spark, folder), rows_per_chunk=12).drop("match_ts")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in [
        json_landing, to_json_messages, cast_stats, parse_match_date, parse_match_date_fallback,
        season_filter_compat, season_filter_strict, match_points, goal_diff,
        discipline_fouls, discipline_cards, select_available,
        rolling_home_a, rolling_away_a, rolling_home_b, rolling_away_b, rolling_home_b_split,
        team_long, form_any_venue, form_any_venue_split, form_by_date,
        season_cum_compat, season_cum_compat_split, season_cum_strict,
        season_points_compat, season_points_strict, season_goal_diff,
        season_league_manifest, missing_files, publish_report,
        dedup_matches, latest_match, quarantine,
        features_a, features_b, features_strict, features_strict_split,
    ]
}
