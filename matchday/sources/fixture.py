"""The ``matches`` view: match rows derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.schema import MESSAGE_FIELDS

LEAGUE_OF_EVENT = {"click": "E0", "error": "SP1", "purchase": "D1", "signup": "I1", "view": "F1"}


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """One match per event. A pure projection, so a query reads only the columns it needs."""
    e = spark.read.parquet(f"{folder}/events.parquet")
    event, user = F.col("event_id"), F.col("user_id")
    league = F.lit(None).cast("string")
    for event_type, code in LEAGUE_OF_EVENT.items():
        league = F.when(F.col("event_type") == event_type, code).otherwise(league)
    # two days make a season: days 1 and 2 are 0809, days 31 and 32 would be 2324
    seasons = F.array(*[F.lit(f"{year:02}{year + 1:02}") for year in range(8, 24)])

    def team(number):
        return F.concat(F.col("league"), F.lit("_"), number.cast("string"))

    rows = e.select(
        event.alias("match_id"),
        F.col("ts").alias("match_ts"),
        F.to_date("ts").alias("match_date"),
        F.get(seasons, F.shiftright(F.dayofmonth("ts") - 1, 1)).alias("season"),
        league.alias("league"),
        # value has two decimals; round() itself goes through BigDecimal
        (F.floor(F.col("value") * 100 + 0.5) % 5).cast("int").alias("fthg"),
        (F.get_json_object("props", "$.k").cast("int") % 4).cast("int").alias("ftag"),
        user,
    )
    match = F.col("match_id")
    return rows.select(
        "match_id",
        "match_ts",
        "match_date",
        "season",
        "league",
        team(user % 20).alias("home_team"),
        team((user + 1 + match % 19) % 20).alias("away_team"),
        "fthg",
        "ftag",
        F.when(match % 31 == 0, None)
        .when(F.col("fthg") > F.col("ftag"), "H")
        .when(F.col("fthg") < F.col("ftag"), "A")
        .otherwise("D")
        .alias("ftr"),
        F.when(match % 17 == 0, None).otherwise((match % 13 + 5).cast("int")).alias("hf"),
        (match % 11 + 5).cast("int").alias("af"),
        (match % 4).cast("int").alias("hy"),
        (match % 3).cast("int").alias("ay"),
        F.when(match % 23 == 0, 1).otherwise(0).alias("hr"),
        F.when(match % 29 == 0, 1).otherwise(0).alias("ar"),
    )


def records(spark: SparkSession, folder: str) -> DataFrame:
    """The matches as text records with message field names, beside ``match_ts`` and ``match_id``.

    The two stand in for the arrival time and offset that a message source supplies.
    """
    named = {
        "Date": F.date_format("match_date", "dd/MM/yyyy"),
        "Div": F.col("league"),
        "HomeTeam": F.col("home_team"),
        "AwayTeam": F.col("away_team"),
        "Season": F.col("season"),
        "League": F.col("league"),
    }
    given = {name.upper(): F.col(name) for name in ["ftr", "fthg", "ftag", "hf", "af", "hy", "ay", "hr", "ar"]}
    fields = {**{name: F.lit(None) for name in MESSAGE_FIELDS}, **named, **given}
    return matches(spark, folder).select(
        "match_id", "match_ts", *[value.cast("string").alias(name) for name, value in fields.items()]
    )
