"""Whole-record operators: manifest, reports, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.functions.scalars import season_code


def manifest(leagues: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Expected (season, league) pairs: every league in every season that starts in the years."""
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    return leagues.select("league", years.alias("_year")).select(
        season_code(F.col("_year")).alias("season"), "league"
    )


def missing(expected: DataFrame, accepted: DataFrame, on: list[str]) -> DataFrame:
    """Expected pairs that did not arrive."""
    return expected.join(accepted.select(*on).distinct(), on, "left_anti")


def publish_report(expected: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """Per pair its number of rows, and whether it was published, is missing, or was not expected."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    both = expected.withColumn("_expected", F.lit(True)).join(counts, on, "full")
    status = F.when(F.col("rows").isNull(), "missing").when(F.col("_expected"), "published").otherwise("unexpected")
    return both.select(*on, F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))


def drop_copies(df: DataFrame, key: list[str]) -> DataFrame:
    """One row per key where copies are identical. Copies collapse before the shuffle."""
    return df.dropDuplicates(key)


def latest(df: DataFrame, key: list[str], newest_first: list[Column]) -> DataFrame:
    """The newest version of each record. Only one candidate per key leaves each task."""
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
