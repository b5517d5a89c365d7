"""Column helpers for one match. All are built-in Spark expressions, none raises on bad text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLAIN_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
COMPAT, STRICT = "compat", "strict"

# Discipline weights of the two feature jobs.
FOUL_WEIGHTS = {"fouls": 2, "yellow": 10, "red": 25}
CARD_WEIGHTS = {"yellow": 5, "red": 25}


def to_int(text: Column) -> Column:
    """Whole number from text. ``2.0`` gives 2 (a column with blanks is published as floats).

    Only plain decimals are numbers: ``1e1``, ``2d`` or ``0x1p3`` give null.
    """
    return F.when(text.rlike(PLAIN_DECIMAL), text.try_cast("double").try_cast("int"))


def cast_stats(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Type many statistics in one projection."""
    return df.withColumns({name: to_int(F.col(name)) for name in names})


def match_date(text: Column, profile: str = STRICT, fallback: bool = False) -> Column:
    """Date of a match, null for text that is no date.

    strict: day/month/year with a four-digit year, or with two digits (``02`` is 2002).
    compat: the year is taken as written, so ``17/08/02`` is in year 2. With ``fallback``, text
    that does not fit is tried with the year in front.
    """
    if profile == STRICT:
        return F.coalesce(F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "d/M/yy"))
    forms = ["d/M/y"] + (["yy/MM/dd", "yyyy/M/d"] if fallback else [])
    return F.coalesce(*[F.try_to_date(text, form) for form in forms])


def season_start_year(season: Column) -> Column:
    """``0809`` -> 2008."""
    return F.lit(2000) + to_int(F.substring(season, 1, 2))


def season_from(season: Column, first: int, profile: str = STRICT) -> Column:
    """Condition for the season filter.

    compat compares the four-character code itself, so 2008 keeps only codes such as ``2122``.
    strict compares the year in which the season starts.
    """
    return (to_int(season) if profile == COMPAT else season_start_year(season)) >= first


def season_code(year: Column) -> Column:
    """2008 -> ``0809``."""
    return F.concat(
        F.lpad((year % 100).cast("string"), 2, "0"), F.lpad(((year + 1) % 100).cast("string"), 2, "0")
    )


def points(result: Column, side: str) -> Column:
    """3 for a win of ``side`` (``H`` or ``A``), 1 for a draw, else 0; no result gives 0."""
    return F.when(result == side, 3).when(result == "D", 1).otherwise(0)


def goal_diff(home_goals: Column, away_goals: Column) -> Column:
    return home_goals - away_goals


def discipline(weights: dict[str, int], yellow: Column, red: Column, fouls: Column | None = None) -> Column:
    """Weighted sum of fouls and cards; null if any term with a weight is null."""
    index = yellow * weights["yellow"] + red * weights["red"]
    return index if "fouls" not in weights else fouls * weights["fouls"] + index


def select_available(df: DataFrame, wished: Iterable[str]) -> DataFrame:
    """Those of the wished columns that are present, in the wished order."""
    present = set(df.columns)
    return df.select(*[name for name in wished if name in present])
