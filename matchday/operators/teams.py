"""One row per match to one row per (match, side), and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = "side"
# Copies of a row that are listed at once.
TIMES_AT_ONCE = 4096


def by_side(df: DataFrame, keep: list[str], sides: dict[str, dict[str, Column]]) -> DataFrame:
    """Wide to long in one scan: ``keep`` columns, ``side``, and that side's columns."""
    entries = [
        F.struct(F.lit(side).alias(SIDE), *[value.alias(name) for name, value in columns.items()])
        for side, columns in sides.items()
    ]
    return df.select(*keep, F.explode(F.array(*entries)).alias("_row")).select(*keep, "_row.*")


def by_match(long: DataFrame, key: list[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """Long to wide: ``values`` maps a result column to (side, column of the long table).

    Each match has one row per side, so ``max`` picks the only value; no join is needed.
    """
    return long.groupBy(*key).agg(
        *[
            F.max(F.when(F.col(SIDE) == side, F.col(column))).alias(name)
            for name, (side, column) in values.items()
        ]
    )


def attach_by_date(
    matches: DataFrame, long: DataFrame, on: list[str], team: str, values: dict[str, str], own: str = "team"
) -> DataFrame:
    """Bring columns of (match, side) rows back by the columns ``on`` (season and date) and the team, compat form.

    ``values`` maps new names to columns of ``long``, ``own`` is its team. Where a team has several rows of a date, each match
    of that date gets them all, as the join by date has it; ``by_match`` makes no such products. A null
    in a key finds nothing. The match stays if nothing is found.
    """
    # rows with the same values travel and meet the matches as one, with their number
    right = long.groupBy(
        *[F.col(name).alias(f"_of_{name}") for name in [*on, own]], *[F.col(name).alias(new) for new, name in values.items()]
    ).agg(F.count("*").alias("_times"))
    equal = [F.col(name) == F.col(f"_of_{name}") for name in on] + [F.col(team) == F.col(f"_of_{own}")]
    met = matches.join(right, equal, "left").drop(*[f"_of_{name}" for name in [*on, own]])
    return repeated(met, F.coalesce("_times", F.lit(1))).drop("_times")


def repeated(df: DataFrame, times: Column) -> DataFrame:
    """Each row as often as ``times`` (1 or more) says, without a list longer than ``TIMES_AT_ONCE``."""
    begun = df.withColumn("_from", F.explode(F.sequence(F.lit(0), times - 1, F.lit(TIMES_AT_ONCE))))
    left = F.least(times - F.col("_from"), F.lit(TIMES_AT_ONCE)).cast("int")
    return begun.withColumn("_copy", F.explode(F.sequence(F.lit(1), left))).drop("_from", "_copy")
