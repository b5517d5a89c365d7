"""Repeated matches in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 64


def without_copies(
    matches: DataFrame, key: list[str], time: str, delay: str, differs: str | None = None
) -> DataFrame:
    """Drop repeated matches of a stream that come within ``delay`` of each other.

    A stream has no partial aggregation, so all copies of a match meet in one task. Where one match
    may be repeated very often, name a column in which copies differ, such as the offset: they are
    then thinned out in up to ``SPREAD`` tasks first, and only the rest meets.
    """
    rows = matches.withWatermark(time, delay)
    if differs:
        rows = rows.withColumn("_spread", F.pmod(F.xxhash64(differs), F.lit(SPREAD)))
        rows = rows.dropDuplicatesWithinWatermark([*key, "_spread"]).drop("_spread")
    return rows.dropDuplicatesWithinWatermark(key)
