"""Totals per group and per day, and attaching them to the rows they describe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.operators.preceding import before
from matchday.session import checkpoint_folder

# What every executor may have to hold of a summary, counted as text with 16 bytes more for a value.
BROADCAST_BYTES = 100_000_000


def totals(df: DataFrame, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums per group. Spark adds up inside each task first, so a hot group shuffles few rows."""
    return df.groupBy(*keys).agg(*[F.sum(value).alias(name) for name, value in sums.items()])


def totals_before_day(
    df: DataFrame, entity: list[str], day: str, sums: dict[str, Column], whole: dict[str, str] | None = None
) -> DataFrame:
    """Per (group, day), the sums over all earlier days; the day itself is left out.

    Rows are added up per day first, so the running sum meets one row per day and group. ``whole``
    adds under a new name the sum over all days of the group. Rows without a day count there only.
    """
    daily = totals(df, [*entity, day], sums)
    earlier, group = before(entity, [day]), Window.partitionBy(*entity)
    dated = {name: F.when(F.col(day).isNotNull(), F.col(name)) for name in sums}
    return daily.select(
        *entity,
        day,
        *[F.when(F.col(day).isNotNull(), F.sum(value).over(earlier)).alias(name) for name, value in dated.items()],
        *[F.sum(name).over(group).alias(new) for new, name in (whole or {}).items()],
    )


def size_of(df: DataFrame) -> int:
    """Bytes of all values as text, and 16 for each."""
    width = sum((F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16 for name in df.columns), F.lit(0))
    return df.agg(F.sum(width)).first()[0] or 0


def attach(
    df: DataFrame, summary: DataFrame, on: list[str], large: bool, null_safe: list[str] | None = None
) -> DataFrame:
    """Left join of a table with a summary of it; a null key finds nothing unless ``null_safe``.

    A large table is not shuffled for this if the summary is small: the summary is computed once,
    kept in the checkpoint folder, measured, and broadcast if it has at most ``BROADCAST_BYTES``.
    Beyond that, and for a table too small to matter, the join is left to adaptive execution, which
    sizes both sides at run time and splits skewed partitions.
    """
    if large:
        checkpoint_folder(df.sparkSession)
        summary = summary.checkpoint()
        if size_of(summary) <= BROADCAST_BYTES:
            summary = F.broadcast(summary)
    right = summary.withColumnsRenamed({name: f"_of_{name}" for name in on})
    equal = [
        F.col(name).eqNullSafe(F.col(f"_of_{name}"))
        if name in (null_safe or [])
        else F.col(name) == F.col(f"_of_{name}")
        for name in on
    ]
    return df.join(right, equal, "left").drop(*[f"_of_{name}" for name in on])
