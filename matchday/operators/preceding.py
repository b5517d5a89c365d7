"""Sums over the rows before a row, per group, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from matchday.operators.split import CHUNK, LAST_CHUNK, Cuts, find_cuts, large_groups, with_chunk

CARRY = "_carry"


def before(group: list[str], order: list[str], n: int | None = None) -> WindowSpec:
    """The ``n`` rows before the current one, or all of them; the row itself is left out."""
    start = Window.unboundedPreceding if n is None else -n
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(start, -1)


def look_back(
    df: DataFrame,
    entity: list[str],
    order: list[str],
    n: int,
    add: Callable[[DataFrame, list[str]], DataFrame],
    needs: list[str],
    role: list[str] | None = None,
    cuts: Cuts | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add window columns whose frames reach at most ``n`` rows back.

    ``add(df, group)`` adds the columns with windows that are partitioned by ``group``, or by
    ``group`` and ``role``, and ordered by ``order``. ``needs`` names the columns its windows read.
    ``source`` holds the same rows as ``df`` before costly steps and is what the carry rows are
    taken from. One shuffle, by ``group``; the carry rows are at most ``n`` per chunk and role.
    """
    role = role or []
    source = df if source is None else source
    cuts = cuts or find_cuts(source, entity, order)
    if not cuts.needed:
        return add(df, entity)
    columns = list(dict.fromkeys([*entity, *role, *order, *needs]))
    marked = with_chunk(df, cuts).withColumn(CARRY, F.lit(False))
    large = with_chunk(large_groups(source.select(*columns), cuts), cuts)
    carry = _last_rows(large, entity + role, order, n)
    rows = marked.unionByName(carry.withColumn(CARRY, F.lit(True)), allowMissingColumns=True)
    return add(rows, [*entity, CHUNK]).where(~F.col(CARRY)).drop(CHUNK, CARRY)


def _last_rows(chunked: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """For each chunk, the last ``n`` rows of the group that lie in earlier chunks.

    The last ``n`` rows of each chunk are kept first; Spark limits them before the shuffle. Such a
    row is needed from the next chunk up to the one that holds the n-th row after it.
    """
    newest_first = Window.partitionBy(*group, CHUNK).orderBy(*[F.desc(name) for name in order])
    tails = (
        chunked.withColumn("_place", F.row_number().over(newest_first))
        .where((F.col("_place") <= n) & (F.col(CHUNK) < F.col(LAST_CHUNK)))
    )
    nth_after = F.lead(CHUNK, n).over(Window.partitionBy(*group).orderBy(*order))
    until = F.least(F.coalesce(nth_after, F.col(LAST_CHUNK)), F.col(LAST_CHUNK))
    return (
        tails.withColumn("_until", until)
        .withColumn(CHUNK, F.explode(F.sequence(F.col(CHUNK) + 1, "_until")))
        .drop("_place", "_until", LAST_CHUNK)
    )


def running_total(
    df: DataFrame,
    entity: list[str],
    order: list[str],
    totals: dict[str, str],
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add, per name in ``totals``, the sum of its column over all earlier rows of the group.

    Large groups are summed per chunk, the chunk sums are added up over the few chunks of a group,
    and each row adds its chunk's start value to the running sum inside the chunk.
    """
    cuts = cuts or find_cuts(df, entity, order)
    if not cuts.needed:
        window = before(entity, order)
        return df.withColumns({name: F.sum(column).over(window) for name, column in totals.items()})
    chunked = with_chunk(df, cuts)
    sums = (
        with_chunk(large_groups(df.select(*dict.fromkeys([*entity, *order, *totals.values()])), cuts), cuts)
        .groupBy(*entity, CHUNK)
        .agg(*[F.sum(column).alias(f"_sum_{name}") for name, column in totals.items()])
    )
    earlier = before(entity, [CHUNK])
    start = sums.select(
        *[F.col(name).alias(f"_of_{name}") for name in [*entity, CHUNK]],
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_start_{name}") for name in totals],
    )
    inside = before([*entity, CHUNK], order)
    same = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in [*entity, CHUNK]]
    # one row per chunk, and the number of chunks is bounded: see split.MAX_CHUNKS
    rows = chunked.join(F.broadcast(start), same, "left")
    rows = rows.withColumns({name: F.sum(column).over(inside) for name, column in totals.items()})
    return rows.withColumns({name: _plus(F.col(name), F.col(f"_start_{name}")) for name in totals}).drop(
        CHUNK, *start.columns
    )


def _plus(left: Column, right: Column) -> Column:
    """Sum of two sums, where null stands for a sum over nothing."""
    return F.coalesce(left + right, left, right)
