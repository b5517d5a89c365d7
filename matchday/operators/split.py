"""Splitting ordered groups into chunks, so that no task has to hold a whole group.

A window over (season, team) puts every match of that pair into one task. That is fine for a real
season and not for a group that holds a third of a large table. Here such a group is cut at points
of its own order; windows then run per (group, chunk), and what a frame needs from earlier chunks is
added as a few carry rows (``preceding.py``). Cut points only decide where work is divided: any set
of them gives the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.session import checkpoint_folder

CHUNK = "_chunk"
LAST_CHUNK = "_last_chunk"
ROWS_PER_CHUNK = 2_000_000
# Bounds the cut points, which are broadcast (about 100 bytes each).
MAX_CHUNKS = 200_000
SAMPLES_PER_CHUNK = 32
# Cut points are looked up by digits of the chunk number, so a row meets short lists only.
FANOUT = 1024


@dataclass(frozen=True)
class Cuts:
    """Cut points of the large groups.

    ``groups`` has one row per large group with its number of cuts; ``digits`` one table per digit
    of the chunk number, the leading digit first, with the length of its longest list. Where no
    group is large there are none, and plain windows do.
    """

    entity: list[str]
    order: list[str]
    groups: DataFrame | None = None
    digits: tuple[tuple[DataFrame, int], ...] = ()

    @property
    def needed(self) -> bool:
        return self.groups is not None


def find_cuts(
    df: DataFrame,
    entity: list[str],
    order: list[str],
    rows_per_chunk: int = ROWS_PER_CHUNK,
    max_chunks: int = MAX_CHUNKS,
    total: int | None = None,
) -> Cuts:
    """Sample the order keys of ``df`` and cut every group larger than ``rows_per_chunk``.

    ``df`` should be a stored table or a cheap projection of one: it is counted (no column is
    read) unless ``total`` gives its rows, and if it is larger than one chunk, its key columns are
    scanned once. The rows of a group must differ in ``order``; drop replayed rows first.
    """
    total = df.count() if total is None else total
    if total <= rows_per_chunk:
        return Cuts(entity, order)
    rows_per_chunk = max(rows_per_chunk, -(-total // max_chunks))
    step = max(1, rows_per_chunk // SAMPLES_PER_CHUNK)
    per_chunk = rows_per_chunk // step
    # a hash of the order keys decides, so a retried task samples the same rows
    keys = df.select(*entity, *order).where(F.pmod(F.xxhash64(*order), F.lit(step)) == 0)
    # at most SAMPLES_PER_CHUNK * max_chunks keys in all, so a task can hold those of any group
    rank = F.row_number().over(Window.partitionBy(*entity).orderBy(*order))
    points = keys.withColumn("_rank", rank).where(F.col("_rank") % per_chunk == 0)
    points = points.select(
        *[F.col(name).alias(cut) for name, cut in zip(entity, _cut_names(entity))],
        F.struct(*order).alias("_cut"),
        (F.col("_rank") / per_chunk).cast("int").alias("_number"),
    )
    # all branches of a query must see the same cuts, also after a retry
    checkpoint_folder(df.sparkSession)
    points = points.checkpoint()
    most = points.agg(F.max("_number")).first()[0]
    return Cuts(entity, order) if most is None else _lookup_tables(entity, order, points, most)


def _lookup_tables(entity: list[str], order: list[str], points: DataFrame, most: int) -> Cuts:
    names, number = _cut_names(entity), F.col("_number")
    width = 1
    while width * FANOUT <= most:
        width *= FANOUT
    digits = []
    while width:
        here = points.where((number % width == 0) & (number % (width * FANOUT) != 0))
        lists = here.groupBy(*names, F.expr(f"_number div {width * FANOUT}").cast("int").alias("_head"))
        lists = lists.agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
        digits.append((lists, min(FANOUT - 1, most // width)))
        width //= FANOUT
    return Cuts(entity, order, points.groupBy(*names).agg(F.max(number).alias(LAST_CHUNK)), tuple(digits))


def with_chunk(df: DataFrame, cuts: Cuts) -> DataFrame:
    """Add the chunk number of each row; groups without cuts are chunk 0 throughout.

    The lookup tables are small by construction, so they are broadcast and no row moves.
    """
    same, names = _same_group(cuts)
    rows = df.withColumn(CHUNK, F.lit(0))
    key = F.struct(*cuts.order)
    for digit, longest in cuts.digits:
        rows = rows.join(F.broadcast(digit), [*same, F.col(CHUNK) == F.col("_head")], "left")
        rows = rows.withColumn("_below", F.lit(0))
        # Binary search for the number of cuts <= key, one projection per halving: that stays in
        # generated code. Past the end of a list, and without one, the comparison is null.
        for bit in reversed(range(longest.bit_length())):
            probe = F.get("_cuts", F.col("_below") + (2**bit - 1)) <= key
            rows = rows.withColumn("_below", F.col("_below") + F.when(probe, 2**bit).otherwise(0))
        rows = rows.withColumn(CHUNK, F.col(CHUNK) * FANOUT + F.col("_below"))
        rows = rows.drop("_head", "_cuts", "_below", *names)
    return rows


def large_groups(df: DataFrame, cuts: Cuts) -> DataFrame:
    """The rows of groups that are cut, with the number of the group's last chunk."""
    same, names = _same_group(cuts)
    return df.join(F.broadcast(cuts.groups), same, "inner").drop(*names)


def _cut_names(entity: list[str]) -> list[str]:
    return [f"_cut_{name}" for name in entity]


def _same_group(cuts: Cuts) -> tuple[list[Column], list[str]]:
    # null-safe: rows without a team form a group like any other
    names = _cut_names(cuts.entity)
    return [F.col(name).eqNullSafe(F.col(cut)) for name, cut in zip(cuts.entity, names)], names
