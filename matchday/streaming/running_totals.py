"""Sums up to a day and over a season, kept across batches that bring late and corrected matches.

Per group the days form a binary indexed table: a day's values are added to the blocks of 1, 2, 4, ... days
that contain it and have an odd number, and the sum up to a day is put together from the blocks that its binary digits
name. So a match of any age changes some twenty sums and not those of all later days.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.operators.records import latest
from matchday.streaming import key_index, snapshots
from matchday.streaming.incremental import semi
from matchday.streaming.sinks import Write
from matchday.streaming.snapshots import Commit

# Days are numbered from 1 for 0001-01-01; two to the power of LEVELS lies beyond the year 9999.
FIRST_DAY, LEVELS = 719_163, 22
# What has no day counts in the sum of all days only.
NO_DAY = 0
COUNT = "_rows"
PARTS = ["rows", "sums", "index"]


def day_number(day: Column) -> Column:
    return F.unix_date(day) + FIRST_DAY


def blocks_of(day: Column) -> Column:
    """Last days of the blocks that a day counts in. A block has as many days as the lowest set bit of its last day says."""
    # the end of the block of two to the power of k days around the day, divided by that power
    numbers = F.transform(
        F.sequence(F.lit(0), F.lit(LEVELS)),
        lambda k: F.struct((F.call_function("shiftright", day - 1, k) + 1).alias("number"), k.alias("k")),
    )
    odd = F.filter(numbers, lambda x: x["number"] % 2 == 1)
    return F.transform(odd, lambda x: F.call_function("shiftleft", x["number"], x["k"]))


def blocks_up_to(day: Column) -> Column:
    """Last days of the blocks that make up all days up to this one."""
    set_bits = F.filter(
        F.sequence(F.lit(0), F.lit(LEVELS)), lambda k: F.call_function("shiftright", day, k).bitwiseAND(F.lit(1)) == 1
    )
    return F.transform(set_bits, lambda k: F.call_function("shiftleft", F.call_function("shiftright", day, k), k).cast("long"))


def add_up(table: str, key: list[str], entity: list[str], day: str, sums: list[str], run: str | None = None) -> Write:
    """Per batch: take in rows, which replace earlier rows of the same ``key``, and keep the sums right.

    ``sums`` names numeric columns (whole numbers or decimals); a row that has none of them counts nowhere, which is
    how a result is taken back. Nulls in ``entity`` are groups like any other. ``table`` is a folder of commits
    (``snapshots``): a batch that comes again changes nothing, and another run goes on with what is there.
    A batch reads the earlier rows of its own keys, and writes its rows and changed sums.
    """
    own = uuid.uuid4().hex

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = [*key, *[name for name in [*entity, day] if name not in key], *sums]
        rows = latest(batch.select(*columns), key, [F.xxhash64(*columns)]).persist()
        try:
            if rows.isEmpty():
                return
            name = run or snapshots.run_of(spark) or own
            snapshots.committing(spark, table, name, batch_id, lambda log, made: stage(rows, snapshots.live(log), made))
        finally:
            rows.unpersist()

    def stage(rows: DataFrame, commits: list[Commit], made: Commit) -> Commit:
        spark = rows.sparkSession
        changes = counted(rows, sums)
        old = standing(spark, table, commits, rows.select(*key), key)
        if old is not None:
            taken = counted(old.select(*rows.columns), sums)
            changes = changes.unionByName(taken.withColumns({name: -F.col(name) for name in [COUNT, *sums]}))
        per_day = summed(changes, [*entity, F.coalesce(day_number(F.col(day)), F.lit(NO_DAY)).cast("long").alias("_day")], sums)
        moved = per_day.where(reduce(Column.__or__, [F.col(name) != 0 for name in [COUNT, *sums]]))
        ends = F.when(F.col("_day") == NO_DAY, F.array(F.lit(NO_DAY).cast("long"))).otherwise(blocks_of(F.col("_day")))
        nodes = summed(moved.withColumn("_end", F.explode(ends)), [*entity, "_end"], sums)
        nodes.hint("rebalance", *entity).sortWithinPartitions(*entity, "_end").write.parquet(snapshots.folder(table, "sums", made))
        place = snapshots.folder(table, "rows", made)
        rows.hint("rebalance").write.parquet(place)
        made = replace(made, bits=key_index.bits_for(rows.count()))
        key_index.write_index(rows, key, table, made)
        return made

    return write


def counted(rows: DataFrame, sums: list[str]) -> DataFrame:
    """The rows with zeros for nulls, and whether they count."""
    some = reduce(Column.__or__, [F.col(name).isNotNull() for name in sums])
    return rows.withColumn(COUNT, some.cast("long")).withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in sums})


def summed(rows: DataFrame, by: list, sums: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(*[F.sum(name).alias(name) for name in [COUNT, *sums]])


def standing(spark: SparkSession, table: str, commits: list[Commit], keys: DataFrame, key: list[str]) -> DataFrame | None:
    """The newest earlier row of each key."""
    possible = key_index.holding(spark, table, commits, keys, key)
    if not possible:
        return None
    found = semi(snapshots.read(spark, table, "rows", possible), keys, key)
    return latest(found, key, [F.desc("version")]).drop("version")


def totals_before(
    spark: SparkSession, table: str, asked: DataFrame, entity: list[str], day: str, sums: dict[str, str],
    whole: dict[str, str] | None = None, version: int | None = None,
) -> DataFrame:
    """``asked`` with a column for each of ``sums`` (new name: column): the sum over all days before its
    ``day``, null if nothing counts there. ``whole`` adds sums over all days. Null days have no days before."""
    commits = snapshots.live(snapshots.read_log(spark, table), version)
    if not commits:
        raise ValueError(f"{table} has no commit")
    columns = list(dict.fromkeys([*sums.values(), *(whole or {}).values()]))
    places = asked.select(*entity, day).distinct()
    number = day_number(F.col(day)).cast("long") - 1
    everything = F.array(F.lit(NO_DAY).cast("long"), F.lit(1 << LEVELS).cast("long"))
    needed = places.select(
        *entity, day,
        F.explode(F.concat(
            F.transform(F.coalesce(blocks_up_to(number), F.array()), lambda end: F.struct(F.lit(True).alias("before"), end.alias("end"))),
            F.transform(everything, lambda end: F.struct(F.lit(False).alias("before"), end.alias("end"))),
        )).alias("_x"),
    ).select(*entity, day, F.col("_x.before").alias("_before"), F.col("_x.end").alias("_end"))
    found = semi(snapshots.read(spark, table, "sums", commits), places, entity)
    nodes = summed(found, [*entity, "_end"], columns).withColumnsRenamed({name: f"_of_{name}" for name in [*entity, "_end"]})
    met = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in [*entity, "_end"]])

    def total(name: str, before: bool) -> Column:
        chosen = F.col("_before") if before else ~F.col("_before")
        return F.when(F.sum(F.when(chosen, F.col(COUNT))) > 0, F.sum(F.when(chosen, F.col(name))))

    made = needed.join(nodes, met, "left").groupBy(*entity, day).agg(
        *[total(name, True).alias(new) for new, name in sums.items()],
        *[total(name, False).alias(new) for new, name in (whole or {}).items()],
    )
    made = made.withColumnsRenamed({name: f"_of_{name}" for name in [*entity, day]})
    on = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in [*entity, day]])
    return asked.join(made, on, "left").drop(*[f"_of_{name}" for name in [*entity, day]])


def compact(spark: SparkSession, table: str, key: list[str], entity: list[str], sums: list[str]) -> Commit | None:
    """Commit the newest rows and the added-up sums as one version; see ``snapshots.vacuum``."""

    def write(log: list[Commit], made: Commit) -> Commit:
        commits = snapshots.live(log)
        nodes = summed(snapshots.read(spark, table, "sums", commits), [*entity, "_end"], sums)
        nodes.sortWithinPartitions(*entity, "_end").write.parquet(snapshots.folder(table, "sums", made))
        rows = latest(snapshots.read(spark, table, "rows", commits), key, [F.desc("version")]).drop("version")
        rows.write.parquet(snapshots.folder(table, "rows", made))
        rows = spark.read.parquet(snapshots.folder(table, "rows", made))
        made = replace(made, base=made.version, bits=key_index.bits_for(rows.count()))
        key_index.write_index(rows, key, table, made)
        return made

    if not snapshots.read_log(spark, table):
        return None
    return snapshots.committing(spark, table, f"compact-{uuid.uuid4().hex}", 0, write)
