"""Features that stay right when matches arrive late, corrected, twice or in any order."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.operators.records import latest
from matchday.operators.split import ROWS_PER_CHUNK
from matchday.plans import strict
from matchday.streaming import key_index, snapshots
from matchday.streaming.sinks import Write
from matchday.streaming.snapshots import Commit

PAIR = ["season", "league"]
PARTS = ["matches", "features", "touched", "index"]


def upsert_and_recompute(
    table: str,
    key: list[str] = strict.KEY,
    time: list[str] = strict.TIME,
    newest_first: list[str] | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    run: str | None = None,
) -> Write:
    """Per batch: take in the matches, then recompute the (season, league) pairs they touch.

    ``table`` is a folder of commits (``snapshots``). Each commit holds, of the pairs it touches, all
    matches as they now stand and their features; of other pairs nothing is read or written. A
    later batch wins, and inside a batch the order of ``newest_first``. A pair's rows are those of the newest
    commit that touches it, so a pair that loses its last match is empty. Null is a season or league like any other.

    A batch touches the pairs of its matches and those where one of them stands by now, so a match that
    moves leaves its old pair. An index of keys beside each commit names the commits where a match
    may stand; only those are searched.

    A batch that comes again changes nothing. ``run`` tells the batches of one stream from those of another; by
    default it is the identity of the streaming query, and outside of a query each call is a run of its own.
    """
    own = uuid.uuid4().hex

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            if not batch.isEmpty():
                name = run or snapshots.run_of(spark) or own
                snapshots.committing(spark, table, name, batch_id, stage(batch, table, key, time, newest_first, rows_per_chunk))
        finally:
            batch.unpersist()

    return write


def stage(
    batch: DataFrame,
    table: str,
    key: list[str] = strict.KEY,
    time: list[str] = strict.TIME,
    newest_first: list[str] | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> Callable[[list[Commit], Commit], Commit]:
    """Writes all data of a commit. Nobody reads it before the commit itself."""
    spark = batch.sparkSession

    def write(log: list[Commit], made: Commit) -> Commit:
        commits = snapshots.live(log)
        # the hash makes the choice the same in every attempt, whatever a batch repeats
        newest = [*[F.desc(name) for name in newest_first or []], F.xxhash64(*batch.columns)]
        arrived = latest(batch, key, newest)
        pairs, rows = arrived.select(*PAIR), arrived
        if commits:
            heads = newest_versions(spark, table, commits).persist()
            keys = arrived.select(*key)
            pairs = pairs.union(standing_in(spark, table, commits, heads, keys, key))
            pairs = pairs.distinct().persist()
            standing = current(spark, table, "matches", commits, semi(heads, pairs, PAIR))
            rows = arrived.unionByName(anti(standing, keys, key)) if standing else arrived
        place = snapshots.folder(table, "matches", made)
        # sorted, so that readers of one pair skip the other row groups
        rows.hint("rebalance", *PAIR).sortWithinPartitions(*PAIR, *time).write.parquet(place)
        matches = spark.read.schema(batch.schema).parquet(place)
        pairs.distinct().write.parquet(snapshots.folder(table, "touched", made))
        features = strict.features(matches, rows_per_chunk, key=key, time=time)
        features.hint("rebalance", *PAIR).sortWithinPartitions(*PAIR, *time).write.parquet(
            snapshots.folder(table, "features", made)
        )
        made = replace(made, bits=key_index.bits_for(matches.count()))
        key_index.write_index(matches, key, table, made)
        if commits:
            heads.unpersist()
            pairs.unpersist()
        return made

    return write


def newest_versions(spark: SparkSession, table: str, commits: list[Commit]) -> DataFrame:
    """(season, league, version): the commit that holds each pair."""
    return snapshots.read(spark, table, "touched", commits).groupBy(*PAIR).agg(F.max("version").alias("version"))


def current(spark: SparkSession, table: str, part: str, commits: list[Commit], heads: DataFrame) -> DataFrame | None:
    """Rows of the pairs in ``heads`` as their newest commits have them; only those commits are read."""
    versions = {row["version"] for row in heads.select("version").distinct().collect()}
    if not versions:
        return None
    rows = snapshots.read(spark, table, part, [made for made in commits if made.version in versions])
    return semi(rows, heads, [*PAIR, "version"]).drop("version")


def standing_in(
    spark: SparkSession, table: str, commits: list[Commit], heads: DataFrame, keys: DataFrame, key: list[str]
) -> DataFrame:
    """Pairs in which matches of these keys stand."""
    possible = key_index.holding(spark, table, commits, keys, key)
    if not possible:
        return heads.select(*PAIR).limit(0)
    rows = snapshots.read(spark, table, "matches", possible).select(*key, *PAIR, "version")
    return semi(semi(rows, keys, key), heads, [*PAIR, "version"]).select(*PAIR)


def read(spark: SparkSession, table: str, part: str = "features", version: int | None = None) -> DataFrame:
    """``features`` or ``matches`` of all pairs as of the last commit, or of an earlier version."""
    commits = snapshots.live(snapshots.read_log(spark, table), version)
    if not commits:
        raise ValueError(f"{table} has no commit" + (f" up to version {version}" if version else ""))
    return current(spark, table, part, commits, newest_versions(spark, table, commits))


def compact(spark: SparkSession, table: str, key: list[str] = strict.KEY) -> Commit | None:
    """Commit the table as it stands as one version, which readers then need alone. ``snapshots.vacuum``
    deletes what lies before it."""

    def write(log: list[Commit], made: Commit) -> Commit:
        commits = snapshots.live(log)
        heads = newest_versions(spark, table, commits)
        for part in ("matches", "features"):
            rows = current(spark, table, part, commits, heads)
            rows.hint("rebalance", *PAIR).sortWithinPartitions(*PAIR).write.parquet(snapshots.folder(table, part, made))
        heads.select(*PAIR).write.parquet(snapshots.folder(table, "touched", made))
        matches = spark.read.parquet(snapshots.folder(table, "matches", made))
        made = replace(made, base=made.version, bits=key_index.bits_for(matches.count()))
        key_index.write_index(matches, key, table, made)
        return made

    if not snapshots.read_log(spark, table):
        return None
    return snapshots.committing(spark, table, f"compact-{uuid.uuid4().hex}", 0, write)


def same(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    return reduce(Column.__and__, [left[name].eqNullSafe(right[f"_{name}"]) for name in on])


def semi(left: DataFrame, right: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` that have their like in ``right``; null equals null."""
    right = right.select(*[F.col(name).alias(f"_{name}") for name in on])
    return left.join(right, same(left, right, on), how)


def anti(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return semi(left, right, on, "left_anti")
