"""Incremental features against the batch result over all matches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from matchday.plans import strict
from matchday.sources.fixture import matches
from matchday.streaming import incremental, key_index, snapshots
from matchday.streaming.incremental import upsert_and_recompute


@pytest.fixture(scope="module")
def rows(spark):
    return matches(spark, SMALL).where("season IN ('0809', '0910')").cache()


def run(spark, tmp_path, batches):
    table = str(tmp_path / "table")
    write = upsert_and_recompute(table)
    for batch_id, batch in batches:
        write(batch, batch_id)
    return incremental.read(spark, table)


def part(rows, i, k):
    return rows.where(F.pmod(F.xxhash64("match_id"), F.lit(k)) == i)


def test_batches_in_any_order_equal_one_batch(spark, rows, tmp_path, same):
    order = [2, 0, 3, 1]
    got = run(spark, tmp_path, [(batch_id, part(rows, i, 4)) for batch_id, i in enumerate(order)])
    same(got, strict.features(rows))


def test_replay_and_correction(spark, rows, tmp_path, same):
    first, second = part(rows, 0, 2), part(rows, 1, 2)
    changed = second.withColumn("fthg", F.when(F.col("match_id") % 3 == 0, 4).otherwise(F.col("fthg")))
    got = run(spark, tmp_path, [(0, first), (1, second), (1, second), (2, first), (3, changed)])
    same(got, strict.features(first.union(changed)))


def test_a_batch_that_comes_again_late_changes_nothing_newer(spark, rows, tmp_path, same):
    got = run(spark, tmp_path, [(0, part(rows, 0, 2)), (1, part(rows, 1, 2)), (1, part(rows, 1, 2))])
    same(got, strict.features(rows))


def test_other_pairs_are_not_rewritten(spark, rows, tmp_path):
    table = str(tmp_path / "table")
    write = upsert_and_recompute(table)
    write(rows, 0)
    write(rows.where("season = '0809' AND league = 'E0'").limit(1), 1)
    heads = incremental.newest_versions(spark, table, snapshots.read_log(spark, table))
    assert {tuple(row) for row in heads.where("version = 2").collect()} == {("0809", "E0", 2)}
    second = snapshots.read(spark, table, "features", snapshots.read_log(spark, table)[1:])
    assert {tuple(row) for row in second.select("season", "league").distinct().collect()} == {("0809", "E0")}


def test_as_a_stream(spark, rows, tmp_path, same):
    for place in range(3):
        part(rows, place, 3).coalesce(1).write.parquet(str(tmp_path / "in" / f"{place}"))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    table = str(tmp_path / "table")
    query = (
        source.parquet(str(tmp_path / "in" / "*"))
        .writeStream.foreachBatch(upsert_and_recompute(table))
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(300)
    same(incremental.read(spark, table), strict.features(rows))
    log = snapshots.read_log(spark, table)
    assert [(made.run, made.batch) for made in log] == [(query.id, number) for number in range(3)]


def test_new_run_over_the_same_table(spark, rows, tmp_path, same):
    table = str(tmp_path / "table")
    upsert_and_recompute(table)(part(rows, 0, 2), 0)
    again = upsert_and_recompute(table)
    again(part(rows, 1, 2), 0)
    again(part(rows, 1, 2), 0)
    same(incremental.read(spark, table), strict.features(rows))
    same(incremental.read(spark, table, version=1), strict.features(part(rows, 0, 2)))
    assert len(snapshots.read_log(spark, table)) == 2


@pytest.mark.parametrize("stage", ["features", "write_index", "commit"])
def test_crash_before_the_commit(spark, rows, tmp_path, same, monkeypatch, stage):
    """Readers see the state before the batch until all of it is there."""
    table = str(tmp_path / "table")
    write = upsert_and_recompute(table)
    write(part(rows, 0, 2), 0)

    def crash(*given, **named):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr({"features": strict, "write_index": key_index, "commit": snapshots}[stage], stage, crash)
        with pytest.raises(RuntimeError):
            write(part(rows, 1, 2), 1)
    same(incremental.read(spark, table), strict.features(part(rows, 0, 2)))
    write(part(rows, 1, 2), 1)
    same(incremental.read(spark, table), strict.features(rows))


def test_two_writers(spark, rows, tmp_path, same):
    """A writer that comes second does its batch again on top of the other's."""
    table = str(tmp_path / "table")
    upsert_and_recompute(table)(part(rows, 0, 3), 0)
    attempts = []

    def slow(log, made):
        attempts.append(made.version)
        done = incremental.stage(part(rows, 1, 3), table)(log, made)
        if len(attempts) == 1:
            upsert_and_recompute(table)(part(rows, 2, 3), 0)
        return done

    snapshots.committing(spark, table, "slow", 0, slow)
    assert attempts == [2, 3]
    same(incremental.read(spark, table), strict.features(rows))
    with pytest.raises(snapshots.Taken):
        snapshots.commit(spark, table, snapshots.Commit(3, "late", 0, "x"))


def test_compaction(spark, rows, tmp_path, same):
    table = str(tmp_path / "table")
    assert incremental.compact(spark, table) is None
    write = upsert_and_recompute(table)
    for place in range(2):
        write(part(rows, place, 3), place)
    incremental.compact(spark, table)
    assert snapshots.vacuum(spark, table, incremental.PARTS) == 8
    write(part(rows, 1, 3), 1)
    write(part(rows, 2, 3), 2)
    same(incremental.read(spark, table), strict.features(rows))
    assert [made.version for made in snapshots.live(snapshots.read_log(spark, table))] == [3, 4]


def test_only_commits_that_may_hold_a_key_are_read(spark, rows, tmp_path):
    """Keys of each commit are searched in it alone; new keys between the others in none."""
    table = str(tmp_path / "table")
    write = upsert_and_recompute(table)
    parts = [rows.where(f"season = '{season}' AND league = '{league}' AND match_id % 3 > 0") for season in ("0809", "0910") for league in ("E0", "SP1", "D1")]
    for number, one in enumerate(parts):
        write(one, number)
    commits = snapshots.read_log(spark, table)
    for number, one in enumerate(parts):
        keys = one.select("match_id").limit(2)
        assert key_index.holding(spark, table, commits, keys, ["match_id"]) == [commits[number]]
    unknown = rows.where("match_id % 3 = 0").select("match_id").limit(10)
    assert key_index.holding(spark, table, commits, unknown, ["match_id"]) == []
    beyond = spark.range(10**9, 10**9 + 5).select(F.col("id").alias("match_id"))
    assert key_index.holding(spark, table, commits, beyond, ["match_id"]) == []
    assert key_index.holding(spark, table, commits, keys.limit(0), ["match_id"]) == []


def test_ranges_alone_for_many_keys(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "PROBED", 1)
    table = str(tmp_path / "table")
    write = upsert_and_recompute(table)
    middle = rows.where("league = 'E0'").agg(F.median("match_id")).first()[0]
    low, high = (rows.where(f"league = 'E0' AND match_id {sign} {middle}") for sign in ("<", ">="))
    write(low, 0)
    write(high, 1)
    commits = snapshots.read_log(spark, table)
    assert len(commits) == 2
    assert key_index.holding(spark, table, commits, low.select("match_id"), ["match_id"]) == commits[:1]
    assert key_index.holding(spark, table, commits, rows.select("match_id"), ["match_id"]) == commits
    keys = low.select("match_id").limit(3)
    own = incremental.current(spark, table, "matches", commits[:1], incremental.newest_versions(spark, table, commits[:1]))
    assert own.join(keys, "match_id", "left_semi").count() == 3


def test_empty_batch_is_no_commit(spark, rows, tmp_path):
    table = str(tmp_path / "table")
    upsert_and_recompute(table)(rows.limit(0), 0)
    assert snapshots.read_log(spark, table) == []
    with pytest.raises(ValueError):
        incremental.read(spark, table)


def test_moved_match_leaves_its_pair(spark, rows, tmp_path, same):
    first = rows.withColumn("league", F.col("league"))
    move = rows.where("season = '0809' AND league = 'E0'").orderBy("match_id").limit(3).withColumn("league", F.lit("SP1"))
    other = rows.where("season = '0809' AND league = 'E0'").orderBy(F.desc("match_id")).limit(1)
    got = run(spark, tmp_path, [(0, first), (1, move), (2, other)])
    ids = [r.match_id for r in move.collect()]
    same(got, strict.features(first.where(~F.col("match_id").isin(ids)).union(move)))


def test_withdrawn_result_empties_its_pair(spark, rows, tmp_path, same):
    one = rows.where("season = '0809' AND league = 'D1' AND ftr IS NOT NULL").orderBy("match_id").limit(1)
    one = one.withColumn("league", F.lit("a/b=c"))
    rest = rows.where("season = '0910'")
    withdrawn = one.withColumn("ftr", F.lit(None).cast("string"))
    got = run(spark, tmp_path, [(0, one.union(rest)), (1, withdrawn)])
    same(got, strict.features(rest))


def test_null_season_and_league(spark, rows, tmp_path, same):
    few = rows.where("season = '0809' AND league = 'E0'").orderBy("match_id").limit(30)
    odd = few.withColumn("season", F.when(F.col("match_id") % 3 > 0, F.col("season"))).withColumn(
        "league", F.when(F.col("match_id") % 2 > 0, F.col("league"))
    ).cache()
    got = run(spark, tmp_path, [(0, part(odd, 0, 2)), (1, part(odd, 1, 2))])
    same(got, strict.features(odd))


def test_null_key(spark, rows):
    few = rows.where("season = '0809' AND league = 'E0' AND ftr IS NOT NULL").orderBy("match_ts").limit(5)
    keyed = few.withColumn("match_id", F.when(F.col("match_id") != few.first().match_id, F.col("match_id")))
    assert strict.features(keyed).count() == 5
