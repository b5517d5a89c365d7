"""State-based form against the batch window."""

from __future__ import annotations

import datetime
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SMALL
from matchday.operators.preceding import before
from matchday.plans.strict import GROUP, team_rows
from matchday.sources.fixture import matches
from matchday.streaming.last_five import PACKED, PLACE, form_and_late, last_five, packed, split_late, tails, united, up_to


def _teams(spark):
    rows = team_rows(matches(spark, SMALL))
    rows = rows.withColumn("match_time", F.col("match_ts").cast("timestamp"))
    return rows.select(*GROUP, "match_id", "side", "points", "match_time")


def _deliver(spark, rows, folder, parts, shuffled, order=None):
    """Files by time; ``shuffled`` swaps neighbours, so rows come up to a part out of order."""
    rows = rows.withColumn("part", F.ntile(parts).over(_all()) - 1).cache()
    order = order or list(range(parts))
    if shuffled:
        order = [i + 1 if i % 2 == 0 and i + 1 < parts else i - 1 if i % 2 else i for i in order]
    for place, part in enumerate(order):
        rows.where(F.col("part") == part).drop("part").coalesce(1).write.parquet(f"{folder}/{place:03}")
    # a row far in the future moves the watermark past all others
    end = spark.createDataFrame(
        [("9999", "X", "end", -1, "H", 0, datetime.datetime(2100, 1, 1))], rows.drop("part").schema
    )
    end.coalesce(1).write.parquet(f"{folder}/{parts:03}")


def _all():
    from pyspark.sql import Window

    return Window.orderBy("match_time")


def _run(spark, folder, tmp_path, delay, history=None):
    stream = (
        spark.readStream.schema(spark.read.parquet(f"{folder}/000").schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/*")
    )
    query = (
        last_five(stream, delay, history)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def _expected(rows):
    window = before(GROUP, ["match_time", "match_id", "side"], 5)
    return rows.withColumn("form5", F.sum("points").over(window)).drop("points")


def test_in_order(spark, tmp_path, same):
    rows = _teams(spark)
    _deliver(spark, rows, str(tmp_path / "in"), 4, shuffled=False)
    out = _run(spark, str(tmp_path / "in"), tmp_path, "1 second")
    same(out.where("match_id >= 0"), _expected(rows))


def test_out_of_order_within_the_delay(spark, tmp_path, same):
    rows = _teams(spark)
    _deliver(spark, rows, str(tmp_path / "in"), 6, shuffled=True)
    out = _run(spark, str(tmp_path / "in"), tmp_path, "11 days")
    same(out.where("match_id >= 0"), _expected(rows))


def test_starts_from_history(spark, tmp_path, same):
    """A batch job hands the first half over; the stream goes on as if it had seen it."""
    rows = _teams(spark).withColumn("half", F.ntile(2).over(_all()))
    first, second = (rows.where(F.col("half") == half).drop("half") for half in (1, 2))
    _deliver(spark, second, str(tmp_path / "in"), 3, shuffled=False)
    out = _run(spark, str(tmp_path / "in"), tmp_path, "1 second", tails(first))
    keys = second.select("match_id", "side")
    same(out.where("match_id >= 0"), _expected(first.union(second)).join(keys, ["match_id", "side"], "left_semi"))


def test_late_rows_are_passed_on(spark, tmp_path, same):
    """The last part comes first; of the others, rows before an emitted row of their team are late, with all values."""
    rows = _teams(spark)
    _deliver(spark, rows, str(tmp_path / "in"), 4, shuffled=False, order=[1, 3, 0, 2])
    stream = (
        spark.readStream.schema(spark.read.parquet(str(tmp_path / "in" / "000")).schema)
        .option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    )
    form, late = str(tmp_path / "form"), str(tmp_path / "late")
    write = split_late(
        lambda df, number: df.write.mode("append").parquet(form), lambda df, number: df.write.mode("append").parquet(late)
    )
    query = form_and_late(stream, "1 second").writeStream.foreachBatch(write).option(
        "checkpointLocation", str(tmp_path / "c")
    ).trigger(availableNow=True).start()
    assert query.awaitTermination(300)
    emitted, behind = spark.read.parquet(form).where("match_id >= 0"), spark.read.parquet(late)
    assert emitted.count() and behind.count()
    same(behind.select(*rows.columns), rows.join(behind.select("match_id", "side"), ["match_id", "side"], "left_semi").select(*rows.columns))
    same(emitted.select("match_id", "side").union(behind.select("match_id", "side")), rows.select("match_id", "side"))
    # what is in time has the form of all rows that are
    in_time = rows.join(behind.select("match_id", "side"), ["match_id", "side"], "left_anti").select(*rows.columns)
    same(emitted, _expected(in_time))


def test_rows_of_a_team_travel_together(spark):
    """The processor is handed few rows, whatever is sent; nulls and rows that repeat stay."""
    sent = spark.range(6_000, numPartitions=1).select(
        F.lit("0809").alias("season"), F.when(F.col("id") % 2 == 0, "E0").alias("league"), F.lit("a").alias("team"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 500).alias("match_id"), F.when(F.col("id") % 5 > 0, "H").alias("side"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 4).cast("int")).alias("points"), (F.col("id") % 1000).alias("at"),
    )
    rows = sent.mapInArrow(packed, PACKED).collect()
    assert len(rows) == 6
    found = []
    for row in rows:
        for at, named, match, side, given, points in np.frombuffer(row.rows, PLACE).tolist():
            place = (match if named else None, row.sides[side], points if given else None, at)
            found.append((row.season, row.league, row.team, *place))
    assert sorted(found, key=repr) == sorted(map(tuple, sent.collect()), key=repr)


def test_places_of_rows_with_nulls():
    """Rows before or at the last emitted one are late; a place that comes twice counts once, with what came last."""
    draw = random.Random(5)
    sides = [None, "A", "H"]

    def order(place):
        at, match, side = place
        return at, match is not None, match or 0, side is not None, side or ""

    def some(count, names):
        rows = np.zeros(count, PLACE)
        for i in range(count):
            match, points = draw.choice([None, 1, 2, 3]), draw.choice([None, 0, 3])
            rows[i] = (
                draw.randrange(3), match is not None, match or 0, draw.randrange(len(names)), points is not None, points or 0
            )
        return rows

    def listed(rows, names):
        return {
            (at, match if named else None, names[side]): points if given else None
            for at, named, match, side, given, points in rows.tolist()
        }

    first, second = some(30, sides), some(20, ["A", "B"])
    rows, names = united([(first, sides), (second, ["A", "B"])])
    expected = {**listed(first, sides), **listed(second, ["A", "B"])}
    assert listed(rows, names) == expected and len(rows) == len(expected)
    places = list(listed(rows, names))
    assert places == sorted(expected, key=order)
    for last in places:
        assert up_to(rows, names, last).tolist() == [order(place) <= order(last) for place in places]
