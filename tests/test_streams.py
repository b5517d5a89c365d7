from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from matchday import schema
from matchday.plans import job_a, job_b
from matchday.sources.messages import land, to_messages
from matchday.sources.streams import kafka_options, stream
from matchday.streaming import jobs, sinks
from matchday.streaming.copies import without_copies
from test_golden import records

SCHEMA = "value string, id int"


@pytest.fixture
def topic(spark, tmp_path):
    """The golden matches as messages in two files; ``id`` stands in for the offset."""
    folder = tmp_path / "topic"
    rows = to_messages(records(spark, "2122"), ["id"]).select("value", "id")
    for place, condition in enumerate(["id <= 5", "id > 5"]):
        rows.where(condition).coalesce(1).write.json(str(folder / f"{place}"))
    return str(folder / "*")


def read(spark, topic, one_by_one=False):
    options = {"maxFilesPerTrigger": "1"} if one_by_one else {}
    return stream(spark, "json", {**options, "path": topic}, SCHEMA)


def test_kafka_options():
    options = kafka_options("broker:9092", "matches", 500)
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in kafka_options("broker:9092", "matches")


def test_landing_to_several_sinks(spark, topic, tmp_path, same):
    landed = jobs.landed(read(spark, topic, one_by_one=True))
    started = [
        sinks.to_parquet(landed, str(tmp_path / "out"), str(tmp_path / "c1"), once=True),
        sinks.to_documents(landed, "json", {"path": str(tmp_path / "docs")}, str(tmp_path / "c2"), once=True),
        sinks.to_console(landed, once=True),
    ]
    for query in started:
        assert query.awaitTermination(120)
    expected = records(spark, "2122").drop("id")
    same(spark.read.schema(schema.MESSAGE).parquet(str(tmp_path / "out")), expected)
    docs = spark.read.schema(schema.MESSAGE).json(str(tmp_path / "docs"))
    same(docs, expected)
    # absent fields are left out of the documents
    name = next(n for n in os.listdir(tmp_path / "docs") if n.endswith(".json") and os.path.getsize(tmp_path / "docs" / n))
    assert "B365H" not in json.loads((tmp_path / "docs" / name).read_text().splitlines()[0])


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, same):
    rows = to_messages(records(spark), ["id"]).select("value", "id")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for place, condition in enumerate(["id <= 3", "id = 4", "id > 4"]):
        rows.where(condition).coalesce(1).write.json(str(tmp_path / "topic" / f"{place}"))
        landed = jobs.landed(read(spark, str(tmp_path / "topic" / "*")))
        assert sinks.to_parquet(landed, out, checkpoint, once=True).awaitTermination(120)
    same(spark.read.schema(schema.MESSAGE).parquet(out), records(spark).drop("id"))


@pytest.mark.parametrize(
    "start, features, fields",
    [(jobs.feature_job_a, job_a.features, schema.MESSAGE), (jobs.feature_job_b, job_b.features, schema.SHORT_MESSAGE)],
)
def test_feature_jobs(spark, topic, tmp_path, same, start, features, fields):
    out, docs = str(tmp_path / "out"), str(tmp_path / "docs")
    writes = [sinks.replace_batch(out), sinks.append_documents("json", {"path": docs})]
    query = start(read(spark, topic), ["id"], str(tmp_path / "c"), *writes, once=True)
    assert query.awaitTermination(120)
    messages = spark.read.schema(SCHEMA).json(topic)
    expected = features(land(messages, fields, ["id"]), ["id"]).drop("id")
    written = spark.read.parquet(out).drop("run", "batch_id")
    assert written.columns == expected.columns
    same(written, expected)
    # the documents hold the same values as text and numbers
    kept = spark.read.schema(expected.schema).json(docs)
    same(kept, expected)


def test_feature_job_sees_one_batch_only(spark, topic, tmp_path):
    out = str(tmp_path / "out")
    query = jobs.feature_job_b(
        read(spark, topic, one_by_one=True), ["id"], str(tmp_path / "c"), sinks.replace_batch(out), once=True
    )
    assert query.awaitTermination(120)
    rows = spark.read.parquet(out)
    assert rows.select("batch_id").distinct().count() == 2
    # team C's home game came in the other batch
    assert rows.where("Date = '14/09/2008'").first()["HGL5"] is None


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    write = sinks.replace_batch(str(tmp_path / "out"))
    for _ in range(2):
        write(spark.range(10), 0)
        write(spark.range(5), 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 15


def test_another_run_replaces_nothing(spark, topic, tmp_path):
    out = str(tmp_path / "out")
    for checkpoint in "ab":
        query = sinks.for_each_batch(read(spark, topic), sinks.replace_batch(out), str(tmp_path / checkpoint), once=True)
        assert query.awaitTermination(120)
    assert spark.read.parquet(out).count() == 16
    assert spark.read.parquet(out).select("run").distinct().count() == 2


def test_documents_are_appended_once(spark, tmp_path, monkeypatch):
    out, ledger = str(tmp_path / "docs"), str(tmp_path / "ledger")
    write = sinks.append_once("json", {"path": out}, ledger, run="r")
    for number in (0, 1, 0, 1):
        write(spark.range(number * 10, number * 10 + 5), number)
    other = sinks.append_once("json", {"path": out}, ledger)
    other(spark.range(100, 103), 0)
    assert sorted(row["id"] for row in spark.read.json(out).collect()) == [*range(5), *range(10, 15), *range(100, 103)]


def test_documents_of_a_failed_append(spark, tmp_path):
    out, ledger, removed = str(tmp_path / "docs"), str(tmp_path / "ledger"), []
    bad = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("id"))
    write = sinks.append_once("json", {"path": out}, ledger, run="r")
    with pytest.raises(Exception, match="lost"):
        write(bad, 0)
    # rows of the first attempt may be there
    with pytest.raises(RuntimeError, match="removed first"):
        write(spark.range(3), 0)
    again = sinks.append_once("json", {"path": out}, ledger, lambda spark, run, batch: removed.append((run, batch)), run="r")
    again(spark.range(3), 0)
    again(spark.range(3), 0)
    assert removed == [("r", 0)]
    assert {tuple(row) for row in spark.read.json(out).select("_run", "_batch").collect()} == {("r", 0)}
    assert spark.read.json(out).count() == 3


def test_fan_out_computes_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return value

    batch = spark.range(20).select(F.udf(count, "bigint")("id").alias("id"))
    writes = [sinks.replace_batch(str(tmp_path / name)) for name in "ab"]
    sinks.fan_out(*writes)(batch, 0)
    assert seen.value == 20
    assert not batch.is_cached


def test_empty_batches_are_skipped(spark):
    calls = []
    write = sinks.skip_empty(lambda batch, batch_id: calls.append(batch_id))
    write(spark.range(0), 0)
    write(spark.range(1), 1)
    assert calls == [1]


def test_landing_batches_keep_bad_messages_apart(spark, topic, tmp_path):
    messages = read(spark, topic).withColumn(
        "value", F.when(F.col("id") == 2, F.substring("value", 1, 9)).otherwise(F.col("value"))
    )
    write = jobs.landing_batches(
        sinks.replace_batch(str(tmp_path / "good")), sinks.replace_batch(str(tmp_path / "bad"))
    )
    query = sinks.for_each_batch(messages, write, str(tmp_path / "c"), once=True)
    assert query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "good")).count() == 7
    assert [len(row["raw"]) for row in spark.read.parquet(str(tmp_path / "bad")).collect()] == [9]


@pytest.mark.parametrize("differs", [None, "sent"])
def test_copies_in_a_stream(spark, tmp_path, differs):
    rows = spark.createDataFrame([(i % 5, f"2024-01-0{i % 5 + 1}", i) for i in range(400)], "id int, day string, sent int")
    for place in range(2):
        rows.withColumn("sent", F.col("sent") + 1_000 * place).coalesce(1).write.json(str(tmp_path / "in" / f"{place}"))
    options = {"path": str(tmp_path / "in" / "*"), "maxFilesPerTrigger": "1"}
    source = stream(spark, "json", options, "id int, day string, sent int")
    matches = source.withColumn("at", F.to_timestamp("day"))
    out = without_copies(matches, ["id"], "at", "30 days", differs)
    query = sinks.to_parquet(out, str(tmp_path / "out"), str(tmp_path / "c"), once=True)
    assert query.awaitTermination(120)
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert kept.columns == ["id", "day", "sent", "at"]
    assert sorted(row["id"] for row in kept.collect()) == list(range(5))


def test_upsert_options():
    assert sinks.upsert_options("d", "c", ["Season", "Date"])["idFieldList"] == "Season,Date"


def test_source_options():
    from matchday.sources.streams import source_options

    given = {"kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "latest"}
    assert source_options("kafka", given, 50) == {**given, "failOnDataLoss": "false", "maxOffsetsPerTrigger": "50"}
    assert source_options("kafka", {})["startingOffsets"] == "earliest"
    assert source_options("parquet", {"a": "b"}, 2) == {"a": "b", "maxFilesPerTrigger": "2"}


def test_landing_with_quarantine(spark, tmp_path):
    from matchday.streaming.jobs import landing_job

    good = '{"Season":"0809","League":"E0","Date":"01/02/2009","HomeTeam":"A","AwayTeam":"B","FTHG":2}'
    texts = [good, "{bad", None, '{"Season":"0809","League":"E0"}']
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    for query in landing_job(source, out, str(tmp_path / "c"), once=True, quarantine=bad):
        assert query.awaitTermination(120)
    assert [r.HomeTeam for r in spark.read.parquet(out).collect()] == ["A"]
    assert spark.read.parquet(bad).count() == 3
