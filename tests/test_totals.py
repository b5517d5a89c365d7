from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from matchday.operators import totals
from matchday.operators.records import latest, manifest, missing, publish_report


@pytest.fixture(scope="module")
def rows(spark):
    data = [("a", "d1", 1), ("a", "d1", 2), ("a", "d2", 4), ("a", None, 8), (None, "d1", 16), ("b", "d3", None)]
    return spark.createDataFrame(data, "team string, day string, v int")


@pytest.mark.parametrize("large, broadcast_bytes", [(False, 0), (True, 1_000), (True, 0)])
def test_attach(rows, monkeypatch, same, large, broadcast_bytes):
    monkeypatch.setattr(totals, "BROADCAST_BYTES", broadcast_bytes)
    sums = totals.totals(rows, ["team"], {"total": F.col("v")})
    got = totals.attach(rows, sums, ["team"], large)
    assert got.columns == ["team", "day", "v", "total"]
    expected = {"a": 15, "b": None, None: None}
    assert all(row["total"] == expected[row["team"]] for row in got.collect())
    kept = totals.attach(rows, sums, ["team"], large, null_safe=["team"]).where("team IS NULL").first()
    assert kept["total"] == 16
    hinted = "BroadcastHashJoin" in got._jdf.queryExecution().sparkPlan().toString()
    assert hinted or not (large and broadcast_bytes)


def test_totals_before_day(rows):
    got = totals.totals_before_day(rows, ["team"], "day", {"s": F.col("v")}, whole={"all": "s"})
    assert {(r["team"], r["day"]): (r["s"], r["all"]) for r in got.collect()} == {
        ("a", "d1"): (None, 15),
        ("a", "d2"): (3, 15),
        ("a", None): (None, 15),
        (None, "d1"): (None, 16),
        ("b", "d3"): (None, None),
    }


def test_manifest_and_report(spark):
    leagues = spark.createDataFrame([("E0",), ("I1",)], "league string")
    expected = manifest(leagues, 2008, 2009)
    pairs = {tuple(row) for row in expected.collect()}
    assert pairs == {("0809", "E0"), ("0809", "I1"), ("0910", "E0"), ("0910", "I1")}
    arrived = spark.createDataFrame([("0809", "E0")] * 3 + [("9900", "E0")], "season string, league string")
    assert missing(expected, arrived, ["season", "league"]).count() == 3
    report = {(r["season"], r["league"]): (r["rows"], r["status"]) for r in publish_report(expected, arrived, ["season", "league"]).collect()}
    assert report[("0809", "E0")] == (3, "published") and report[("0910", "I1")] == (0, "missing")


def test_latest(spark):
    rows = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "k int, version int, v string")
    got = latest(rows, ["k"], [F.desc("version")])
    assert sorted(row["v"] for row in got.collect()) == ["new", "only"]
