"""The jobs as a user starts them."""

from __future__ import annotations

import sys

import pytest

from matchday import __main__ as command
from test_streams import topic  # noqa: F401


@pytest.fixture
def run(spark, monkeypatch):
    def start(*arguments):
        monkeypatch.setattr(sys, "argv", ["matchday", *arguments])
        command.main()

    return start


SOURCE = ["--format", "json", "--schema", "value string, id int", "--once"]


def test_land(run, spark, topic, tmp_path):  # noqa: F811
    out, docs = str(tmp_path / "out"), str(tmp_path / "docs")
    run(
        "land", *SOURCE, "--source", f"path={topic}", "--checkpoint", str(tmp_path / "c"), "--out", out,
        "--documents-format", "json", "--documents", f"path={docs}", "--console",
    )
    assert spark.read.parquet(out).count() == 8 and spark.read.json(docs).count() == 8


@pytest.mark.parametrize("job, columns", [("features-a", 30), ("features-b", 45)])
def test_features(run, spark, topic, tmp_path, job, columns):  # noqa: F811
    out, docs = str(tmp_path / "out"), str(tmp_path / "docs")
    run(
        job, *SOURCE, "--source", f"path={topic}", "--checkpoint", str(tmp_path / "c"), "--out", out, "--tie", "id",
        "--documents-format", "json", "--documents", f"path={docs}", "--documents-ledger", str(tmp_path / "ledger"),
    )
    rows = spark.read.parquet(out)
    assert rows.count() == 8 and len(rows.columns) == columns + 2
    assert spark.read.json(docs).where("_batch = 0").count() == 8


def test_a_failed_query_raises(run, spark, topic, tmp_path):  # noqa: F811
    with pytest.raises(Exception):
        run(
            "features-b", *SOURCE, "--source", f"path={topic}", "--checkpoint", str(tmp_path / "c"),
            "--out", str(tmp_path / "out"), "--tie", "no_such_column",
        )


def test_key_of_documents(run, spark, topic, tmp_path, monkeypatch):  # noqa: F811
    """The options of an upsert reach the writer."""
    seen = {}
    monkeypatch.setattr(command.sinks, "append_documents", lambda fmt, options: seen.update(options) or (lambda batch, number: None))
    run(
        "features-b", *SOURCE, "--source", f"path={topic}", "--checkpoint", str(tmp_path / "c"), "--out", str(tmp_path / "out"),
        "--tie", "id", "--documents-format", "mongodb", "--documents", "database=d", "--documents", "collection=c",
        "--documents-key", "Season,Date",
    )
    assert seen["idFieldList"] == "Season,Date" and seen["operationType"] == "replace" and seen["database"] == "d"
