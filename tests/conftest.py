from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package as well
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from matchday.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def same():
    """Equal as bags of rows, by column name."""

    def check(left, right):
        columns = sorted(left.columns)
        assert columns == sorted(right.columns)
        left, right = left.select(*columns), right.select(*columns)
        assert left.exceptAll(right).limit(3).collect() == []
        assert right.exceptAll(left).limit(3).collect() == []

    return check
