"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from matchday.plans.file_queries import FILE_QUERIES
from matchday.plans.queries import QUERIES as MATCH_QUERIES

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    # but for those of the text operators, which have tests of their own
    assert set(SQL) <= set(QUERIES)
    assert {*MATCH_QUERIES, *FILE_QUERIES} <= set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SMALL)
    answer = tables.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, df.collect()) == bag(names, answer.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 900
