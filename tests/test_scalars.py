from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from matchday.functions import scalars


def one(spark, kind, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row["r"] for row in rows.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_to_int_takes_floats_as_text_and_no_garbage(spark):
    got = one(spark, "string", ["2", "2.0", " 3 ", "x", "", None, "99999999999"], scalars.to_int)
    assert got == [2, 2, 3, None, None, None, None]


DATES = ["17/08/2002", "17/08/02", "7/8/2002", "garbage", "31/02/2002", None]


def test_date_strict(spark):
    day = datetime.date(2002, 8, 17)
    got = one(spark, "string", DATES, scalars.match_date)
    assert got == [day, day, datetime.date(2002, 8, 7), None, None, None]


def test_date_compat_takes_the_year_as_written(spark):
    got = one(spark, "string", DATES, lambda c: scalars.match_date(c, scalars.COMPAT).cast("string"))
    assert got == ["2002-08-17", "0002-08-17", "2002-08-07", None, None, None]


def test_date_compat_fallback(spark):
    def make(c):
        return scalars.match_date(c, scalars.COMPAT, fallback=True).cast("string")

    assert one(spark, "string", ["2017/08/12", "17/08/02"], make) == ["2017-08-12", "0002-08-17"]


@pytest.mark.parametrize(
    "profile, kept", [(scalars.COMPAT, ["2021"]), (scalars.STRICT, ["0809", "1920", "2021"])]
)
def test_season_filter(spark, profile, kept):
    rows = spark.createDataFrame([(s,) for s in ["0809", "1920", "2021", "0001", "x"]], "s string")
    got = rows.where(scalars.season_from(F.col("s"), 2008, profile)).collect()
    assert sorted(row["s"] for row in got) == kept


def test_season_code(spark):
    assert one(spark, "int", [2000, 2008, 2099], scalars.season_code) == ["0001", "0809", "9900"]


def test_points(spark):
    assert one(spark, "string", ["H", "D", "A", None], lambda c: scalars.points(c, "H")) == [3, 1, 0, 0]
    assert one(spark, "string", ["H", "D", "A", None], lambda c: scalars.points(c, "A")) == [0, 1, 3, 0]


def test_discipline_is_null_if_a_weighted_term_is(spark):
    rows = spark.createDataFrame([(None, 1, 1), (2, 1, 1)], "f int, y int, r int")
    fouls = scalars.discipline(scalars.FOUL_WEIGHTS, F.col("y"), F.col("r"), F.col("f"))
    cards = scalars.discipline(scalars.CARD_WEIGHTS, F.col("y"), F.col("r"), F.col("f"))
    got = rows.select(fouls.alias("a"), cards.alias("b")).collect()
    assert [tuple(row) for row in got] == [(None, 30), (39, 30)]


def test_only_plain_decimals_are_numbers(spark):
    texts = ["1e1", "2d", "2f", "0x1p3", "2.0", " 7 ", "-3", "+4", ".5", "5.", "NaN", "", None, "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(scalars.to_int(F.col("t")).alias("n")).collect()]
    assert got == [None, None, None, None, 2, 7, -3, 4, 0, 5, None, None, None, None]
