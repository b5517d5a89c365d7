"""Carried form against the window over all matches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from matchday.operators.split import Cuts
from matchday.plans import strict
from matchday.sources.fixture import matches
from matchday.streaming.carried import form_with_carry
from matchday.streaming.sinks import replace_batch


@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 4])
def test_batches_in_time_order(spark, tmp_path, same, rows_per_chunk):
    rows = matches(spark, SMALL)
    # one team plays a third of all matches
    rows = rows.withColumn(
        "home_team", F.when(F.col("match_id") % 3 == 0, "F1_hot").otherwise(F.col("home_team"))
    ).withColumn("league", F.lit("F1")).withColumn("season", F.lit("0809")).cache()
    out, tails = str(tmp_path / "out"), str(tmp_path / "tails")
    step = form_with_carry(tails, replace_batch(out), rows_per_chunk=rows_per_chunk)
    for number, (low, high) in enumerate([(0, 10), (10, 11), (11, 25), (25, 40)]):
        day = F.dayofmonth("match_ts")
        part = rows.where((day >= low) & (day < high))
        step(part, number)
        if number == 2:
            step(part, number)  # comes again
    teams = strict.team_rows(rows.where("ftr IS NOT NULL"), values=strict.IN_FRAME)
    order = strict.row_order(strict.KEY, strict.TIME)
    expected = strict.last_five(teams, order, Cuts(strict.GROUP, order))
    same(spark.read.parquet(out).drop("batch_id"), expected)
    sides = strict.LAST * spark.read.parquet(f"{tails}/batch_id=3").select("team", "side").distinct().count()
    assert spark.read.parquet(f"{tails}/batch_id=3").count() <= sides


def test_late_batches_and_other_runs_are_refused(spark, tmp_path):
    rows = matches(spark, SMALL).where("ftr IS NOT NULL")
    rows = rows.withColumns({"home_team": F.lit("F1_hot"), "league": F.lit("F1"), "season": F.lit("0809")}).cache()
    day = F.dayofmonth("match_ts")
    step = form_with_carry(str(tmp_path / "tails"), replace_batch(str(tmp_path / "out")))
    step(rows.where(day <= 5), 0)
    step(rows.where(day == 10), 1)
    with pytest.raises(ValueError, match="late"):
        step(rows.where(day == 7), 2)
    with pytest.raises(ValueError, match="late"):
        step(rows.where(day == 10), 2)
    assert not (tmp_path / "out" / "batch_id=2").exists()
    step(rows.where(day == 11), 2)
    with pytest.raises(ValueError, match="another run"):
        step(rows.where(day <= 5), 0)
