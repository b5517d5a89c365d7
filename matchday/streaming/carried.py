"""Form per micro-batch for a feed in time order, with the last rows of each team carried along.

The work of a batch is a window over its own rows and at most ten earlier ones per team. Unlike the
state of ``last_five``, which one task keeps per team, a team with a large part of a batch is split
over many tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.operators.split import ROWS_PER_CHUNK, find_cuts
from matchday.operators.teams import SIDE
from matchday.plans import strict
from matchday.streaming.sinks import Write

NEW = "_new"


def form_with_carry(
    tails: str,
    write: Write,
    key: list[str] = strict.KEY,
    time: list[str] = strict.TIME,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> Write:
    """Per batch of matches, pass one row per (played match, side) with its form to ``write``.

    ``tails/batch_id=N`` holds each team's last rows after batch N. A batch that comes again starts
    from the tails of the batch before it, so it gives the same rows. Batches must follow one
    another in time; inside a batch the order is free. A batch with a match that is not newer than all
    earlier ones of its team is refused before anything is written, since its form, and that of
    the matches after it, would be wrong: use ``incremental`` for such a feed. A stream that starts
    anew over the tails of an earlier one is refused as well; give it a folder of its own.
    """
    order = strict.row_order(key, time)

    def step(batch: DataFrame, batch_id: int) -> None:
        if exists(batch.sparkSession, f"{tails}/batch_id={batch_id + 1}"):
            raise ValueError(f"{tails} holds batches after number {batch_id}: it belongs to another run")
        played = batch.where(F.col("ftr").isNotNull())
        rows = strict.team_rows(played, key=key, time=time, values=strict.IN_FRAME).withColumn(NEW, F.lit(True))
        if batch_id > 0:
            earlier = batch.sparkSession.read.schema(rows.drop(NEW).schema)
            earlier = earlier.parquet(f"{tails}/batch_id={batch_id - 1}")
            rows = rows.unionByName(earlier.withColumn(NEW, F.lit(False)))
        rows.persist()
        try:
            late = late_teams(rows, order).first() if batch_id > 0 else None
            if late:
                raise ValueError(f"batch {batch_id} has late or repeated matches, among others of {late.asDict()}")
            cuts = find_cuts(rows, strict.GROUP, order, rows_per_chunk)
            write(strict.last_five(rows, order, cuts).where(NEW).drop(NEW), batch_id)
            newest = Window.partitionBy(*strict.GROUP, SIDE).orderBy(*[F.desc(name) for name in order])
            kept = rows.drop(NEW).withColumn("_place", F.row_number().over(newest))
            kept = kept.where(F.col("_place") <= strict.LAST).drop("_place")
            kept.write.mode("overwrite").parquet(f"{tails}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return step


def late_teams(rows: DataFrame, order: list[str]) -> DataFrame:
    """Teams whose new rows do not all come after their earlier ones."""
    place = F.struct(*order)
    spans = rows.groupBy(*strict.GROUP).agg(
        F.min(F.when(F.col(NEW), place)).alias("oldest"), F.max(F.when(~F.col(NEW), place)).alias("newest")
    )
    return spans.where(F.col("oldest") <= F.col("newest")).select(*strict.GROUP)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("any int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
