"""From a folder of CSV files to messages, with a report of what arrived and what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchday.operators.records import manifest
from matchday.schema import LEAGUES
from matchday.sources.files import FILE_NAME, MIN_BYTES, csv_union, provenance, read_headers
from matchday.sources.messages import to_messages

# The seasons of the two producers start in 2008 or 2000 and end with 2023/24.
FIRST_YEAR, LONG_FIRST_YEAR, LAST_YEAR = 2008, 2000, 2023
PAIR = ["season", "league"]
# Counts taken by one observation of the rows that are sent.
OBSERVED = 200


def expected_files(spark: SparkSession, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """(season, league) of every file that should be there."""
    leagues = spark.range(1).select(F.explode(F.array(*[F.lit(name) for name in LEAGUES])).alias("league"))
    return manifest(leagues, first_year, last_year)


def publish(
    spark: SparkSession,
    path: str,
    fmt: str,
    options: dict[str, str],
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    min_bytes: int = MIN_BYTES,
    pattern: str = FILE_NAME,
) -> DataFrame:
    """Send each row of the accepted files below ``path`` as a JSON message; return the report.

    The write is over when all messages are delivered. ``fmt`` is ``kafka`` with its connector, or
    any format that takes a text column ``value``. The report has a row per expected pair and per pair
    that came: season, league, rows, status (published, missing, unexpected, failed) and for failed
    ones the reason; a file that cannot be read is such an outcome and stops nothing. Rows are counted
    while they are sent, so the files are scanned once.
    """
    found = read_headers(spark, path, min_bytes)
    expected = expected_files(spark, first_year, last_year).select(*PAIR)
    files = provenance(found, "path", pattern).select(
        F.col("Season").alias("season"), F.col("League").alias("league"), "error"
    )
    # a row per file that is not as it should be, and one per pair
    failed = files.where("error IS NOT NULL").groupBy(*PAIR).agg(F.min("error").alias("reason"))
    pairs = [tuple(row) for row in expected.union(files.select(*PAIR)).distinct().collect()]
    rows = csv_union(spark, path, min_bytes, pattern, found)
    counts: dict[tuple, int] = {}
    seen = []
    for start in range(0, len(pairs), OBSERVED):
        observation = Observation(f"sent {start}")
        own = [
            F.count_if(F.col("Season").eqNullSafe(season) & F.col("League").eqNullSafe(league)).alias(f"n{place}")
            for place, (season, league) in enumerate(pairs[start : start + OBSERVED], start)
        ]
        rows = rows.observe(observation, *own)
        seen.append(observation)
    to_messages(rows).write.format(fmt).mode("append").options(**options).save()
    for observation in seen:
        counts |= {pairs[int(name[1:])]: number for name, number in observation.get.items()}
    sent = spark.createDataFrame([(*pair, number) for pair, number in counts.items()], "season string, league string, rows bigint")
    report = sent.join(expected.withColumn("_expected", F.lit(True)), PAIR, "left").join(failed, PAIR, "left")
    status = (
        F.when((F.col("rows") == 0) & F.col("reason").isNotNull(), "failed")
        .when(F.col("rows") == 0, "missing")
        .when(F.col("_expected"), "published")
        .otherwise("unexpected")
    )
    return report.select(*PAIR, "rows", status.alias("status"), "reason")
