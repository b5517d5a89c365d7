"""Streaming sources. The caller names the format; connectors are external jars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def kafka_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    """One topic from its start, going on when old offsets are gone.

    The start position counts only for a query without a checkpoint. ``max_per_trigger`` limits a
    micro-batch; without it the first one holds the whole backlog.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def source_options(fmt: str, options: dict[str, str], max_per_trigger: int | None = None) -> dict[str, str]:
    """The caller's options over the defaults of ``kafka_options``, for that format."""
    if fmt != "kafka":
        return {**({"maxFilesPerTrigger": str(max_per_trigger)} if max_per_trigger else {}), **options}
    # where to read is the caller's to say
    defaults = kafka_options("", "", max_per_trigger)
    del defaults["kafka.bootstrap.servers"], defaults["subscribe"]
    return {**defaults, **options}


def stream(
    spark: SparkSession, fmt: str, options: dict[str, str], schema: StructType | str | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """A stream from any source; file formats need ``schema``."""
    reader = spark.readStream.format(fmt).options(**source_options(fmt, options, max_per_trigger))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()
