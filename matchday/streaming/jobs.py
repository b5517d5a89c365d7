"""The streaming jobs: landing, and the two feature tables per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from matchday import schema
from matchday.plans import job_a, job_b
from matchday.sources.messages import land, land_flagged, split_quarantine
from matchday.streaming import sinks
from matchday.streaming.sinks import Write, fan_out, for_each_batch, skip_empty


def landed(messages: DataFrame) -> DataFrame:
    """Messages as flat text records; write it with as many sinks as needed."""
    return land(messages, schema.MESSAGE)


def landing_job(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    documents_format: str | None = None,
    documents: dict[str, str] | None = None,
    console: bool = False,
    once: bool = False,
    quarantine: str | None = None,
) -> list[StreamingQuery]:
    """Start the landing: Parquet, and if asked for documents and console, each its own query.

    With ``quarantine``, texts that are no record go to that folder and not to the others.
    """
    rows, rejected = landed(messages), None
    if quarantine:
        rows, rejected = split_quarantine(land_flagged(messages, schema.MESSAGE, schema.NATURAL_KEY))
    queries = [sinks.to_parquet(rows, path, f"{checkpoint}/parquet", once)]
    if rejected is not None:
        queries.append(sinks.to_parquet(rejected, quarantine, f"{checkpoint}/quarantine", once))
    if documents_format:
        options = documents or {}
        queries.append(sinks.to_documents(rows, documents_format, options, f"{checkpoint}/documents", once))
    if console:
        queries.append(sinks.to_console(rows, once))
    return queries


def landing_batches(good: Write, bad: Write) -> Write:
    """Per batch: parse once, write good records and quarantined texts apart."""

    def write(batch: DataFrame, batch_id: int) -> None:
        flagged = land_flagged(batch, schema.MESSAGE, schema.NATURAL_KEY).persist()
        try:
            records, rejected = split_quarantine(flagged)
            good(records, batch_id)
            bad(rejected, batch_id)
        finally:
            flagged.unpersist()

    return write


def _feature_batches(
    features: Callable[[DataFrame, list[str]], DataFrame], message: object, tie: list[str], writes: tuple[Write, ...]
) -> Write:
    def write(batch: DataFrame, batch_id: int) -> None:
        records = land(batch, message, tie).persist()
        try:
            fan_out(*writes)(features(records, tie).drop(*tie), batch_id)
        finally:
            records.unpersist()

    return write


def feature_job_a(
    messages: DataFrame, tie: list[str], checkpoint: str, *writes: Write, once: bool = False
) -> StreamingQuery:
    """Table A per micro-batch. Its windows see one batch; ``incremental`` sees the whole history.

    ``tie`` names source columns that order matches of a day, such as partition and offset.
    """
    batches = _feature_batches(job_a.features, schema.MESSAGE, tie, writes)
    return for_each_batch(messages, skip_empty(batches), checkpoint, once)


def feature_job_b(
    messages: DataFrame, tie: list[str], checkpoint: str, *writes: Write, once: bool = False
) -> StreamingQuery:
    """Table B per micro-batch, with the same limits."""
    batches = _feature_batches(job_b.features, schema.SHORT_MESSAGE, tie, writes)
    return for_each_batch(messages, batches, checkpoint, once)
