"""Stream and batch sinks: files, documents, console, and several at once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from matchday.streaming import snapshots

Write = Callable[[DataFrame, int], None]


def _started(writer: DataStreamWriter, once: bool) -> StreamingQuery:
    """``once`` works off what is there and ends; otherwise batches follow one another."""
    return (writer.trigger(availableNow=True) if once else writer).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append to Parquet; the sink's log makes it exactly once. Give each writer its own path."""
    writer = df.writeStream.outputMode("append").format("parquet")
    return _started(writer.option("path", path).option("checkpointLocation", checkpoint), once)


def to_documents(
    df: DataFrame, fmt: str, options: dict[str, str], checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append to a document store through its connector. Options, with secrets, are the caller's."""
    writer = df.writeStream.outputMode("append").format(fmt).options(**options)
    return _started(writer.option("checkpointLocation", checkpoint), once)


def to_console(df: DataFrame, once: bool = False) -> StreamingQuery:
    """Print whole rows, for debugging; no checkpoint."""
    return _started(df.writeStream.format("console").option("truncate", False), once)


def for_each_batch(df: DataFrame, write: Write, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Run ``write(batch, batch_id)`` per micro-batch. A batch can come again after a failure."""
    writer = df.writeStream.outputMode("append").foreachBatch(write)
    return _started(writer.option("checkpointLocation", checkpoint), once)


def wait(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Return when all of the queries have ended; stop the others and raise if one of them fails."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
        # else the failure would be raised again to whoever waits next in this session
        spark.streams.resetTerminated()


def fan_out(*writes: Write) -> Write:
    """Several writes of one batch, which is computed once and kept for them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for one in writes:
                one(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def replace_batch(path: str, even_files: bool = False, max_records: int = 5_000_000, run: str | None = None) -> Write:
    """Parquet below ``path/run=R/batch_id=N``: a batch that comes again replaces its first attempt.

    A stream that starts anew is another run and replaces nothing. ``run`` is the identity of the streaming query
    unless given; a call outside of a query without one writes below ``path/batch_id=N``.
    ``even_files`` rebalances before the write: a small batch becomes one file, a large one files
    of similar size. That is one more shuffle, so leave it out where tasks write enough each.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        name = run or snapshots.run_of(batch.sparkSession)
        rows = batch.hint("rebalance") if even_files else batch
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", max_records)
        writer.parquet(f"{path}/run={name}/batch_id={batch_id}" if name else f"{path}/batch_id={batch_id}")

    return write


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write Parquet by ``by``, replacing those partitions that ``df`` has rows for.

    Rows are rebalanced by partition, which adaptive execution evens out: a large partition is
    written by many tasks, many small ones by one.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def read_partitions(spark: SparkSession, path: str, text: list[str], folders: list[str] | None = None) -> DataFrame:
    """Read what ``replace_partitions`` wrote, or some ``folders`` of it.

    The ``text`` columns stay text whatever the session infers from folder names: 0809 is no number.
    """
    paths, reader = folders or [path], spark.read.option("basePath", path)
    found = reader.parquet(*paths).schema
    fields = [StructField(f.name, StringType() if f.name in text else f.dataType) for f in found]
    return reader.schema(StructType(fields)).parquet(*paths)


def append_documents(fmt: str, options: dict[str, str]) -> Write:
    """Append each batch to a document store.

    A plain append repeats rows if a batch comes again; pass the connector's upsert options on the
    natural key (``upsert_options``), or use ``append_once``, to avoid that.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("append").options(**options).save()

    return write


BEGUN, DONE = "begun", "done"
Remove = Callable[[SparkSession, str, int], None]


def append_once(
    fmt: str, options: dict[str, str], ledger: str, remove: Remove | None = None, run: str | None = None
) -> Write:
    """Append each batch to a document store that has no upsert, once.

    ``ledger`` is a folder that says which batches have begun and which are done (``snapshots``). A batch that is
    done is not written again. One that has begun only may have left some of its rows: ``remove(spark, run,
    batch_id)`` deletes them, by the columns ``_run`` and ``_batch`` that every document has; without it such a batch is
    refused, since a second append would repeat rows.
    """
    own = uuid.uuid4().hex

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = run or snapshots.run_of(spark) or own
        log = snapshots.read_log(spark, ledger)
        states = {made.attempt for made in log if (made.run, made.batch) == (name, batch_id)}
        if DONE in states:
            return
        if BEGUN in states:
            if remove is None:
                raise RuntimeError(f"batch {batch_id} of run {name} has begun before; its documents must be removed first")
            remove(spark, name, batch_id)
        else:
            log = note(spark, log, name, batch_id, BEGUN)
        marked = batch.withColumns({"_run": F.lit(name), "_batch": F.lit(batch_id).cast("long")})
        marked.write.format(fmt).mode("append").options(**options).save()
        note(spark, log, name, batch_id, DONE)

    def note(spark: SparkSession, log: list, name: str, batch_id: int, state: str) -> list:
        made = replace(snapshots.begin(log, name, batch_id), attempt=state)
        snapshots.commit(spark, ledger, made)
        return [*log, made]

    return write


def upsert_options(database: str, collection: str, key: list[str]) -> dict[str, str]:
    """Options of the MongoDB connector that replace the document with the same key."""
    return {
        "database": database,
        "collection": collection,
        "operationType": "replace",
        "idFieldList": ",".join(key),
        "upsertDocument": "true",
    }


def skip_empty(write: Write) -> Write:
    """Do nothing for a batch without rows."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write(batch, batch_id)

    return guarded
