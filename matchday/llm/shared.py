"""Files in the folder that driver and executors share, by any path that pyarrow can open."""

from __future__ import annotations

import gc
import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from matchday.session import scratch_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``."""
    return scratch_folder(spark, name)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stored(df: DataFrame, name: str, at_once: int | None = None) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again: lineage ends here. ``at_once`` is how many rows
    Python is handed at most in one batch meanwhile, for rows that hold much."""
    path = f"{new_folder(df.sparkSession, name)}.parquet"
    settings = df.sparkSession.conf
    before = settings.get(BATCH_ROWS)
    try:
        if at_once and not 0 < int(before) < at_once:
            settings.set(BATCH_ROWS, str(at_once))
        df.write.parquet(path)
    finally:
        settings.set(BATCH_ROWS, before)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def forget(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, once all that is made of it is written, and what was shuffled for it.

    Spark drops the shuffle files of plans that nothing refers to when the driver collects garbage, which it
    may not do for long while the disks fill.
    """
    spark = SparkSession.active()
    for table in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


# Stores that pyarrow can open, and their names there.
STORES = {"file": "file", "s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "viewfs": "viewfs"}


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and the folder's path in it. A store that pyarrow does not know is an error, not a local folder."""
    found = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):(.*)", path)
    if not found:
        return fs.LocalFileSystem(), path
    scheme, rest = found.group(1).lower(), found.group(2)
    if scheme not in STORES:
        raise ValueError(f"no access to files in {scheme}: use one of {sorted(STORES)}")
    # file:/x is file:///x
    return fs.FileSystem.from_uri(f"{STORES[scheme]}:{rest if rest.startswith('//') else '//' + rest}")


def attempt_name(name: str, suffix: str) -> str:
    """A file name that no other attempt of the same task uses."""
    return f"{name}-{uuid.uuid4().hex}{suffix}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` behind it as it takes to differ from all columns."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
