"""JSON messages: one match per message, all fields text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt_record"


def to_messages(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One JSON text per row in ``value``, null fields left out; ``keep`` columns stay beside it."""
    keep = keep or []
    fields = [name for name in df.columns if name not in keep]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def land(df: DataFrame, schema: StructType, keep: list[str] | None = None) -> DataFrame:
    """Decode ``value`` and parse it; unknown fields are dropped, absent ones are null.

    ``keep`` names source columns to carry along, such as the offset that breaks ties.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema).alias("_data")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_data.*")


def land_flagged(
    df: DataFrame, schema: StructType, key: list[str], keep: list[str] | None = None
) -> DataFrame:
    """As ``land``, with ``quarantined``: the text is no JSON, or a key field is missing."""
    with_corrupt = StructType([*schema.fields]).add(CORRUPT, StringType())
    text = F.col("value").cast("string")
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    rows = df.select(*(keep or []), text.alias("raw"), parsed.alias("_data"))
    bad: Column = F.col("raw").isNull() | F.col(f"_data.{CORRUPT}").isNotNull()
    for name in key:
        bad = bad | F.col(f"_data.{name}").isNull()
    return rows.select(*(keep or []), "raw", bad.alias("quarantined"), "_data.*").drop(CORRUPT)


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and the raw text of the quarantined ones."""
    good = flagged.where(~F.col("quarantined")).drop("raw", "quarantined")
    return good, flagged.where("quarantined").select("raw")
