"""CSV files, one per (season, league), whose columns differ from file to file."""

from __future__ import annotations

import csv
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.schema import text_schema
from matchday.session import scratch_folder
from matchday.streaming.sinks import replace_partitions

# The smallest size of a real file, and the naming <league>_<season>.csv. Other
# namings are patterns with one group for the league and then one for the season.
MIN_BYTES = 500
FILE_NAME = r"([^/_]+)_(\d{4})\.csv(?:\.gz)?$"
FOLDER_NAME = r"league=([^/]+)/season=(\d{4})/[^/]*\.csv(?:\.gz)?$"
# Bytes of a file that are read for its header; more only if no line ends in them.
FIRST_BLOCK = 4_096
# Stores of which Python workers can read a part of a file, and their names there.
RANGED = {"file": "file", "s3a": "s3", "s3": "s3", "gs": "gs"}
# A header without these is that of another file, such as an error page.
KEY_FIELDS = {"Date", "HomeTeam", "AwayTeam"}
CORRUPT = "_corrupt_record"


def csv_scan(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """CSV with a header row, every column as text, blank cells null."""
    return spark.read.options(header=True, inferSchema=False, **options).csv(paths)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files at any depth; their content is not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(path).select("path", "length")


def gate(length: Column, path: Column, min_bytes: int = MIN_BYTES) -> Column:
    """CSV by name and larger than an error page."""
    return (length > min_bytes) & (path.endswith(".csv") | path.endswith(".csv.gz"))


def accepted(files: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Those of ``list_files`` that pass the gate."""
    return files.where(gate(F.col("length"), F.col("path"), min_bytes))


def passed(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Rows of a file source whose file passes the gate; Spark skips the other files."""
    return rows.where(gate(F.col("_metadata.file_size"), F.col("_metadata.file_path"), min_bytes))


def provenance(df: DataFrame, path: str = "path", pattern: str = FILE_NAME) -> DataFrame:
    """Add Season and League from the file name."""
    return df.withColumns(
        {
            "Season": F.nullif(F.regexp_extract(path, pattern, 2), F.lit("")),
            "League": F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")),
        }
    )


def headers(spark: SparkSession, path: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(path, length, header, error, bytes_read): the first line of each accepted file, or why there is none.

    Executors read the first block of each file and no more, where Python can open the store;
    elsewhere one pass over the text finds the lines, and a file that cannot be read ends the job.
    """
    found = accepted(list_files(spark, path), min_bytes)
    scheme = path.split("://")[0] if "://" in path else path.split(":/")[0] if ":/" in path else "file"
    if scheme in RANGED:
        schema = pa.schema([
            ("path", pa.string()), ("length", pa.int64()), ("header", pa.string()), ("error", pa.string()),
            ("bytes_read", pa.int64()),
        ])

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = zip(*(batch[name].to_pylist() for name in ("path", "length")))
                rows = [(place, length, *first_line(place)) for place, length in places]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema=schema)

        return found.mapInArrow(read, "path string, length bigint, header string, error string, bytes_read bigint")
    lines = passed(spark.read.option("recursiveFileLookup", True).text(path), min_bytes).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("position"),
    )
    return (
        lines.where((F.col("start") == 0) & (F.trim("value") != ""))
        .groupBy("path", "length")
        .agg(F.min_by("value", "position").alias("header"))
        .select("path", "length", "header", F.lit(None).cast("string").alias("error"), F.col("length").alias("bytes_read"))
    )


def first_line(path: str) -> tuple[str | None, str | None, int]:
    """(line, error, bytes read): the first line of a file that is not blank."""
    scheme, _, rest = path.partition(":")
    uri = f"{RANGED[scheme]}:{rest}" if rest.startswith("//") else f"{RANGED[scheme]}://{rest}"
    count = 0
    try:
        store, place = fs.FileSystem.from_uri(uri)
        unpack = zlib.decompressobj(31) if path.endswith(".gz") else None
        text, size = b"", FIRST_BLOCK
        with store.open_input_file(place) as file:
            while True:
                block = file.read(size)
                count += len(block)
                text += unpack.decompress(block) if unpack else block
                lines = [line for line in text.splitlines(keepends=True) if line.strip()]
                if not block or lines and lines[0].endswith((b"\n", b"\r")):
                    break
                size *= 2
        if not lines:
            return None, "no line", count
        return lines[0].rstrip(b"\r\n").decode(errors="replace"), None, count
    # one bad file is an outcome of its own and must not end the run
    except (OSError, zlib.error, pa.ArrowException) as error:
        return None, f"{type(error).__name__}: {error}"[:500], count


def rejected_files(spark: SparkSession, path: str, min_bytes: int = MIN_BYTES, pattern: str = FILE_NAME) -> DataFrame:
    """(path, length, reason) of the files below ``path`` that ``csv_union`` leaves out."""
    listed = list_files(spark, path)
    own = provenance(listed, "path", pattern)
    by_listing = own.select(
        "path", "length",
        F.when(~gate(F.lit(min_bytes + 1), F.col("path"), min_bytes), "name")
        .when(F.col("length") <= min_bytes, "size")
        .when(F.col("Season").isNull() | F.col("League").isNull(), "no season and league").alias("reason"),
    ).where("reason IS NOT NULL")
    seen = provenance(headers(spark, path, min_bytes), "path", pattern).where("Season IS NOT NULL AND League IS NOT NULL")
    lacking = reduce(Column.__or__, [~F.array_contains(cells_of(F.col("header")), name) for name in sorted(KEY_FIELDS)])
    by_header = seen.select(
        "path", "length", F.coalesce(F.col("error"), F.when(lacking, "header")).alias("reason")
    ).where("reason IS NOT NULL")
    return by_listing.union(by_header)


def cells_of(header: Column) -> Column:
    """Cells of a header, for a look at the key fields, which need no quotes."""
    plain = F.regexp_replace(header, '^\ufeff|"', "")
    return F.transform(F.split(plain, ","), F.trim)


def column_names(header: str) -> list[str]:
    """Names of a header line; unnamed and repeated columns get their position as a name.

    Names that differ in case only are repeated, as they are for Spark. No column is lost.
    """
    cells = [cell.strip() for cell in next(csv.reader([header.lstrip("\ufeff")]))]
    given = {cell.lower() for cell in cells}
    names: list[str] = []
    used: set[str] = set()
    for place, name in enumerate(cells):
        if not name or name.lower() in used:
            name = f"_c{place}"
            while name.lower() in given | used:
                name += "_"
        names.append(name)
        used.add(name.lower())
    return names


def layouts(found: DataFrame, path: str) -> tuple[dict[str, str], list[tuple[str, list[int | None], int]]]:
    """Columns of the union by lower-case name, and for each distinct header where they stand and its length."""
    distinct = sorted(row["header"] for row in found.select("header").distinct().collect())
    if not distinct:
        raise ValueError(f"no CSV file that can be read below {path}")
    named = {header: column_names(header) for header in distinct}
    named = {header: names for header, names in named.items() if KEY_FIELDS <= set(names)}
    if not named:
        raise ValueError(f"no file below {path} has the columns {sorted(KEY_FIELDS)}")
    union: dict[str, str] = {}
    for names in named.values():
        for name in names:
            union.setdefault(name.lower(), name)
    places = []
    for header, names in named.items():
        at = {name.lower(): place for place, name in enumerate(names)}
        places.append((header, [at.get(name) for name in union], len(names)))
    return union, places


def read_headers(spark: SparkSession, path: str, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``headers`` kept in the scratch folder."""
    kept = f"{scratch_folder(spark, 'headers')}.parquet"
    headers(spark, path, min_bytes).write.parquet(kept)
    return spark.read.parquet(kept)


PLACES = "header string, places array<int>, width int"


def csv_union(
    spark: SparkSession, path: str, min_bytes: int = MIN_BYTES, pattern: str = FILE_NAME,
    found: DataFrame | None = None, **options: str,
) -> DataFrame:
    """All accepted files below ``path`` as one table by column name, with Season and League.

    One scan reads the files of all layouts by position. Each file's header says at which position a
    column stands; it meets the rows by the file's path, by a broadcast if the headers, kept in the
    scratch folder (or given as ``found``), are small by Spark's own threshold. The driver holds the distinct headers, which
    make up the result's columns, and no file names. Names that differ in case only are one column. A file
    that cannot be read is left out: ``rejected_files`` has the reason. Cells beyond the longest header
    fall away; ``csv_flagged`` keeps such rows apart.
    """
    found = (found or read_headers(spark, path, min_bytes)).where("header IS NOT NULL").select("path", "header")
    union, places = layouts(found, path)
    positions = [f"_{place}" for place in range(max(width for *_, width in places))]
    cells = passed(
        spark.read.schema(text_schema(positions))
        .options(
            header=True, enforceSchema=True, mode="PERMISSIVE", recursiveFileLookup=True, ignoreCorruptFiles=True, **options
        )
        .csv(path),
        min_bytes,
    ).select(F.col("_metadata.file_path").alias("path"), F.array(*positions).alias("cells"))
    where = found.join(spark.createDataFrame(places, PLACES), "header").select("path", "places")
    return by_name(provenance(cells.join(where, "path"), "path", pattern), union)


def by_name(rows: DataFrame, union: dict[str, str], *more: str) -> DataFrame:
    """Columns of the union from ``cells`` and the ``places`` of a row's layout."""
    return rows.select(
        *[
            F.get("cells", F.get("places", F.lit(place))).alias(name)
            for place, (lower, name) in enumerate(union.items())
            if lower not in ("season", "league")
        ],
        "Season",
        "League",
        *more,
    )


def csv_flagged(
    spark: SparkSession, path: str, min_bytes: int = MIN_BYTES, pattern: str = FILE_NAME
) -> DataFrame:
    """As ``csv_union``, with ``raw`` (the line), ``path`` and ``reason``, null for a good row.

    A row is ``ragged`` if it has more or fewer cells than its file's header, ``blank`` if no cell has
    text, and without ``key`` if a key field is empty. Every line is parsed by the layout of its own file, so one parser per
    number of columns stands in the plan.
    """
    found = read_headers(spark, path, min_bytes).where("header IS NOT NULL").select("path", "header")
    union, places = layouts(found, path)
    lines = passed(
        spark.read.options(recursiveFileLookup=True, ignoreCorruptFiles=True).text(path), min_bytes
    ).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))
    where = found.join(spark.createDataFrame(places, PLACES), "header")
    lines = lines.join(where, "path").where((F.col("raw") != F.col("header")) & (F.trim("raw") != ""))
    parsed = F.lit(None)
    for width in sorted({width for *_, width in places}):
        names = [f"_{place}" for place in range(width)]
        # the text itself comes back if the number of cells is another
        schema = ", ".join(f"{name} string" for name in [*names, CORRUPT])
        row = F.from_csv("raw", schema, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
        made = F.transform(
            F.array(row), lambda x: F.struct(F.array(*[x[name] for name in names]).alias("cells"), x[CORRUPT].isNotNull().alias("ragged"))
        )
        parsed = F.when(F.col("width") == width, made[0]).otherwise(parsed)
    rows = provenance(lines.withColumn("_row", parsed), "path", pattern)
    rows = rows.withColumns({"cells": F.col("_row.cells"), "ragged": F.col("_row.ragged")})
    keys = [F.get("cells", F.get("places", F.lit(list(union).index(name.lower())))) for name in sorted(KEY_FIELDS)]
    reason = (
        F.when(~F.exists("cells", lambda cell: cell.isNotNull()), "blank")
        .when(F.col("ragged"), "ragged")
        .when(reduce(Column.__or__, [key.isNull() for key in keys]), "key")
    )
    return by_name(rows.withColumn("reason", reason), union, "path", "raw", "reason")


def raw_lines(
    spark: SparkSession, path: str, min_bytes: int = MIN_BYTES, pattern: str = FILE_NAME
) -> DataFrame:
    """The text of the accepted files line by line, in (file, block_start, position) order.

    Lines rather than whole files, so that a large file is split over many tasks.
    """
    lines = passed(spark.read.option("recursiveFileLookup", True).text(path), min_bytes).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("position"),
        F.col("value").alias("line"),
    )
    return provenance(lines, "file", pattern)


def write_bronze(lines: DataFrame, path: str) -> None:
    """Keep the raw lines as Parquet by season and league; writing a season again replaces it."""
    replace_partitions(
        lines.withColumnsRenamed({"Season": "season", "League": "league"}), path, ["season", "league"]
    )
