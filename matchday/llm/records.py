"""Token ids in length-delimited binary records, with an offset index for reads in any order.

A record file is a row of frames, each of one document:

    u64 length, u32 masked checksum of the length, payload, u32 masked checksum of the payload

all little-endian. The payload is a byte 1 and the doc_id as i64 (byte 0 and zero if it is null), a byte with the
width of an id (2 or 4), and the ids. A checksum is CRC-32, turned right by 15 bits plus a constant, so
that a file that holds checksums can be checked in its turn. The index beside it has one u64 per
frame: where it starts. The manifest names the files that count, in order.
"""

from __future__ import annotations

import io
import itertools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchday.llm.pieces import gathered
from matchday.llm.shared import attempt_name, open_folder
from matchday.llm.tokens import CHUNK, encoder_of
from matchday.llm.words import as_batch, batches_of, rows

# Fixed value: what is added to a turned checksum.
MASK = 0xA282EAD8
HEAD = struct.Struct("<QI")
TAIL = struct.Struct("<I")
LEAD = struct.Struct("<BqB")

MANIFEST = pa.schema(
    [("shard", pa.int32()), ("records", pa.string()), ("offsets", pa.string()), ("n_documents", pa.int64()), ("n_ids", pa.int64())]
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked(length)) + payload + TAIL.pack(masked(payload))


def read_frame(stream) -> bytes | None:
    """Payload of the frame at the stream's position; None at its end."""
    head = stream.read(HEAD.size)
    if not head:
        return None
    if len(head) < HEAD.size:
        raise ValueError("a record file ends inside a frame")
    length, check = HEAD.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError("the length of a record is damaged")
    payload, tail = stream.read(length), stream.read(TAIL.size)
    if len(payload) < length or len(tail) < TAIL.size or TAIL.unpack(tail)[0] != masked(payload):
        raise ValueError("a record is damaged")
    return payload


def payload_of(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return LEAD.pack(doc_id is not None, doc_id or 0, width) + ids


def content(payload: bytes) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of a payload."""
    known, doc_id, width = LEAD.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=LEAD.size)


def write_records(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the ids of every text, each followed by ``end_id``, in ascending doc_id order.

    Returns the manifest, as read from ``folder``/manifest.parquet: a row per file. ``tokenizer`` is
    the path of a tokenizers file that all executors can read. Tasks write under names of their
    own attempt; only attempts that ended well are in the manifest, so retries and lost executors
    leave at most files that nothing points to.

    Null texts are empty; null ids come first; rows of the same doc_id are ordered by their text, and rows
    that repeat are written each time. Other columns are ignored. An empty table gives an empty manifest.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        end = np.array([end_id], f"<u{encoder.width}").tobytes()
        shard = TaskContext.get().partitionId()
        filled = gathered(filter(len, batches), CHUNK)
        first = next(filled, None)
        if first is None:
            return
        system, base = open_folder(folder)
        system.create_dir(base, recursive=True)
        name = attempt_name(f"shard-{shard:06d}", ".records")
        offsets, at, n_ids = [], 0, 0
        with system.open_output_stream(f"{base}/{name}") as out:
            for batch in itertools.chain([first], filled):
                ids, begin = encoder.encode_all(batch["text"].to_pylist())
                n_ids += len(ids) + batch.num_rows
                for doc_id, start, stop in zip(batch["doc_id"].to_pylist(), begin.tolist(), begin[1:].tolist()):
                    framed = frame(payload_of(doc_id, ids[start:stop].tobytes() + end, encoder.width))
                    out.write(framed)
                    offsets.append(at)
                    at += len(framed)
        with system.open_output_stream(f"{base}/{name}.offsets") as out:
            out.write(np.array(offsets, "<u8").tobytes())
        yield as_batch([(shard, name, f"{name}.offsets", len(offsets), n_ids)], MANIFEST)

    spark = documents.sparkSession
    ordered = (
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
        )
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = ordered.mapInArrow(write, "shard int, records string, offsets string, n_documents long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest.parquet")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(
        "shard int, records string, offsets string, n_documents long, n_ids long"
    ).parquet(f"{folder}/manifest.parquet")


def in_order(folder: str, row: dict) -> Iterator[tuple[int, bytes]]:
    """Start and payload of every record of a file."""
    system, base = open_folder(folder)
    start = row["start"]
    with system.open_input_stream(f"{base}/{row['records']}", buffer_size=1 << 20) as stream:
        while (payload := read_frame(stream)) is not None:
            yield start, payload
            start += len(content(payload)[1])


def shuffled(folder: str, row: dict, seed: int) -> Iterator[tuple[int, bytes]]:
    """The same in an order by ``seed``, each record found by the offset index."""
    system, base = open_folder(folder)
    with system.open_input_file(f"{base}/{row['records']}.offsets") as index:
        offsets = np.frombuffer(index.read(), "<u8").astype(np.int64)
    with system.open_input_file(f"{base}/{row['records']}") as file:
        sizes = np.diff(np.append(offsets, file.size()))
        # all records of a file have ids of one width
        width = LEAD.unpack_from(file.read(HEAD.size + LEAD.size), HEAD.size)[2]
        counts = (sizes - HEAD.size - LEAD.size - TAIL.size) // width
        starts = row["start"] + np.cumsum(counts) - counts
        for place in np.random.default_rng([seed, row["shard"]]).permutation(len(offsets)).tolist():
            file.seek(int(offsets[place]))
            yield int(starts[place]), read_frame(io.BytesIO(file.read(int(sizes[place]))))


def read_records(manifest: DataFrame, folder: str, seed: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files the manifest names.

    start counts the ids of all records before; ids_crc32 is over the ids as little-endian u32.
    Each file is read by one task and every checksum is checked: frame by frame, or with a ``seed`` in an order
    shuffled by it, each record found by the offset index.
    """
    # one row per file: small however large the files are
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for row in rows(batches):
                every = in_order(folder, row) if seed is None else shuffled(folder, row, seed)
                for start, payload in every:
                    doc_id, ids = content(payload)
                    yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

        yield from batches_of(found(), schema)

    count = max(1, manifest.count())
    return shards.select("shard", "records", "start").repartitionByRange(count, "shard").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_at(folder: str, records: str, places: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records number ``places`` of one file, in that order, found by its offset index."""
    system, base = open_folder(folder)
    with system.open_input_file(f"{base}/{records}.offsets") as index:
        offsets = np.frombuffer(index.read(), "<u8")
    found = []
    with system.open_input_file(f"{base}/{records}") as file:
        for place in places:
            file.seek(int(offsets[place]))
            found.append(content(read_frame(file)))
    return found
