"""WARC archives in shards sorted by page_id, with revisit records for repeated payloads.

Every record is a gzip member of its own. Headers, digests and dates come from the row alone, and the bounds of
the shards from exact sums over ranges of ids, so a rerun writes the same bytes whatever the cluster. A shard rolls to a new file
when the compressed size passes a limit. Files are written under temporary names and renamed when they are whole; the name holds
a digest of the bytes, so another attempt can only put the same file in its place, and nothing is ever deleted that
a manifest may name. The manifest names the files that count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.shared import attempt_name, open_folder, stored
from matchday.llm.words import as_batch, batches_of, rows

ROLL_BYTES = 256 * 2**20
# Payload of a shard: a part of all of it within these bounds, so that small tables have some shards and large ones no more than they need.
SHARDS = 1024
SHARD_BYTES = (8 * 2**20, 2**30)
# Ranges of ids that are summed up at once; those that hold more than a shard are cut again.
RANGES = 4096
# Dates are not in the rows, and the profile of a revisit by payload digest.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "urn:page:"

MANIFEST = pa.schema(
    [("shard", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("n_records", pa.int64()),
     ("first_page", pa.int64()), ("last_page", pa.int64()), ("bytes", pa.int64())]
)
MANIFEST_DDL = "shard int, number int, file string, n_records long, first_page long, last_page long, bytes long"


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base 32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_uri(page_id: int | None) -> str:
    return f"<{RECORD}{'' if page_id is None else page_id}>"


def page_of(uri: str) -> int | None:
    number = uri.strip("<>").removeprefix(RECORD)
    return int(number) if number else None


def headers(lines: list[tuple[str, str]], first: str) -> bytes:
    return "".join([f"{first}\r\n", *[f"{name}: {value}\r\n" for name, value in lines], "\r\n"]).encode()


def record(page_id: int | None, url: str | None, payload: bytes, response: int | None) -> bytes:
    """A response record; if ``response`` is given, a revisit of that page, without the payload."""
    http = headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    block = http if response is not None else http + payload
    lines = [
        ("WARC-Type", "response" if response is None else "revisit"),
        ("WARC-Record-ID", page_uri(page_id)),
        ("WARC-Date", DATE),
    ]
    if url is not None:
        # what a header or a URI cannot hold is escaped
        lines.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if response is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", page_uri(response))]
    lines += [
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return headers(lines, "WARC/1.1") + block + b"\r\n\r\n"


class Archive:
    """Files of one shard after the other, rolled by compressed size."""

    def __init__(self, folder: str, roll_bytes: int):
        self.system, self.base = open_folder(folder)
        self.system.create_dir(self.base, recursive=True)
        self.roll_bytes = roll_bytes
        self.shard, self.number, self.out = None, 0, None

    def add(self, shard: int, page_id: int | None, data: bytes) -> Iterator[tuple]:
        """Write one record; manifest rows of the files that this ends."""
        if shard != self.shard:
            yield from self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.temporary = f"{self.base}/{attempt_name(f'_{self.shard:06d}-{self.number:05d}', '.tmp')}"
            self.out = self.system.open_output_stream(self.temporary)
            self.size = self.records = 0
            self.first, self.hash = page_id, hashlib.sha256()
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.hash.update(member)
        self.size += len(member)
        self.records += 1
        self.last = page_id
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        # the name stands for the bytes: whatever is there under it already is this file
        name = f"pages-{self.shard:06d}-{self.number:05d}-{self.hash.hexdigest()[:16]}.warc.gz"
        self.system.move(self.temporary, f"{self.base}/{name}")
        yield self.shard, self.number, name, self.records, self.first, self.last, self.size
        self.number += 1


def shard_bounds(body: DataFrame) -> list[int]:
    """First ids of all shards but the first one, which also has the rows without id."""
    own = stored(body.where("page_id is not null").select("page_id", F.length("payload").alias("size")), "sizes")
    ends = own.agg(F.min("page_id"), F.max("page_id"), F.sum("size")).first()
    if ends[0] is None:
        return []
    most = min(max(ends[2] // SHARDS, SHARD_BYTES[0]), SHARD_BYTES[1])
    sums: dict[int, int] = {}
    todo = [(ends[0], ends[1] + 1)]
    while todo:
        # at most RANGES sums come back for each range that is cut; those that go on hold more than a shard each
        finer = []
        for low, high in todo:
            width = -(-(high - low) // RANGES)
            found = (
                own.where(F.col("page_id").between(low, high - 1))
                .groupBy(F.expr(f"(cast(page_id as decimal(20, 0)) - ({low})) div {width}").alias("part")).agg(F.sum("size").alias("size")).collect()
            )
            for part, size in found:
                begin = low + part * width
                if size > most and width > 1:
                    finer.append((begin, min(begin + width, high)))
                else:
                    sums[begin] = size
        todo = finer
    bounds, filled = [], 0
    for begin in sorted(sums):
        if filled and filled + sums[begin] > most:
            bounds.append(begin)
            filled = 0
        filled += sums[begin]
    return bounds


def shard_of(page_id: Column, bounds: list[int]) -> Column:
    """Number of the shard, by binary search in code that is generated."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(page_id >= bounds[middle], search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def repeated(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, refers_to) of the pages whose payload a larger page_id has too.

    Only ids and digests move; copies are grouped to one maximum first.
    """
    marked = pages.where(F.length("payload") >= least_bytes).select(
        "page_id", F.unhex(F.sha1("payload")).alias("sha"), F.length("payload").alias("size")
    )
    responses = (
        marked.groupBy("sha", "size")
        .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"), F.count("page_id").alias("known"), F.count("*").alias("all"))
        .where("least < refers_to or (known < all and known > 0)")
        .select("sha", "size", "refers_to")
    )
    return marked.join(responses, ["sha", "size"]).where(
        F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to"))
    ).select("page_id", "sha", "refers_to")


def write_archives(
    pages: DataFrame, folder: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write a record per row of (page_id, url, html) and return the manifest, a row per file.

    The payload is the html in UTF-8, empty if null. Of equal payloads of at least ``least_bytes``,
    the one with the largest page_id is a response and the others revisit it. Rows that
    repeat that page_id are responses too. Rows without page_id come first and revisit if any page with an id has their
    payload. A null url gives no target header. Other columns are ignored; an empty table gives an empty manifest.

    Pages move once, by ranges of page_id. What repeats is found on digests alone and travels to the pages
    as rows between them, so there is no wide join and no hot payload.
    """
    body = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    notes = repeated(body, least_bytes)
    both = body.select(
        "page_id", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("binary").alias("sha"), F.lit(None).cast("long").alias("refers_to")
    ).union(
        notes.distinct().select(
            "page_id", F.lit(0), F.lit(None).cast("string"), F.lit(None).cast("binary"), "sha", "refers_to"
        )
    )
    bounds = shard_bounds(body)
    both = both.withColumn("shard", shard_of(F.col("page_id"), bounds))
    # a shard is written by one task, wherever it runs
    ordered = both.repartitionByRange(len(bounds) + 1, "shard").sortWithinPartitions("shard", "page_id", "kind", "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = Archive(folder, roll_bytes)
        page, responses, files = None, {}, []
        for row in rows(batches):
            if row["page_id"] != page:
                page, responses = row["page_id"], {}
            if row["kind"] == 0:
                # by payload, since rows may repeat a page_id with another payload
                responses[row["sha"]] = row["refers_to"]
                continue
            response = responses.get(hashlib.sha1(row["payload"]).digest()) if responses else None
            files += archive.add(row["shard"], page, record(page, row["url"], row["payload"], response))
        files += archive.close()
        if files:
            yield as_batch(files, MANIFEST)

    ordered.mapInArrow(write, MANIFEST_DDL).write.parquet(f"{folder}/manifest.parquet")
    return read_manifest(pages.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).parquet(f"{folder}/manifest.parquet")


def members(stream) -> Iterator[bytes]:
    """Records of a file: the unpacked gzip members, one at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(1 << 18)
        if not data:
            break
        parts.append(unpack.decompress(data))
        rest = unpack.unused_data
        if unpack.eof:
            yield b"".join(parts)
            unpack, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("an archive ends inside a record")


def parse(data: bytes) -> tuple:
    """(page_id, url, payload bytes, payload digest, type, refers_to, payload or None) of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if f"sha1:{digest(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError("a record's block is damaged")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    marked = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest(payload) != marked):
        raise ValueError("a record's payload is damaged")
    refers = fields.get("WARC-Refers-To")
    return (
        page_of(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, marked, kind,
        page_of(refers) if refers else None, payload if kind == "response" else None,
    )


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record, and url and
    payload (null for a revisit) on demand. One task reads a file; all digests are checked."""
    fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())]
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        fields += [("url", pa.string()), ("payload", pa.binary())]
        ddl += ", url string, payload binary"
    schema = pa.schema(fields)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for row in rows(batches):
                system, base = open_folder(folder)
                with system.open_input_stream(f"{base}/{row['file']}", compression=None) as stream:
                    for data in members(stream):
                        page, url, size, marked, kind, refers, payload = parse(data)
                        more = (url, payload) if with_payload else ()
                        yield (page, size, marked, kind, refers, *more)

        yield from batches_of(found(), schema, 500 if with_payload else 2_000)

    count = max(1, manifest.count())
    return manifest.select("shard", "number", "file").repartitionByRange(count, "shard", "number").mapInArrow(read, ddl)
