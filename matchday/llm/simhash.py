"""Near-duplicate documents by SimHash fingerprints that meet in the middle.

A fingerprint has 64 bits, and two of them link when at most three bits differ. Both sides walk half
of that way: each emits every variant within one bit, half of the radius rounded down, and two at
distance two meet in the variant between them. The odd third bit is covered by cutting the 64 bits
into three stretches: of three differing bits at least one lies in some stretch, and without that
stretch at most two are left. So every fingerprint emits its variants three times, each time with
another stretch blanked, 131 in all (a ball of two bits around whole fingerprints would be 2,081). What
meets is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.components import components
from matchday.llm.shared import stored

RADIUS = 3
# First bit and number of bits of each stretch.
STRETCHES = ((0, 21), (21, 21), (42, 22))
# Fingerprints of one variant that are compared with each other in one go. Larger groups take the ball of two bits,
# which needs no comparison.
CROWD = 4096
# Hashes of one text whose bits are counted at once.
AT_ONCE = 1 << 16
SEED = 42

ONE = np.uint64(1)
BITS = ONE << np.arange(64, dtype=np.uint64)


def shingles(text: bytes | None, size: int) -> Iterator[bytes]:
    """Runs of ``size`` words joined by a space, repeats included; fewer words give one run of all."""
    # bytes.lower and bytes.split know ASCII only, which is what is wanted
    words = (text or b"").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = (np.cumsum([len(word) + 1 for word in words]) - 1).tolist()
    starts = [0, *(end + 1 for end in ends[:-1])]
    size = min(size, len(words))
    for start, end in zip(starts, ends[size - 1 :]):
        yield joined[start:end]


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """A bit is set if more than half of the shingles' hashes have it; no words give zero."""
    counts, total, held = np.zeros(64, np.int64), 0, []
    hashed = xxhash.xxh64_intdigest
    for shingle in shingles(text, size):
        held.append(hashed(shingle, SEED))
        if len(held) == AT_ONCE:
            counts, total, held = counts + bit_counts(held), total + len(held), []
    if held:
        counts, total = counts + bit_counts(held), total + len(held)
    return int(BITS[2 * counts > total].sum(dtype=np.uint64))


def bit_counts(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprinted(documents: DataFrame, size: int) -> DataFrame:
    """(doc_id, mark): one row per document, the fingerprint as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(text.as_py(), size) for text in batch["body"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(marks.view(np.int64))], schema=schema)

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("body")
    ).mapInArrow(make, "doc_id long, mark long")


def half_way(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Variants within one bit outside of a blanked stretch, and the fingerprint of each."""
    variants = []
    for first, size in STRETCHES:
        blank = ((ONE << np.uint64(size)) - ONE) << np.uint64(first)
        kept = marks & ~blank
        variants += [kept, *(kept ^ bit for bit in BITS if not bit & blank)]
    return np.concatenate(variants), np.tile(marks, len(variants))


def two_bits(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variants within two bits, whether within one, and the fingerprint of each."""
    variants, near = [marks, *(marks ^ bit for bit in BITS)], 65
    variants += [marks ^ (one ^ other) for i, one in enumerate(BITS) for other in BITS[:i]]
    return np.concatenate(variants), np.arange(len(variants)).repeat(len(marks)) < near, np.tile(marks, len(variants))


def met(marks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect all of ``marks`` that links of at most RADIUS bits connect, one less than their number at most."""
    rest = marks
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            close = np.bitwise_count(rest ^ one) <= RADIUS
            found, rest = rest[close], rest[~close]
            yield from ((int(one), int(other)) for other in found)
            reached.extend(found)


def signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("crowded", pa.bool_())])


def half_way_links(nodes: DataFrame, crowd: int) -> DataFrame:
    """(a, b, crowded): verified links of fingerprints that meet in a variant. Where more than ``crowd`` meet,
    they are named instead, with crowded set."""
    schema = pa.schema([("variant", pa.int64()), ("mark", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch["mark"].to_numpy().view(np.uint64)
            for start in range(0, len(marks), 1_000):
                variants, owners = half_way(marks[start : start + 1_000])
                yield pa.RecordBatch.from_arrays([signed(variants), signed(owners)], schema=schema)

    def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, big = None, np.empty(0, np.uint64), False
        for batch in filter(len, batches):
            variant, mark = (batch[name].to_numpy() for name in ("variant", "mark"))
            mark = mark.view(np.uint64)
            cuts = np.flatnonzero(variant[1:] != variant[:-1]) + 1
            start = np.append(0, cuts)
            size = np.diff(np.append(start, len(variant)))
            # groups that begin and end inside of this batch; the first and the last may go on
            inner = np.arange(1, len(start) - 1)
            two = start[inner[size[inner] == 2]]
            two = two[np.bitwise_count(mark[two] ^ mark[two + 1]) <= RADIUS]
            yield links(mark[two], mark[two + 1])
            for i in [0, *inner[size[inner] > 2].tolist(), *([len(start) - 1] if len(start) > 1 else [])]:
                own = mark[start[i] : start[i] + size[i]]
                if variant[start[i]] != last or i:
                    yield from ended(held, big)
                    last, held, big = variant[start[i]], own[:0], False
                held = np.append(held, own)
                if len(held) > crowd:
                    # not held back: memory stays bounded
                    yield from ended(held, True)
                    held, big = held[:0], True
        yield from ended(held, big)

    def ended(held: np.ndarray, big: bool) -> Iterator[pa.RecordBatch]:
        if big and len(held):
            yield links(held, held, True)
        elif len(held) > 1:
            found = list(met(held))
            if found:
                yield links(*zip(*found))

    def links(a, b, crowded: bool = False) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([signed(a), signed(b), pa.array([crowded] * len(a), pa.bool_())], schema=LINK)

    return (
        nodes.select("mark").mapInArrow(emit, "variant long, mark long")
        .repartition("variant").sortWithinPartitions("variant", "mark")
        .mapInArrow(collide, "a long, b long, crowded boolean")
    )


def two_bit_links(nodes: DataFrame) -> DataFrame:
    """(a, b): links by the ball of two bits. Whoever is within one bit of a variant is within three of
    all that are within two bits of it, so each links to one such head and no two are compared."""
    schema = pa.schema([("variant", pa.int64()), ("far", pa.bool_()), ("mark", pa.int64())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch["mark"].to_numpy().view(np.uint64)
            for start in range(0, len(marks), 50):
                variants, near, owners = two_bits(marks[start : start + 50])
                yield pa.RecordBatch.from_arrays([signed(variants), pa.array(~near), signed(owners)], schema=schema)

    def hang(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head, near = None, 0, False
        for batch in filter(len, batches):
            variant, far, mark = (
                batch[name].to_numpy(zero_copy_only=False) for name in ("variant", "far", "mark")
            )
            begins = np.append(True, variant[1:] != variant[:-1])
            begins[0] = last is None or variant[0] != last
            group = np.cumsum(begins)
            heads, nears = np.append(head, mark[begins]), np.append(near, ~far[begins])
            linked = nears[group] & (heads[group] != mark)
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads[group][linked]), pa.array(mark[linked])], schema=pa.schema(list(LINK)[:2])
            )
            last, head, near = variant[-1], heads[group[-1]], nears[group[-1]]

    return (
        nodes.select("mark").mapInArrow(emit, "variant long, far boolean, mark long")
        .repartition("variant").sortWithinPartitions("variant", "far", "mark")
        .mapInArrow(hang, "a long, b long")
    )


def linked(nodes: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``mark`` that connect whatever links of at most
    RADIUS differing bits connect. Every link is one of those."""
    found = stored(half_way_links(nodes, crowd), "met")
    links = found.where("not crowded").select("a", "b")
    crowded = stored(found.where("crowded").select(F.col("a").alias("mark")).distinct(), "crowded")
    if not crowded.isEmpty():
        links = links.union(two_bit_links(crowded))
    return links.distinct()


def near_duplicates(documents: DataFrame, shingle: int = 3, crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Words are lower-cased (A-Z) and split at ASCII white space; XXH64 of every run of ``shingle``
    words, repeats included, votes for the bits of the fingerprint. Documents whose fingerprints differ in at most three bits are
    linked; component_id is the smallest doc_id that a document reaches, itself included.

    Equal fingerprints are one node from the start, so thousands of copies cost one grouped
    minimum. Null, empty and blank texts have fingerprint zero and are linked like any other. Rows
    that repeat are documents of their own with the same result. A null doc_id takes part, but
    names no component; a component without any other has a null component_id. Other columns are
    ignored. An empty table gives an empty result.
    """
    marks = stored(fingerprinted(documents, shingle), "marks")
    nodes = stored(marks.groupBy("mark").agg(F.min("doc_id").alias("lowest")), "nodes")
    roots = components(linked(nodes, crowd)).withColumnRenamed("node", "mark")
    grouped = stored(
        nodes.join(roots, "mark", "left").select("mark", "lowest", F.coalesce("root", "mark").alias("root")), "grouped"
    )
    named = grouped.groupBy("root").agg(F.min("lowest").alias("component_id"))
    classes = grouped.join(named, "root").select("mark", "component_id")
    return marks.join(classes, "mark").select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )
