"""Near-duplicate documents by SuperMinHash signatures, banding, verification and components.

A document is the set of its word shingles. Each element draws a random permutation of the
signature's places, and the rank it gives a place plus a random fraction competes for the minimum
there. Ranks of one element are a permutation, so places are filled evenly and estimates vary less than
with independent hashes; once no place holds a rank above the current one, the document is done.
Links are then confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchday.llm.components import components
from matchday.llm.shared import free_name, stored
from matchday.llm.words import as_batch, batches_of, mix, rows, shingle_hashes, word_hashes

# 32 bands of 4 places: a pair at similarity 0.8 shares no band with probability 5e-8.
PLACES = 128
BAND = 4
# What shares a bucket without being linked is compared by a longer sketch, one bit of the winner per place.
# A pair at 0.8 is estimated below 0.8 - MARGIN with probability under 1e-6.
SKETCH = 4096
MARGIN = 0.046
# Documents of one block when a bucket's remaining pairs are compared block by block.
BLOCK = 512
# Elements ranked at once, for 128 places.
ELEMENTS_AT_ONCE = 100_000
# Rows with texts, sets or sketches that Python is handed at once.
ROWS_AT_ONCE = 1_000


def signatures(sets: list[np.ndarray], places: int = PLACES) -> np.ndarray:
    """(documents, places) uint64: rank in the top 16 bits, random fraction of the winner below.

    Empty sets get the largest value in every place.
    """
    best = np.full((len(sets), places), np.uint64(2**64 - 1))
    active = [i for i, elements in enumerate(sets) if len(elements)]
    # first round: no document has state yet
    for part in chunks(active, sets, places):
        owner = np.repeat(part, [len(sets[i]) for i in part])
        rank(best, owner, np.concatenate([sets[i] for i in part]), 0, None, places)
    active = [i for i in active if int(best[i].max()) >> 48 > 0]
    for part in chunks(active, sets, places):
        owner = np.repeat(part, [len(sets[i]) for i in part])
        elements = np.concatenate([sets[i] for i in part])
        orders = np.tile(np.arange(places, dtype=np.uint16), (len(elements), 1))
        rank(None, owner, elements, 0, orders, places)
        for step in range(1, places):
            open_documents = (best[part].max(axis=1) >> np.uint64(48)) > step - 1
            if not open_documents.any():
                break
            still = np.isin(owner, np.asarray(part)[open_documents])
            if not still.all():
                owner, elements, orders = owner[still], elements[still], orders[still]
                part = list(np.asarray(part)[open_documents])
            rank(best, owner, elements, step, orders, places)
    return best


def chunks(active: list[int], sets: list[np.ndarray], places: int) -> Iterator[list[int]]:
    """Documents in groups of few enough elements for their shuffles to fit in memory."""
    part: list[int] = []
    size = 0
    for i in active:
        part.append(i)
        size += len(sets[i])
        if size * places >= ELEMENTS_AT_ONCE * 128:
            yield part
            part, size = [], 0
    if part:
        yield part


def rank(best, owner, elements, step: int, orders, places: int) -> None:
    """One step of every element's shuffle: the place drawn gets rank ``step`` if that is less."""
    draw = mix(elements + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % 2**64))
    chosen = step + ((draw & np.uint64(0xFFFF)) * np.uint64(places - step) >> np.uint64(16)).astype(np.int64)
    place = chosen
    if orders is not None:
        at = np.arange(len(elements))
        place = orders[at, chosen].astype(np.int64)
        orders[at, chosen] = orders[:, step]
        orders[:, step] = place
    if best is not None:
        value = (np.uint64(step) << np.uint64(48)) | (draw >> np.uint64(16))
        np.minimum.at(best.reshape(-1), np.asarray(owner, dtype=np.int64) * places + place, value)


def distinct_shingles(text: bytes | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(word_hashes(text), size))


def digest(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()),
     ("node", pa.binary()), ("signature", pa.binary())]
)


def signed(documents: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, node, signature); node stands for the set of shingles."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [distinct_shingles(text, shingle) for text in part["body"].to_pylist()]
                low = (mix(signatures(sets)) & np.uint64(0xFFFF)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["text_key"],
                        pa.array([len(elements) for elements in sets], pa.int64()),
                        pa.array([digest(elements) for elements in sets], pa.binary()),
                        pa.array([low[i].tobytes() for i in range(len(sets))], pa.binary()),
                    ],
                    schema=SIGNED,
                )

    return keyed(documents).mapInArrow(
        sign, "doc_id long, text_key long, n_shingles long, node binary, signature binary"
    )


def keyed(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_key"),
        F.col("text").cast("string").cast("binary").alias("body"),
    )


def band_keys(signature: str, places: int = PLACES, band: int = BAND) -> Column:
    width = 2 * band
    return F.array(
        *[
            F.xxhash64(F.lit(i), F.substring(F.col(signature), i * width + 1, width))
            for i in range(places // band)
        ]
    )


def within_size(left: str, right: str, percent: int) -> Column:
    """Sets whose sizes differ too much cannot be similar enough."""
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar: 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, other in zip(batch["left"], batch["right"]):
                one = np.frombuffer(one.as_buffer(), np.uint64)
                other = np.frombuffer(other.as_buffer(), np.uint64)
                common = len(np.intersect1d(one, other, assume_unique=True))
                keep.append(100 * common >= percent * (len(one) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        verify, "a binary, b binary"
    )


def candidate_sets(documents: DataFrame, nodes: DataFrame, candidates: DataFrame, shingle: int) -> DataFrame:
    """(node, elements) for the nodes in ``candidates``, from the text of one of their documents."""
    wanted = nodes.join(candidates, "node", "left_semi").select("node", "doc_id", "text_key")
    # a document without an id is found by its text alone
    spot = [F.coalesce("doc_id", F.lit(0)).alias("spot"), F.col("text_key")]
    texts = keyed(documents).select(*spot, "body").join(wanted.select(*spot, "node"), ["spot", "text_key"])
    schema = pa.schema([("node", pa.binary()), ("elements", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for row in rows(batches):
                elements = distinct_shingles(row["body"], shingle)
                if digest(elements) == row["node"]:
                    yield row["node"], elements.tobytes()

        yield from batches_of(found(), schema, 500)

    made = texts.select("node", "body").mapInArrow(make, "node binary, elements binary")
    return stored(made.dropDuplicates(["node"]), "sets", ROWS_AT_ONCE)


def mixed_buckets(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(number, band, node, label, major, majors, minors): buckets of three or more nodes that hold several
    components, with their largest one and the number of blocks on both sides of it."""
    labelled = (
        buckets.join(roots.withColumnRenamed("root", "label"), "node", "left")
        .select("number", "band", "node", F.coalesce("label", "node").alias("label"))
    )
    shares = labelled.groupBy("band", "label").agg(F.count("*").alias("n"))
    mixed = (
        shares.groupBy("band")
        .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size"), F.count("*").alias("labels"))
        .where("size > 2 and labels > 1")
        .select(
            "band", F.col("top.label").alias("major"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("majors"),
            F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("minors"),
        )
    )
    return labelled.join(mixed, "band")


def sketched(nodes: DataFrame, sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n_shingles, signature, sketch) of the ``wanted`` nodes."""
    schema = pa.schema([("node", pa.binary()), ("sketch", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                made = [np.frombuffer(elements.as_buffer(), np.uint64) for elements in part["elements"]]
                bits = np.packbits((mix(signatures(made, SKETCH)) & np.uint64(1)).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part["node"], pa.array([row.tobytes() for row in bits], pa.binary())], schema=schema
                )

    own = sets.join(wanted.select("node").distinct(), "node", "left_semi").select("node", "elements")
    made = own.mapInArrow(make, "node binary, sketch binary")
    return stored(nodes.select("node", "n_shingles", "signature").join(made, "node"), "sketches", ROWS_AT_ONCE)


def remaining_pairs(buckets: DataFrame, sketches: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs of different components in one bucket whose sketches are alike.

    ``buckets`` is from ``mixed_buckets``. Nodes of a bucket's largest component need no comparison with each
    other; all others meet every node. Both are cut into blocks, and two blocks are compared in one
    go, so no task holds a bucket and pairs that are not alike are never written. With ``best``, two
    components give one pair per two blocks, the most alike. A pair that an earlier band has too is left to that.
    """
    placed = buckets.withColumn("minor", F.col("label") != F.col("major")).withColumn(
        "block", F.pmod(F.xxhash64("node", "band"), F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors"))).cast("int")
    )

    def meet(blocks: str, make) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), make)

    def group(kind: int, low: Column, high: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))

    block = F.col("block")
    groups = F.when(
        F.col("minor"),
        F.concat(
            F.filter(
                meet("minors", lambda other: group(0, F.least(block, other), F.greatest(block, other))),
                lambda two: two["low"] < two["high"],
            ),
            meet("majors", lambda other: group(1, block, other)),
        ),
    ).otherwise(meet("minors", lambda other: group(1, other, block)))
    placed = (
        placed.withColumn("group", F.explode(groups))
        .join(sketches, "node")
        .select("band", "number", "group.*", "minor", "block", "node", "label", "n_shingles", "signature", "sketch")
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    floor = percent / 100 - MARGIN

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            key, held = None, []
            for row in rows(batches):
                here = (row["band"], row["kind"], row["low"], row["high"])
                if here != key:
                    yield from alike(key, held)
                    key, held = here, []
                held.append(row)
            yield from alike(key, held)

        yield from batches_of(found(), schema)

    def alike(key, held: list[dict]) -> Iterator[tuple]:
        if len(held) < 2:
            return
        _, kind, low, high = key
        places = np.stack([np.frombuffer(row["signature"], "<u2") for row in held])
        sketch = np.stack([np.frombuffer(row["sketch"], np.uint64) for row in held])
        # the two sides that meet; a block meets itself beside the first block of the largest component
        side = np.array([row["minor"] if kind else row["block"] == low for row in held])
        size = np.array([row["n_shingles"] for row in held])
        names = {name: i for i, name in enumerate({row["label"] for row in held})}
        label = np.array([names[row["label"]] for row in held])
        number = held[0]["number"]
        tops: dict[tuple[int, int], tuple[float, int, int]] = {}
        for i in np.flatnonzero(side).tolist():
            other = ~side
            if kind and high == 0:
                other |= np.arange(len(held)) > i
            other &= label != label[i]
            other &= np.minimum(size, size[i]) * 100 >= np.maximum(size, size[i]) * percent
            at = np.flatnonzero(other)
            if not len(at):
                continue
            # half of the bits agree by chance
            share = 1 - 2 * np.bitwise_count(sketch[at] ^ sketch[i]).sum(axis=1, dtype=np.int64) / SKETCH
            at, share = at[share >= floor], share[share >= floor]
            bands = (places[at] == places[i]).reshape(len(at), places.shape[1] // BAND, BAND).all(axis=2)
            good = bands.argmax(axis=1) == number
            for j, likeness in zip(at[good].tolist(), share[good].tolist()):
                if not best:
                    yield pair(held[i], held[j])
                    continue
                labels = (min(label[i], label[j]), max(label[i], label[j]))
                if likeness > tops.get(labels, (0.0,))[0]:
                    tops[labels] = (likeness, i, j)
        for _, i, j in tops.values():
            yield pair(held[i], held[j])

    def pair(one: dict, other: dict) -> tuple:
        return min(one["node"], other["node"]), max(one["node"], other["node"])

    return (
        placed.repartition("band", "kind", "low", "high")
        .sortWithinPartitions("band", "kind", "low", "high")
        .mapInArrow(compare, "a binary, b binary")
    )


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and text_key (hash of the text).

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of
    ``shingle``-word shingles (words in lower case for A-Z, split at ASCII white space; a text with fewer
    words is one shingle). component_id is the smallest doc_id reachable over links, kept says that
    it is the document's own.

    Equal sets are one node from the start, so thousands of copies cost one grouped minimum. In
    each bucket of a band every node is checked against one node, drawn anew for each bucket, so a
    large group hangs together after this. Pairs that are still in different components are
    compared block by block (``remaining_pairs``), first the most alike, then all that are left.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat a
    doc_id are the same document. A null doc_id takes part, but a component is named by its smallest
    id that is not null; a component without any has a null component_id and is kept. Other columns
    are ignored. An empty table gives an empty result.
    """
    marks = stored(signed(documents, shingle), "signed", ROWS_AT_ONCE)
    filled = marks.where("n_shingles > 0")
    nodes = stored(
        filled.groupBy("node").agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"),
            F.min("doc_id").alias("lowest"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ).select("node", "first.*", "lowest", "n_shingles", "signature"),
        "nodes",
    )
    banded = nodes.select("node", "n_shingles", F.posexplode(band_keys("signature")).alias("number", "band"))
    heads = (
        banded.groupBy("band")
        .agg(F.min(F.struct(F.xxhash64("node", "band"), "node", "n_shingles")).alias("head"), F.count("*").alias("size"))
        .where("size > 1")
    )
    buckets = stored(banded.join(heads.select("band", "head"), "band"), "buckets")
    least, most = F.least("node", "head.node"), F.greatest("node", "head.node")
    pairs = stored(
        buckets.where(F.col("node") != F.col("head.node"))
        .where(within_size("n_shingles", "head.n_shingles", percent))
        .select(least.alias("a"), most.alias("b"))
        .distinct(),
        "pairs",
    )
    crowded = buckets.select("number", "band", "node")
    sets = candidate_sets(documents, nodes, buckets.select("node").distinct(), shingle)
    links = stored(confirmed(pairs, sets, percent), "confirmed", ROWS_AT_ONCE)
    roots = stored(components(links), "roots")
    sketches = None
    for best in (True, False):
        mixed = stored(mixed_buckets(crowded, roots), "mixed")
        # components only grow, so later buckets need no other nodes
        if sketches is None:
            sketches = sketched(nodes, sets, mixed)
        rest = remaining_pairs(mixed, sketches, percent, best).join(pairs, ["a", "b"], "left_anti")
        more = stored(confirmed(rest, sets, percent), "confirmed", ROWS_AT_ONCE)
        if not more.isEmpty():
            links = links.union(more)
            roots = stored(components(links), "roots")
    # name each component by its smallest document
    named = nodes.join(roots, "node").groupBy("root").agg(F.min("lowest").alias("component_id"))
    labels = roots.join(named, "root").select("node", "component_id")
    classes = nodes.join(labels, "node", "left").select(
        "node", F.coalesce("component_id", "lowest").alias("component_id")
    )
    found = marks.select("doc_id", "text_key", "n_shingles", "node").join(classes, "node", "left")
    # without shingles a document stands for itself
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key",
    )


def without_copies(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, that ``near_duplicates`` keeps."""
    at, key = (free_name(documents, name) for name in ("_doc", "_key"))
    gone = near_duplicates(documents, shingle, percent).where(~F.col("kept")).select(
        F.col("doc_id").alias(at), F.col("text_key").alias(key)
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(at)) & (F.xxhash64("text") == F.col(key))
    return documents.join(gone, same, "left_anti")
