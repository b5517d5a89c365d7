"""Ranked lexical search with posting lists in geometric blocks.

Documents are vectors of term impacts. They are ordered by the side of random hyperplanes on which they lie, so
neighbours are alike, and consecutive ones make a cell. In a cell each term has a posting list, cut
into blocks of documents that lie together, and each block has a summary: of every term, the largest
impact among the block's documents, rounded up. The inner product of a query and a summary is a
bound on the score of every document in the block; a block is skipped only when its bound is below a score that
enough documents are known to reach, so results are exact.

A hot term's list is spread over all cells, and no step depends on the number of documents of a term.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.pieces import Words, byte_table, gathered, ranges
from matchday.llm.shared import stored
from matchday.llm.words import mix, word_hashes

TOP = 10
# Documents of a cell, and cells of its table of documents by terms at most; beyond that it is halved.
CELL = 2048
CELL_TABLE = 24_000_000
# Blocks a list is cut into, and documents a block has at least. Smaller blocks have no summary: it would be as long as they are.
BLOCKS, LEAST = 4, 32
# Impacts are below a million; summaries hold them in steps of this size, rounded up.
STEP = 4096
# Bytes of items that are searched in one go: their terms and weights are broadcast.
ITEM_BYTES = 16_000_000
CHUNK = 4_000_000
PLANES = 32
TABLE = byte_table(bytes({*range(128)} - {*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"} - {10}), b"")


def bodies(df: DataFrame, key: str) -> DataFrame:
    return df.select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body")
    )


def counted(texts: list[bytes], numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and for the terms in ``numbers``: text, number and count."""
    words = Words(texts, TABLE)
    # +1 keeps unknown terms out of the way of number 0
    known = np.array([numbers.get(word, -1) for word in words.dictionary.to_pylist()], np.int64)
    number = known[words.ids] if len(words.ids) else np.zeros(0, np.int64)
    found = number >= 0
    base = np.int64(max(len(numbers), 1))
    pairs, count = np.unique(words.text[found] * base + number[found], return_counts=True)
    return np.bincount(words.text, minlength=len(texts)), pairs // base, pairs % base, count


VECTOR = pa.schema([("doc_id", pa.int64()), ("length", pa.int64()), ("terms", pa.binary()), ("values", pa.binary())])
VECTOR_FIELDS = "doc_id long, length long, terms binary, values binary"


def term_counts(documents: DataFrame, numbers: Broadcast) -> DataFrame:
    """(doc_id, length, terms, values): all terms of a document, and its counts of the numbered terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, CHUNK):
            length, text, number, times = counted(batch["body"].to_pylist(), numbers.value)
            cuts = np.searchsorted(text, np.arange(batch.num_rows + 1)).tolist()
            number, times = number.astype("<i4"), times.astype("<i4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array(length, pa.int64()),
                    *(
                        pa.array([values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())
                        for values in (number, times)
                    ),
                ],
                schema=VECTOR,
            )

    return bodies(documents, "doc_id").mapInArrow(count, VECTOR_FIELDS)


def impacts(length, counts: np.ndarray, documents: int, words: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 8 * m), m from the document's length."""
    tf = counts.astype(np.int64)
    m = 25 + (75 * length * documents) // words
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def vectors(counts: DataFrame, documents: int, words: int) -> DataFrame:
    """Counts replaced by impacts, for documents with any numbered term."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                impacts(length, np.frombuffer(values, "<i4"), documents, words).astype("<i4").tobytes()
                for length, values in zip(batch["length"].to_pylist(), batch["values"].to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["length"], batch["terms"], pa.array(made, pa.binary())], schema=VECTOR
            )

    return counts.where("length(terms) > 0").mapInArrow(weigh, VECTOR_FIELDS)


def flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms and values of a batch of vectors, and where each vector starts."""
    terms, values = (np.frombuffer(b"".join(batch[name].to_pylist()), "<i4") for name in ("terms", "values"))
    start = np.append(0, np.cumsum([len(own) >> 2 for own in batch["terms"].to_pylist()]))
    return terms, values, start


def term_facts(found: DataFrame, size: int, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of documents of each of ``size`` terms, and the ``top``-th largest impact (0 if there are fewer)."""
    schema = pa.schema([("term", pa.int32()), ("df", pa.int64()), ("best", pa.binary())])

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, best = np.zeros(size, np.int64), np.zeros((size, top), np.int32)
        for batch in gathered(batches, CHUNK):
            terms, values, _ = flat(batch)
            df += np.bincount(terms, minlength=size)
            order = np.lexsort((-values, terms))
            terms, values = terms[order], values[order]
            place = np.arange(len(terms)) - np.searchsorted(terms, terms)
            lead = place < top
            own = np.zeros((size, top), np.int32)
            own[terms[lead], place[lead]] = values[lead]
            best = -np.sort(-np.hstack([best, own]), axis=1)[:, :top]
        seen = np.flatnonzero(df)
        for start in range(0, len(seen), 10_000):
            part = seen[start : start + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()), pa.array(df[part], pa.int64()),
                    pa.array([row.astype("<i4").tobytes() for row in best[part]], pa.binary()),
                ],
                schema=schema,
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df: dict[int, int] = {}
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for term, number, own in zip(*(batch[name].to_pylist() for name in schema.names)):
                df[term] = df.get(term, 0) + number
                both = np.append(best.get(term, np.zeros(0, "<i4")), np.frombuffer(own, "<i4"))
                best[term] = -np.sort(-both)[:top]
        if df:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(df), pa.int32()), pa.array(list(df.values()), pa.int64()),
                    pa.array([best[term].astype("<i4").tobytes() for term in df], pa.binary()),
                ],
                schema=schema,
            )

    fields = "term int, df long, best binary"
    df, least = np.zeros(size, np.int64), np.zeros(size, np.int64)
    # a row per term of the items searched in one go
    for term, number, best in found.mapInArrow(sum_up, fields).repartition("term").mapInArrow(merge, fields).collect():
        df[term], least[term] = number, np.frombuffer(best, "<i4")[-1]
    return df, least


class Cell:
    """Documents that lie together, with the posting list of each of their terms in blocks.

    ``terms`` are the distinct terms, everything else names them by their place there. ``starts``, ``places``
    and ``values`` are the documents' vectors; ``list_starts`` says where the blocks of a term begin,
    ``block_starts`` and ``members`` what documents a block has, ``sum_starts``, ``sum_places`` and
    ``sum_values`` its summary (none for small blocks), ``most`` the largest impact of each term.
    """

    def __init__(self, **parts: np.ndarray) -> None:
        self.__dict__.update(parts)

    @classmethod
    def built(cls, ids: np.ndarray, unnamed: np.ndarray, keys: np.ndarray, terms, values, starts) -> Iterator[Cell]:
        """Cells of documents in the order of their keys."""
        distinct, places = np.unique(terms, return_inverse=True)
        if len(ids) > 1 and len(ids) * len(distinct) > CELL_TABLE:
            half = len(ids) // 2
            cut = starts[half]
            yield from cls.built(ids[:half], unnamed[:half], keys[:half], terms[:cut], values[:cut], starts[: half + 1])
            yield from cls.built(ids[half:], unnamed[half:], keys[half:], terms[cut:], values[cut:], starts[half:] - cut)
            return
        owner = np.repeat(np.arange(len(ids)), np.diff(starts))
        table = np.zeros((len(ids), len(distinct)), np.uint8)
        table[owner, places] = -(-values // STEP)
        most = np.zeros(len(distinct), np.int32)
        np.maximum.at(most, places, values)
        # posting lists in the order of the keys
        order = np.argsort(places, kind="stable")
        members = owner[order]
        list_ends = np.cumsum(np.bincount(places, minlength=len(distinct)))
        blocks, list_starts, sums, sizes = [], [0], [], []
        for begin, end in zip(np.append(0, list_ends[:-1]).tolist(), list_ends.tolist()):
            own = members[begin:end]
            inner = block_cuts(keys[own], max(LEAST, -(-len(own) // BLOCKS)))
            blocks.append(begin + inner)
            list_starts.append(list_starts[-1] + len(inner))
            made = np.maximum.reduceat(table[own], inner, axis=0)
            made[np.diff(np.append(inner, len(own))) < LEAST] = 0
            row, place = np.nonzero(made)
            sums.append((place, made[row, place]))
            sizes.append(np.bincount(row, minlength=len(inner)))
        yield cls(
            ids=ids, unnamed=unnamed, terms=distinct, starts=starts, places=places, values=values, most=most,
            list_starts=np.array(list_starts), block_starts=np.append(np.concatenate(blocks), len(members)),
            members=members, sum_starts=np.append(0, np.cumsum(np.concatenate(sizes))),
            sum_places=np.concatenate([place for place, _ in sums]),
            sum_values=np.concatenate([value for _, value in sums]),
        )

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that score ``least`` or more, but for some that ``top`` others exceed."""
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at, weights = at[known], weights[known]
        share = weights * self.most[at]
        # lists whose terms cannot reach the score without any other need not be opened
        order = np.argsort(share, kind="stable")
        opened = at[order[np.cumsum(share[order]) >= least]]
        if not len(opened):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        query = np.zeros(len(self.terms), np.int64)
        query[at] = weights
        block = ranges(self.list_starts[opened], self.list_starts[opened + 1] - self.list_starts[opened])
        begin, size = self.sum_starts[block], self.sum_starts[block + 1] - self.sum_starts[block]
        bound = np.full(len(block), np.iinfo(np.int64).max)
        some = size > 0
        if some.any():
            entry = ranges(begin[some], size[some])
            product = query[self.sum_places[entry]] * self.sum_values[entry] * STEP
            bound[some] = np.add.reduceat(product, np.append(0, np.cumsum(size[some])[:-1]))
        order = np.argsort(-bound, kind="stable")
        block, bound = block[order], bound[order]
        # first the blocks of the largest bounds, to learn what the others must reach
        sizes = self.block_starts[block + 1] - self.block_starts[block]
        first = int(np.searchsorted(np.cumsum(sizes), 2 * top)) + 1
        seen = np.zeros(len(self.ids), bool)
        places, scores = self.scored(block[:first][bound[:first] >= least], seen, query)
        if len(scores) >= top:
            least = max(least, int(np.partition(scores, -top)[-top]))
        more, found = self.scored(block[first:][bound[first:] >= least], seen, query)
        places, scores = np.append(places, more), np.append(scores, found)
        good = scores >= least
        return places[good], scores[good]

    def scored(self, block: np.ndarray, seen: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        member = np.unique(self.members[ranges(self.block_starts[block], self.block_starts[block + 1] - self.block_starts[block])])
        member = member[~seen[member]]
        seen[member] = True
        if not len(member):
            return member.astype(np.int64), np.zeros(0, np.int64)
        size = self.starts[member + 1] - self.starts[member]
        entry = ranges(self.starts[member], size)
        product = query[self.places[entry]] * self.values[entry]
        return member.astype(np.int64), np.add.reduceat(product, np.append(0, np.cumsum(size)[:-1]))


def block_cuts(keys: np.ndarray, most: int) -> np.ndarray:
    """Where the blocks of a list begin: sorted keys are parted at their first differing bit, the larger part again,
    until no block has more than ``most`` documents; equal keys are parted by number."""
    begins, open_parts = [], [(0, len(keys))]
    while open_parts:
        begin, end = open_parts.pop()
        if end - begin <= most:
            begins.append(begin)
            continue
        low, high = int(keys[begin]), int(keys[end - 1])
        if low == high:
            begins.extend(range(begin, end, most))
            continue
        middle = high >> ((low ^ high).bit_length() - 1) << ((low ^ high).bit_length() - 1)
        cut = begin + int(np.searchsorted(keys[begin:end], middle))
        open_parts += [(begin, cut), (cut, end)]
    return np.sort(np.array(begins))


def placed(found: DataFrame, facts: Broadcast) -> DataFrame:
    """Vectors with ``side``: on which side of each random hyperplane they lie, one bit a plane."""
    schema = pa.schema([("side", pa.int64()), *VECTOR])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, planes = facts.value
        for batch in gathered(batches, CHUNK // 8):
            terms, values, start = flat(batch)
            scaled = (weights[terms] * values * 1e-6)[:, None] * planes[terms]
            sides = np.add.reduceat(scaled, start[:-1], axis=0) > 0
            made = sides @ (1 << np.arange(PLANES, dtype=np.int64))[::-1]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.int64()), *batch.columns], schema=schema)

    return found.mapInArrow(place, f"side long, {VECTOR_FIELDS}")


def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[Cell]:
    """Consecutive vectors as cells."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            held.append(batch.slice(start, 256))
            if sum(map(len, held)) >= CELL:
                yield from cells_of(pa.concat_batches(held))
                held = []
    if held:
        yield from cells_of(pa.concat_batches(held))


def cells_of(batch: pa.RecordBatch) -> Iterator[Cell]:
    terms, values, starts = flat(batch)
    ids = batch["doc_id"].fill_null(0).to_numpy()
    unnamed = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
    return Cell.built(ids, unnamed, batch["side"].to_numpy(), terms, values, starts)


def best_of_cells(found: DataFrame, queries: Broadcast, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of each task's cells for each item.

    A task builds the cells of its range of documents one by one and searches them; what its items have found so
    far raises the bar for its later cells.
    """
    schema = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (score, id, without id) of the best documents so far, and what a document must score
        best: dict[int | None, list[tuple]] = {}
        bars = {item: least for item, _, _, least in queries.value}
        for cell in cells(batches):
            for item, terms, weights, _ in queries.value:
                places, scores = cell.search(terms, weights, bars[item], top)
                if not len(places):
                    continue
                held = best.get(item, [])
                held += zip((-scores).tolist(), cell.unnamed[places].tolist(), cell.ids[places].tolist())
                best[item] = held = sorted(held)[:top]
                if len(held) == top:
                    bars[item] = max(bars[item], -held[-1][0])
        rows = [(item, None if unnamed else doc, -score) for item, held in best.items() for score, unnamed, doc in held]
        for start in range(0, len(rows), 10_000):
            part = list(zip(*rows[start : start + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()) for values in part], schema=schema)

    return (
        found.repartitionByRange("side", "doc_id").sortWithinPartitions("side", "doc_id")
        .mapInArrow(find, "item_id long, doc_id long, score long")
    )


def search(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: for each item the ``top`` documents of the highest scores above 0.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case.
    With N documents that have a term, L terms in all, and df documents of a term, its weight is
    floor(1000 * ln((2 * N + 2) / (2 * df + 1))); a document of n terms has m = 25 + (75 * n * N) div L
    and scores weight * ((1000000000 * tf) div (1000 * tf + 8 * m)) for each term of the item,
    repeats included. Equal scores rank by doc_id.

    Items are searched against all documents in groups of about ITEM_BYTES of text; each group has
    an index of its terms, which the tasks build for their ranges of documents and search at once. Null and empty texts have no
    terms: such documents count nowhere and such items find nothing. Every row of ``documents`` is a document of its own, also
    if it repeats; a null doc_id ranks behind others of the same score. Of items with the same item_id the smallest
    text counts; a null item_id is an item as well. Other columns are ignored. Empty tables give an empty result.
    """
    asked = stored(bodies(items, "item_id").groupBy("key").agg(F.min("body").alias("body")), "items")
    total = asked.agg(F.sum(F.length("body"))).first()[0] or 0
    groups = -(-total // ITEM_BYTES) or 1
    results = []
    for group in range(groups):
        own = asked if groups == 1 else asked.where(F.pmod(F.xxhash64("key"), F.lit(groups)) == group)
        # at most about ITEM_BYTES
        rows = [(row.key, bytes(row.body)) for row in own.collect()]
        results.append(searched(documents, rows, top))
    found = results[0]
    for other in results[1:]:
        found = found.union(other)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score"
    )


def searched(documents: DataFrame, items: list[tuple[int | None, bytes]], top: int) -> DataFrame:
    """(item_id, doc_id, score) of at least the best ``top`` documents of each item."""
    spark = documents.sparkSession
    send = spark.sparkContext.broadcast
    words = Words([text for _, text in items], TABLE)
    dictionary = words.dictionary.to_pylist()
    counts = stored(term_counts(documents, send({word: i for i, word in enumerate(dictionary)})), "terms")
    size, length = counts.where("length > 0").agg(F.count("*"), F.sum("length")).first()
    if not dictionary or not size:
        return spark.createDataFrame([], "item_id long, doc_id long, score long")
    found = stored(vectors(counts, size, length), "vectors")
    df, least = term_facts(found, len(dictionary), top)
    weights = np.array([math.floor(1000 * math.log((2 * size + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    # random planes by the terms' own hashes, so that an order does not depend on their numbers
    hashes = word_hashes(b" ".join(dictionary))
    bits = mix(hashes) >> np.arange(PLANES, dtype=np.uint64)[:, None] & np.uint64(1)
    sided = stored(placed(found, send((weights, 2 * bits.T.astype(np.int8) - 1))), "sides")
    asked = []
    for number, (item, _) in enumerate(items):
        terms, times = np.unique(words.ids[words.text == number], return_counts=True)
        if len(terms):
            product = times * weights[terms]
            # ``top`` documents reach a term's share of the top-th largest impact
            asked.append((item, terms, product, max(1, int((product * least[terms]).max()))))
    return best_of_cells(sided, send(asked), top)
