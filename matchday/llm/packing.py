"""Sequences of a fixed number of tokens, filled by bin completion.

The largest piece left opens a sequence. Fillings of the rest are enumerated largest piece first, starting with
what best fit gives, which is the first incumbent. A filling of fewer and larger pieces dominates one of more pieces with the
same sum, since it leaves the small pieces, which fit anywhere, for later; by the order of the search it comes first. Branches
that cannot waste less than the incumbent are pruned. If a search gets long, the least possible waste is computed
over all sums that the pieces can make, and a filling with that waste ends it: no filling is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.pieces import gathered
from matchday.llm.shared import stored
from matchday.llm.tokens import CHUNK, encoder_of
from matchday.llm.words import batches_of, rows

CAPACITY = 4096
# Pieces packed together; each group ends with at most one sequence that lacks pieces to fill it.
PIECES_PER_GROUP = 20_000
# Steps of a search after which the least possible waste is computed.
STEPS = 2_000


def pieces_of(documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every text's ids and ``end_id``, cut at ``capacity``.

    A null text is empty and gives one piece with the end id alone.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)

        def made() -> Iterator[tuple]:
            for batch in gathered(batches, CHUNK):
                all_ids, begin = encoder.encode_all(batch["text"].to_pylist())
                for doc_id, first, last in zip(batch["doc_id"].to_pylist(), begin.tolist(), begin[1:].tolist()):
                    ids = np.append(all_ids[first:last], np.uint32(end_id)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        yield doc_id, piece, start, len(part), zlib.crc32(part.tobytes())

        yield from batches_of(made(), schema)

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Stock:
    """Counts of the lengths that are left."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.capacity = capacity
        self.count = np.bincount(lengths, minlength=capacity + 1)
        self.refresh()

    def refresh(self) -> None:
        at = np.arange(self.capacity + 1)
        # largest length left that is not above each number; 0 if there is none
        self.below = np.maximum.accumulate(np.where(self.count > 0, at, 0))
        # sum of all lengths left that are not above each number
        self.smaller = np.cumsum(self.count * at)

    def take(self, length: int) -> None:
        self.count[length] -= 1
        self.smaller[length:] -= length
        if not self.count[length]:
            stop = length
            while stop <= self.capacity and self.below[stop] == length:
                stop += 1
            self.below[length:stop] = self.below[length - 1]

    def fill(self, room: int) -> list[int]:
        """Lengths for ``room`` with the least possible waste, of those the largest first."""
        used: dict[int, int] = {}
        held: list[int] = []
        best: list[int] = []
        least, rest, limit = room, room, room
        for _ in range(STEPS):
            length = int(self.below[min(rest, limit)])
            while length and self.count[length] <= used.get(length, 0):
                length = int(self.below[length - 1])
            if length:
                held.append(length)
                used[length] = used.get(length, 0) + 1
                rest, limit = rest - length, length
                if rest < least:
                    least, best = rest, held.copy()
                if not rest:
                    return best
                continue
            # nothing more fits: take back the last piece that smaller ones may replace with less waste
            while held:
                length = held.pop()
                used[length] -= 1
                rest, limit = rest + length, length - 1
                if limit and self.below[limit] and rest - self.smaller[limit] < least:
                    break
            else:
                return best
        return self.exact(room, best)

    def exact(self, room: int, best: list[int]) -> list[int]:
        """The same by the sums that the lengths can make, a bit each; ``best`` if none is larger than its own."""
        sums, items = 1, []
        whole = (1 << room + 1) - 1
        for length in np.flatnonzero(self.count[: room + 1])[::-1].tolist():
            left, times = min(int(self.count[length]), room // length), 1
            while left and not sums >> room:
                times = min(times, left)
                items.append((length, times, sums))
                sums |= sums << length * times & whole
                left -= times
                times *= 2
        total = sums.bit_length() - 1
        if total <= sum(best):
            return best
        found = []
        for length, times, before in reversed(items):
            if not before >> total & 1:
                found += [length] * times
                total -= length * times
        return sorted(found, reverse=True)


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Sequences as lists of lengths; every length is used as often as given."""
    stock = Stock(np.asarray(lengths, np.int64), capacity)
    sequences = []
    while largest := int(stock.below[capacity]):
        stock.take(largest)
        filled = [largest, *stock.fill(capacity - largest)]
        for length in filled[1:]:
            stock.take(length)
        sequences.append(filled)
    return sequences


def packed(pieces: DataFrame, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """Add sequence_id and offset (place in the sequence, without gaps from 0).

    Pieces are dealt to groups of about ``per_group`` by a hash, so every group is a fair mix of lengths
    and no task depends on a document, source or length. Each group is packed by itself; all
    pieces are placed.
    """
    kept = stored(pieces, "pieces")
    groups = max(1, -(-kept.count() // per_group))
    dealt = kept.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
         ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed() -> Iterator[tuple]:
            group, held = None, []
            for row in rows(batches):
                if row["group"] != group:
                    yield from fill_group(group, held)
                    group, held = row["group"], []
                held.append(row)
            yield from fill_group(group, held)

        yield from batches_of(placed(), schema)

    def fill_group(group: int | None, held: list[dict]) -> Iterator[tuple]:
        by_length: dict[int, list[dict]] = {}
        for row in held:
            by_length.setdefault(row["length"], []).append(row)
        for number, lengths in enumerate(pack([row["length"] for row in held], capacity) if held else []):
            offset = 0
            for length in lengths:
                row = by_length[length].pop()
                yield (
                    row["doc_id"], row["piece"], row["start"], length, row["ids_crc32"],
                    group * 2**32 + number, offset,
                )
                offset += length

    return (
        dealt.repartition(groups, "group")
        .sortWithinPartitions("group", "length", "doc_id", "piece", "ids_crc32")
        .mapInArrow(
            place,
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )


def pack_documents(
    documents: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY, per_group: int = PIECES_PER_GROUP
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every text's ids and ``end_id`` are one piece, or pieces of ``capacity`` if there are more.
    A null text is empty; a null doc_id stays null; rows that repeat are packed each time. Other columns
    are ignored. An empty table gives an empty result.
    """
    return packed(pieces_of(documents, tokenizer, end_id, capacity), capacity, per_group)
