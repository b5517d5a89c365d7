"""Fingerprints of documents from prefix polynomial hashes.

The hash of a prefix is the sum of c_i * B^i modulo a prime, over its code points. Two prefix hashes give
the hash of any span, so spans can be compared in constant time and common extensions found by
binary search. A fingerprint cuts the text where the hash of the code points before is the largest of those
around, and keeps the hash of each span: text that is inserted or taken out moves later cuts along, and
spans behind it are found again at their new place.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.shared import stored
from matchday.llm.words import batches_of, mix, rows

# Two primes below 2^31 and a base for each; together 62 bits.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
# A fingerprint of a long text has about SPANS / 2 to SPANS spans.
SPANS = 48
# Code points whose hash decides on a cut, and radii, each twice the one before, that a cut can prevail in.
BEFORE = 16
LEVELS = 4


class Powers:
    """B^i modulo the primes, extended as texts get longer."""

    def __init__(self) -> None:
        self.known = [np.ones(1, np.uint64) for _ in PRIMES]
        self.inverses = np.ones(1, np.uint64)

    def __call__(self, which: int, count: int) -> np.ndarray:
        table = self.known[which]
        prime, base = PRIMES[which], BASES[which]
        while len(table) < count:
            # the next ones are those known times the power that follows them
            step = np.uint64(pow(base, len(table), prime))
            table = np.concatenate([table, table * step % np.uint64(prime)])
        self.known[which] = table
        return table[:count]

    def inverse(self, places: np.ndarray) -> np.ndarray:
        """B^-i modulo the first prime."""
        prime = PRIMES[0]
        back = pow(BASES[0], -1, prime)
        count = int(places.max(initial=0)) + 1
        while len(self.inverses) < count:
            step = np.uint64(pow(back, len(self.inverses), prime))
            self.inverses = np.concatenate([self.inverses, self.inverses * step % np.uint64(prime)])
        return self.inverses[places]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Prefixes:
    """Hashes of all prefixes of a text: (2, n + 1) uint64."""

    def __init__(self, points: np.ndarray, powers: Powers):
        self.size = len(points)
        # one more than the code point, so that a zero counts
        values = points.astype(np.uint64) + np.uint64(1)
        self.powers = powers
        self.sums = np.zeros((2, self.size + 1), np.uint64)
        for which, prime in enumerate(PRIMES):
            terms = values * powers(which, self.size) % np.uint64(prime)
            # each term has 31 bits: 2^33 of them fit
            self.sums[which, 1:] = np.cumsum(terms, dtype=np.uint64) % np.uint64(prime)

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Hash of a span times B^start."""
        return tuple(
            (int(self.sums[which, end]) - int(self.sums[which, start])) % prime
            for which, prime in enumerate(PRIMES)
        )


def spans_equal(one: Prefixes, i: int, other: Prefixes, j: int, length: int) -> bool:
    """Whether two spans of ``length`` code points are equal, in constant time."""
    left, right = one.span(i, i + length), other.span(j, j + length)
    shift = j - i
    for which, prime in enumerate(PRIMES):
        power = pow(BASES[which], abs(shift), prime)
        a, b = (left[which] * power, right[which]) if shift >= 0 else (left[which], right[which] * power)
        if (a - b) % prime:
            return False
    return True


def common_extension(one: Prefixes, i: int, other: Prefixes, j: int) -> int:
    """Length of the longest common span from ``i`` in one text and ``j`` in the other."""
    low, high = 0, min(one.size - i, other.size - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(one, i, other, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def radius_of(size: int) -> int:
    """Largest power of two of which SPANS fit into the text, at least 1."""
    return 1 << max(0, (size // SPANS).bit_length() - 1)


def largest_before(values: np.ndarray, radius: int, levels: int) -> Iterator[np.ndarray]:
    """Largest of the ``radius`` values before each one, 0 if there is none; then of twice as many, ``levels`` times in all."""
    best, width = np.append(np.uint64(0), values)[:-1], 1
    for step in range(levels):
        while width < radius << step:
            wider = best.copy()
            np.maximum(best[width:], best[:-width], out=wider[width:])
            best, width = wider, 2 * width
        yield best


def cuts_of(prefixes: Prefixes, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, levels): cuts inside of a text, and how often ``radius`` can be doubled, up to LEVELS - 1 times, for them to remain.

    A cut lies where the hash of the BEFORE code points in front (of all, near the start) is larger than the
    ``radius`` ones before and no smaller than the ``radius`` ones after. So a cut for a radius is one for all smaller ones.
    """
    prime = np.uint64(PRIMES[0])
    ends = np.arange(1, prefixes.size)
    begin = np.maximum(ends - BEFORE, 0)
    sums = prefixes.sums[0]
    hashes = (sums[ends] + prime - sums[begin]) % prime * prefixes.powers.inverse(begin) % prime
    # never zero, which stands for nothing
    values = (mix(hashes) >> np.uint64(1)) | np.uint64(1)
    level = np.zeros(len(ends), np.int64)
    for before, after in zip(largest_before(values, radius, LEVELS), largest_before(values[::-1], radius, LEVELS)):
        level += (values > before) & (values >= after[::-1])
    inside = np.flatnonzero(level)
    return ends[inside], level[inside] - 1


def fingerprint(prefixes: Prefixes) -> str:
    """``size:`` and in base 64 the hash of the text (8 bytes) and, for each span, its length and level (4 bytes)
    and its hash (4 bytes)."""
    places, levels = cuts_of(prefixes, radius_of(prefixes.size))
    edges = np.concatenate([[0], places, [prefixes.size]])
    prime = np.uint64(PRIMES[0])
    sums = prefixes.sums[0, edges]
    hashes = (sums[1:] + prime - sums[:-1]) % prime * prefixes.powers.inverse(edges[:-1]) % prime
    lengths = np.diff(edges) | (np.append(levels, LEVELS - 1) << 30)
    whole = (prefixes.sums[0, -1] << np.uint64(31)) | prefixes.sums[1, -1]
    packed = whole.astype(">u8").tobytes() + np.stack([lengths, hashes.astype(np.int64)], axis=1).astype(">u4").tobytes()
    return f"{prefixes.size}:" + base64.b64encode(packed).decode()


class Spans:
    """The spans of a fingerprint, with the prefix hash at each cut."""

    def __init__(self, mark: str):
        size, _, kept = mark.partition(":")
        packed = np.frombuffer(base64.b64decode(kept)[8:], ">u4").reshape(-1, 2).astype(np.int64)
        self.size = int(size)
        self.lengths, self.levels, self.hashes = packed[:, 0] & (2**30 - 1), packed[:, 0] >> 30, packed[:, 1]

    def lined_up(self, level: int) -> Spans:
        """Only cuts of ``level`` stay; spans between them become one."""
        prime, base = PRIMES[0], BASES[0]
        at, sum = 0, 0
        self.places, self.sums, self.parts = [0], [0], []
        for length, own, hash in zip(self.lengths.tolist(), self.levels.tolist(), self.hashes.tolist()):
            sum = (sum + pow(base, at, prime) * hash) % prime
            at += length
            if own >= level or at == self.size:
                # shifted to the start, so that equal spans have equal hashes wherever they stand
                shift = pow(base, -self.places[-1], prime)
                self.parts.append((at - self.places[-1], (sum - self.sums[-1]) * shift % prime))
                self.places.append(at)
                self.sums.append(sum)
        return self

    def run(self, start: int, count: int) -> tuple[int, int]:
        """Length and hash, times B^place, of ``count`` spans from number ``start``."""
        return self.places[start + count] - self.places[start], (self.sums[start + count] - self.sums[start]) % PRIMES[0]


def runs_equal(one: Spans, i: int, other: Spans, j: int, count: int) -> bool:
    """Whether ``count`` spans from number i and from number j have equal text, in constant time."""
    (length, hash), (other_length, other_hash) = one.run(i, count), other.run(j, count)
    prime, base = PRIMES[0], BASES[0]
    return length == other_length and (
        hash * pow(base, other.places[j], prime) - other_hash * pow(base, one.places[i], prime)
    ) % prime == 0


def spans_in_common(one: Spans, i: int, other: Spans, j: int) -> int:
    """Number of spans in the longest common extension from number i and number j, by binary search."""
    low, high = 0, min(len(one.parts) - i, len(other.parts) - j)
    while low < high:
        middle = (low + high + 1) // 2
        if runs_equal(one, i, other, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def held(one: Spans, other: Spans) -> int:
    """Code points of ``one`` in spans that ``other`` has as well, each anchored at an equal span and extended."""
    anchors: dict[tuple, list[int]] = {}
    for j, part in enumerate(other.parts):
        anchors.setdefault(part, []).append(j)
    total, i, expected = 0, 0, 0
    while i < len(one.parts):
        places = anchors.get(one.parts[i])
        if not places:
            i += 1
            continue
        # of equal spans the one that comes next in the other text, else the first one
        j = next((place for place in places if place >= expected), places[0])
        count = max(1, spans_in_common(one, i, other, j))
        total += one.places[i + count] - one.places[i]
        i, expected = i + count, j + count
    return total


def likeness(one: str, other: str) -> float:
    """Share of a text in spans that the other one has as well, wherever they stand; the smaller share of the two.

    1.0 for equal texts, also empty ones. Fingerprints of texts of different lengths meet at the cuts of the
    larger radius.
    """
    if one == other:
        return 1.0
    left, right = Spans(one), Spans(other)
    if not left.size or not right.size:
        return 0.0
    radius = max(radius_of(left.size), radius_of(right.size))
    for spans in (left, right):
        spans.lined_up((radius // radius_of(spans.size)).bit_length() - 1)
    return min(held(left, right) / left.size, held(right, left) / right.size)


FOUND = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def mark_of(text: str, powers: Powers) -> str:
    return fingerprint(Prefixes(code_points(text), powers))


def judge(doc_id: int | None, text: str, mark: str, following: str, next_mark: str, powers: Powers) -> tuple:
    """A result row of one document and the text that follows it."""
    size = len(text)
    half = size // 2
    edited = text[: size - half] + following[:half]
    edited_mark = mark_of(edited, powers)
    return (
        doc_id, size, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark, edited_mark,
        likeness(mark, edited_mark), likeness(mark, next_mark),
    )


def fingerprints(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many, or
    all, of the next document's; the next is that of the next smaller doc_id, and after the last one the
    first. near_edited and near_next are the likeness of the fingerprints.

    Texts move once, sorted in ranges of doc_id. A task passes each text on to the one before it; the texts at
    the edges of tasks, two for each, meet in a second step.

    Null texts are empty. Rows without doc_id come last; rows of equal doc_id are ordered by their
    text, and rows that repeat are each other's next. A single row is its own next. Other columns are
    ignored. An empty table gives an empty result.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
         ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]
    )

    def pass_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        part = TaskContext.get().partitionId()
        nothing = (None,) * 5

        def made() -> Iterator[tuple]:
            before = None
            for row in rows(batches):
                row["mark"] = mark_of(row["text"], powers)
                if before is None:
                    yield row["doc_id"], 0, *nothing, part, "first", row["text"]
                else:
                    yield *judge(*before.values(), row["text"], row["mark"], powers), part, None, None
                before = row
            if before is not None:
                yield before["doc_id"], 0, *nothing, part, "last", before["text"]

        yield from batches_of(made(), schema, 500)

    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .repartitionByRange(F.desc_nulls_last("doc_id"))
        .sortWithinPartitions(F.desc_nulls_last("doc_id"), "text")
    )
    passed = stored(ordered.mapInArrow(pass_on, f"{FOUND}, part int, edge string, text string"), "fingerprints")
    edges = passed.where("edge is not null")
    # one row per task of the step above
    order = Window.orderBy("part")
    parts = edges.where("edge = 'first'").select("part")
    following = parts.select(
        "part", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())).alias("next_part")
    )
    meet = (
        edges.where("edge = 'last'").select("part", "doc_id", "text").join(following, "part")
        .join(
            edges.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following")),
            "next_part",
        )
        .select("doc_id", "text", "following")
    )

    def meet_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        short = pa.schema(list(schema)[:7])
        judged = (
            judge(
                row["doc_id"], row["text"], mark_of(row["text"], powers), row["following"],
                mark_of(row["following"], powers), powers,
            )
            for row in rows(batches)
        )
        yield from batches_of(judged, short, 500)

    names = [field.split()[0] for field in FOUND.split(", ")]
    return passed.where("edge is null").select(*names).union(meet.mapInArrow(meet_edges, FOUND))
