"""Words of a text and their 64-bit hashes, for operators that work on Arrow batches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Words of more bytes are hashed one by one.
LONG = 64
# Masks that keep the first 0 to 8 bytes of eight.
FIRST = np.array([(1 << 8 * size) - 1 for size in range(9)], np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values (splitmix64 finalizer)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: bytes | None) -> np.ndarray:
    """One uint64 per word: runs without space, tab, line feed, VT, FF, CR; A-Z in lower case.

    All words of a text are hashed at once, eight bytes a round.
    """
    return placed_words(text)[0]


def placed_words(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, start): ``word_hashes`` and the byte at which each word begins."""
    # bytes.lower knows ASCII only, which is what is wanted; the end holds a space and room for eight bytes
    padded = (text or b"").lower() + b" " * 9
    content = np.frombuffer(padded, np.uint8)
    inside = (content != 32) & (content - np.uint8(9) > 4)
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = (edge[1::2], edge[::2]) if len(edge) % 2 else (edge[::2], edge[1::2])
    if len(edge) % 2:
        start = np.append(0, start)
    size = end - start
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    hashes = mix(size.astype(np.uint64))
    long = np.flatnonzero(size > LONG)
    open_words = np.flatnonzero(size <= LONG) if len(long) else slice(None)
    at, left = start[open_words], size[open_words]
    while len(at):
        hashes[open_words] = mix(hashes[open_words] ^ (eight[at] & FIRST[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        open_words = more if isinstance(open_words, slice) else open_words[more]
        at, left = at[more] + 8, left[more] - 8
    for i in long.tolist():
        digest = hashlib.blake2b(padded[start[i] : end[i]], digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes, start


def shingles_of_each(texts: Iterable[bytes | None], size: int, at_once: int = 1 << 18) -> Iterator[np.ndarray]:
    """For each text the ``shingle_hashes`` of its runs of ``size`` words, none if it has fewer words; texts of ``at_once``
    bytes are hashed together."""
    held: list[bytes] = []
    room = at_once
    for text in texts:
        held.append(text or b"")
        room -= len(held[-1])
        if room <= 0:
            yield from together(held, size)
            held, room = [], at_once
    yield from together(held, size)


def together(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    # a space between texts ends the last word, and no word goes on behind it
    hashes, start = placed_words(b" ".join(texts))
    made = shingle_hashes(hashes, size) if len(hashes) >= size else hashes[:0]
    ends = np.searchsorted(start, np.cumsum([len(text) + 1 for text in texts])).tolist()
    begin = 0
    for end in ends:
        # runs that go on into the next text are not of this one
        yield made[begin : max(begin, end - size + 1)]
        begin = end


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One uint64 per run of ``size`` words; fewer words give one shingle of all, none give none."""
    if len(hashes) == 0:
        return hashes
    size = min(size, len(hashes))
    count = len(hashes) - size + 1
    made = np.full(count, np.uint64(size))
    for place in range(size):
        made = mix(made * np.uint64(0x9E3779B97F4A7C15) + hashes[place : place + count])
    return made


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the batches as dicts, one at a time."""
    for batch in batches:
        yield from batch.to_pylist()


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield as_batch(held, schema)
            held = []
    if held:
        yield as_batch(held, schema)


def as_batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*held) if held else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(column), field.type) for column, field in zip(columns, schema)], schema=schema
    )
