"""Many texts cut into words at once: one dictionary of words and one number per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK, BREAK = 32, 10


def byte_table(blanks: bytes, breaks: bytes) -> bytes:
    """Table for bytes.translate: A-Z in lower case, blanks as a space, breaks and line feeds, which also
    stand between texts, as a line feed."""
    table = bytearray(bytes(range(256)).lower())
    for byte in blanks:
        table[byte] = BLANK
    for byte in breaks:
        table[byte] = BREAK
    return bytes(table)


class Words:
    """Words of several texts: ``dictionary`` (distinct words), ``ids`` (place in it of each word, in
    order), ``text`` (number of its text), ``joined`` (whether the next word follows with blanks only between)."""

    def __init__(self, texts: list[bytes], table: bytes) -> None:
        framed = b"\n" + b"\n".join(texts).translate(table) + b"\n"
        content = np.frombuffer(framed, np.uint8)
        broken = content == BREAK
        inside = ~broken & (content != BLANK)
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = edge[::2], edge[1::2]
        offsets = np.append(0, np.cumsum(end - start))
        packed = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(content[inside])]
        ).dictionary_encode()
        self.dictionary = packed.dictionary
        self.ids = packed.indices.to_numpy().astype(np.int64)
        # a text begins one place behind the line feed before it
        begin = 1 + np.append(0, np.cumsum([len(text) + 1 for text in texts])[:-1])
        self.text = np.searchsorted(begin, start, "right") - 1
        piece = np.searchsorted(np.flatnonzero(broken), start)
        self.joined = np.append(piece[1:] == piece[:-1], False) if len(piece) else np.zeros(0, bool)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Numbers start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose buffers hold about ``size`` bytes, or one row."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        step = max(1, min(batch.num_rows, size * batch.num_rows // max(batch.get_total_buffer_size(), 1)))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            held.append(part)
            total += part.nbytes
            if total >= size:
                yield pa.concat_batches(held)
                held, total = [], 0
    if held:
        yield pa.concat_batches(held)
