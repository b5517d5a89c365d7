"""Token ids of whole texts with the tokenizers library, each distinct word encoded once.

Both vocabularies cut a text at white space before they merge anything, so the ids of a text are
those of its words in a row. Many texts are cut at once, and only their distinct words are looked up; a worker
remembers the ids of words, also from task to task, while there is room.
"""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

from matchday.llm.pieces import ranges

REMEMBERED = 600_000
# Bytes of text that callers hand over at once.
CHUNK = 4_000_000
# White space beyond ASCII, in UTF-8. A unit is a word with the white space in front of it.
WIDE_SPACE = re.compile(
    b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80"
)
# The patterns by which the two vocabularies cut words.
BYTE_LEVEL = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
WORD_LEVEL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def visible_bytes() -> dict[int, str]:
    """Byte to character as byte-level vocabularies write it: printable ones stand for themselves,
    the others follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    table = {b: chr(b) for b in plain}
    others = [b for b in range(256) if b not in table]
    return table | {b: chr(256 + i) for i, b in enumerate(others)}


class TextEncoder(dict):
    """Texts to ids, as little-endian integers of ``width`` bytes; the dict is unit -> ids."""

    def __init__(self, path: str, width: int | None = None):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size()
        self.width = width or (2 if size <= 2**16 else 4)
        self.by_word = self.tokenizer.normalizer is not None
        self.table = visible_bytes()
        self.code = "H" if self.width == 2 else "I"
        special = self.tokenizer.get_added_tokens_decoder().values()
        assert all(token.content.startswith("<|") for token in special), "other special tokens"

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin, with the end of the last."""
        data = b"".join(texts)
        content = np.frombuffer(data, np.uint8)
        if self.by_word:
            space = (content == 32) | (content == 10)
        else:
            space = (content == 32) | (content - np.uint8(9) <= 4)
            for found in WIDE_SPACE.finditer(data):
                space[found.start() : found.end()] = True
        # a unit begins with a text, and where white space follows on none
        begin = np.cumsum([0, *map(len, texts)])
        first = np.zeros(len(data) + 1, bool)
        first[1:-1] = space[1:] & ~space[:-1]
        first[begin] = True
        start = np.flatnonzero(first[:-1])
        units = pa.Array.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(np.append(start, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        made = [self[unit] for unit in units.dictionary.to_pylist()]
        known = np.array([len(ids) // self.width for ids in made], np.int64)
        code = units.indices.to_numpy()
        size = known[code]
        ids = np.frombuffer(b"".join(made), f"<u{self.width}")[ranges((np.cumsum(known) - known)[code], size)]
        return ids, np.append(0, np.cumsum(size))[np.searchsorted(start, begin)]

    def ids(self, text: str) -> np.ndarray:
        return self.encode_all([text.encode()])[0]

    def __missing__(self, unit: bytes) -> bytes:
        ids = array(self.code, self.unit_ids((unit.lstrip(b" \n") if self.by_word else unit).decode())).tobytes()
        if len(self) < REMEMBERED and len(unit) <= 100:
            self[unit] = ids
        return ids

    def unit_ids(self, unit: str) -> list[int]:
        # letters below U+0250 have one lower-case form and no combining marks; all else, and the
        # strings of special tokens, take the library's whole path
        if not unit:
            return []
        if max(unit) >= "\u0250" or "\u0130" in unit or "<|" in unit:
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if self.by_word:
            unit = unit.lower()
            pieces = [unit] if unit.isalpha() else WORD_LEVEL.findall(unit)
        elif unit.isalpha() or unit[0] == " " and unit[1:].isalpha():
            pieces = [unit]
        else:
            pieces = BYTE_LEVEL.findall(unit)
        ids: list[int] = []
        for piece in pieces:
            shown = piece.encode().decode("latin-1").translate(self.table)
            ids += [token.id for token in self.model.tokenize(shown)]
        return ids


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> TextEncoder:
    """The worker's encoder for a tokenizers file."""
    return TextEncoder(path)
