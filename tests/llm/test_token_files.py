"""Encoding, record files and packing."""

from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm.conftest import corpus
from matchday.llm import packing, records, shared
from matchday.llm.tokens import TextEncoder

BYTE, WORD = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "a  b", "a \n b\t\tc", "x\x1cy \x1c z", "!\x1c!", "\u0130stanbul \u03a3\u0391\u03a3", "\u00e9 \u0301x",
    "a<|endoftext|> b<|startoftext|>", "it's I'LL 'S don't", "\uff11\uff12 12345 \u00bd", "\u6f22\u5b57 \u304b\u306a",
    "a\u2003 b\u3000\u3000c", "a\x85\x85b", "\u00a0\u00a0x", "\u017f \u212a", "\t\tx  ", "<|endoftext|>",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_same_ids_as_the_library(path):
    rng = random.Random(1)
    letters = list("ab'sSt1\u00b2 \n\t \x1c\x85\u00a0\u00e9\u00c9\u00df-.,!\u2003\u0301\u03a3\u01c5<|>")
    texts = ODD + ["".join(rng.choices(letters, k=rng.randrange(25))) for _ in range(5_000)]
    encoder, library = TextEncoder(path), Tokenizer.from_file(path)
    for text in texts + texts[:100]:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    # many at once, which do not run into each other
    ids, begin = encoder.encode_all([text.encode() for text in texts])
    for text, first, last in zip(texts, begin.tolist(), begin[1:].tolist()):
        assert ids[first:last].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert [len(part) for part in encoder.encode_all([])] == [0, 1]
    assert [len(part) for part in encoder.encode_all([b"", b""])] == [0, 3]


def order(row):
    return (row[0] is not None, row[0] or 0, row[1] or "")


def test_records_round_trip(spark, documents):
    rows = sorted(corpus(), key=order)
    folder = shared.new_folder(spark, "records")
    manifest = records.write_records(documents(rows), folder, BYTE)
    found = sorted((tuple(r) for r in records.read_records(manifest, folder).collect()), key=lambda r: r[1])
    library, start, expected = Tokenizer.from_file(BYTE), 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    assert found == expected
    for seed in (1, 2):
        mixed = [tuple(r) for r in records.read_records(manifest, folder, seed).collect()]
        assert mixed != expected and sorted(mixed, key=lambda r: r[1]) == expected
    # any record by its offset
    file = manifest.orderBy("shard").collect()[-1]
    last = records.read_at(folder, file.records, [file.n_documents - 1, 0])
    assert last[0][0] == rows[-1][0] and last[0][1][-1] == 0


def test_empty_records(spark, documents):
    folder = shared.new_folder(spark, "records")
    manifest = records.write_records(documents([]), folder, BYTE)
    assert manifest.collect() == [] and records.read_records(manifest, folder).collect() == []


def test_damage_is_seen():
    data = records.frame(records.payload_of(5, b"\x01\x00\x02\x00", 2))
    doc_id, ids = records.content(records.read_frame(pa.BufferReader(data)))
    assert (doc_id, ids.tolist()) == (5, [1, 2])
    for place in range(len(data)):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(pa.BufferReader(bytes(broken)))
    with pytest.raises(ValueError):
        records.read_frame(pa.BufferReader(data[:-3]))


def fewest(lengths, capacity):
    """Smallest number of bins, by trying all."""
    best = len(lengths)

    def place(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        for i, room in enumerate(bins):
            if room >= rest[0] and room not in bins[:i]:
                place(rest[1:], [*bins[:i], room - rest[0], *bins[i + 1 :]])
        place(rest[1:], [*bins, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


def test_packing_near_the_best():
    rng = random.Random(3)
    extra = 0
    for _ in range(150):
        lengths = [rng.randint(1, 20) for _ in range(rng.randrange(0, 11))]
        sequences = packing.pack(np.array(lengths, int), 20)
        assert sorted(x for s in sequences for x in s) == sorted(lengths)
        assert all(sum(s) <= 20 for s in sequences)
        extra += len(sequences) - fewest(lengths, 20)
    assert extra <= 2


@pytest.mark.parametrize("steps", [1, 7, 2_000])
def test_fillings_waste_least(monkeypatch, steps):
    """Of all subsets of the pieces none fills a room better, also where the search is cut short by the sums."""
    monkeypatch.setattr(packing, "STEPS", steps)
    rng = np.random.default_rng(steps)
    for _ in range(150):
        lengths = rng.integers(1, 30, rng.integers(1, 11))
        room = int(rng.integers(1, 80))
        stock = packing.Stock(lengths, 80)
        found = stock.fill(room)
        assert sum(found) <= room and not set(found) - set(lengths.tolist())
        assert all(found.count(x) <= lengths.tolist().count(x) for x in found)
        sums = {0}
        for x in lengths.tolist():
            sums |= {x + y for y in sums if x + y <= room}
        assert sum(found) == max(sums)


def test_full_sequences_are_found_again():
    rng = np.random.default_rng(2)
    lengths = []
    for _ in range(300):
        cuts = np.sort(rng.choice(np.arange(1, 4096), rng.integers(1, 6), replace=False))
        lengths += np.diff(np.concatenate([[0], cuts, [4096]])).tolist()
    assert len(packing.pack(np.array(lengths))) == 300


def test_packing_fills_sequences():
    rng = np.random.default_rng(1)
    lengths = np.minimum(4096, rng.lognormal(6.5, 1.0, 8_000).astype(int) + 1)
    assert len(packing.pack(lengths)) <= -(-int(lengths.sum()) // 4096) + 3
    assert packing.pack(np.array([4096] * 3 + [2049] * 2)) == [[4096]] * 3 + [[2049]] * 2


@pytest.mark.parametrize("per_group", [20, 20_000])
def test_packed_documents(spark, documents, per_group):
    rows = corpus()
    found = packing.pack_documents(documents(rows), WORD, capacity=256, per_group=per_group).collect()
    library = Tokenizer.from_file(WORD)
    expected = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 256)):
            part = ids[start : start + 256]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))))
    assert sorted(map(str, (tuple(r)[:5] for r in found))) == sorted(map(str, expected))
    sequences = {}
    for row in found:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256


def test_empty_packing(spark, documents):
    assert packing.pack_documents(documents([]), WORD).collect() == []
