from __future__ import annotations

import hashlib
import random

import numpy as np

from llm.conftest import corpus, prose
from matchday.llm.fingerprints import (
    BASES, BEFORE, PRIMES, Powers, Prefixes, code_points, common_extension, cuts_of, fingerprint, fingerprints, likeness,
    radius_of, spans_equal,
)
from matchday.llm.words import mix


def cuts_by_text(text, radius):
    """Cuts by definition, from the code points alone."""
    values = []
    for end in range(1, len(text)):
        piece = text[max(0, end - BEFORE) : end]
        plain = sum((ord(c) + 1) * pow(BASES[0], i, PRIMES[0]) for i, c in enumerate(piece)) % PRIMES[0]
        values.append(int(mix(np.array([plain], np.uint64))[0]) >> 1 | 1)
    return [
        i + 1 for i, value in enumerate(values)
        if all(value > x for x in values[max(0, i - radius) : i]) and all(value >= x for x in values[i + 1 : i + 1 + radius])
    ]


def held_by_text(parts, others):
    total, i, expected = 0, 0, 0
    while i < len(parts):
        places = [j for j, part in enumerate(others) if part == parts[i]]
        if not places:
            i += 1
            continue
        j = next((place for place in places if place >= expected), places[0])
        while i < len(parts) and j < len(others) and parts[i] == others[j]:
            total += len(parts[i])
            i, j = i + 1, j + 1
        expected = j
    return total


def likeness_by_text(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    radius = max(radius_of(len(a)), radius_of(len(b)))
    cut = []
    for text in (a, b):
        # a text knows cuts for up to three doublings of its own radius
        known = radius <= radius_of(len(text)) * 8
        edges = [0, *(cuts_by_text(text, radius) if known else []), len(text)]
        cut.append([text[i:j] for i, j in zip(edges, edges[1:])])
    return min(held_by_text(*cut) / len(a), held_by_text(*cut[::-1]) / len(b))


def test_cuts():
    rng, powers = random.Random(5), Powers()
    for size in (0, 1, 2, 17, 130, 700):
        text = "".join(rng.choices("abc \u00e9\U0001f600", k=size))
        places, levels = cuts_of(Prefixes(code_points(text), powers), 2)
        for level in range(4):
            assert places[levels >= level].tolist() == cuts_by_text(text, 2 << level)
    # text that repeats has no cuts of its own
    assert len(cuts_of(Prefixes(code_points("ab" * 500), powers), 8)[0]) < 20


def test_near_copies_stay_near():
    rng, powers = random.Random(8), Powers()
    mark = lambda text: fingerprint(Prefixes(code_points(text), powers))
    words = prose(rng, 2_000, 5_000).split()
    whole = mark(" ".join(words))
    for place in (0, 100, 1_000, 1_999):
        more = words[:place] + ["inserted"] + words[place:]
        fewer = words[:place] + words[place + 1 :]
        assert likeness(whole, mark(" ".join(more))) > 0.9 < likeness(whole, mark(" ".join(fewer)))
    moved = words[700:] + words[:700]
    assert likeness(whole, mark(" ".join(moved))) > 0.85
    replaced = [word if rng.random() > 0.02 else "x" + word for word in words]
    assert 0.3 < likeness(whole, mark(" ".join(replaced))) < 0.9
    assert likeness(whole, mark(prose(rng, 2_000, 5_000))) == 0
    assert abs(likeness(whole, mark(" ".join(words[:1_000]))) - 0.5) < 0.1


def test_spans_and_extensions():
    rng, powers = random.Random(1), Powers()
    for turn in range(1_000):
        a = "".join(rng.choices("ab \u00e9\U0001f600", k=rng.randrange(90)))
        b = a if rng.random() < 0.2 else a[: rng.randrange(90)] + "".join(rng.choices("ab", k=rng.randrange(40)))
        one, other = Prefixes(code_points(a), powers), Prefixes(code_points(b), powers)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        length = rng.randint(0, min(len(a) - i, len(b) - j))
        assert spans_equal(one, i, other, j, length) == (a[i : i + length] == b[j : j + length])
        common = 0
        while i + common < len(a) and j + common < len(b) and a[i + common] == b[j + common]:
            common += 1
        assert common_extension(one, i, other, j) == common
        if turn % 5 == 0:
            assert likeness(fingerprint(one), fingerprint(other)) == likeness_by_text(a, b)
    for size, other_size in ((900, 900), (640, 650), (300, 2_900), (127, 128), (300, 40)):
        a = prose(rng, size // 4, 60)[:size]
        b = a[: size // 3] + "xy" + a[size // 3 :][: other_size]
        assert likeness(*(fingerprint(Prefixes(code_points(text), powers)) for text in (a, b))) == likeness_by_text(a, b)


def test_against_plain_python(spark, documents):
    rows = corpus()
    result = fingerprints(documents(rows)).collect()
    # descending ids, rows without id last, equal ids by text
    line = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = []
    for (doc_id, text), (_, following) in zip(line, line[1:] + line[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness_by_text(text, edited), likeness_by_text(text, following))
        )
    found = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in result]
    assert sorted(map(str, found)) == sorted(map(str, expected))
    texts = {}
    for (doc_id, text) in rows:
        texts.setdefault(text or "", set()).add(doc_id)
    marks = {(r.doc_id, r.n_chars): r.fingerprint for r in result}
    for text, ids in texts.items():
        assert len({marks[i, len(text)] for i in ids}) == 1


def test_one_row_and_none(spark, documents):
    assert fingerprints(documents([])).collect() == []
    alone = fingerprints(documents([(4, "abcd")])).collect()
    assert [(r.near_next, r.edited_sha256) for r in alone] == [(1.0, hashlib.sha256(b"abab").hexdigest())]
