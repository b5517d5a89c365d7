"""Collocations: phrases of two to four words that occur together more than their parts explain.

Every word starts one window, the word and the words that lead from it (``lead`` columns) up to four, padded
where its piece of text ends. Only these longest windows are counted; ROLLUP then sums them over
successively shorter prefixes, and the sum of a prefix is the number of places where it occurs.

Counted windows travel as packed arrays to the tasks that own their first word, where all windows of a prefix
meet. There a window is padded from the first prefix on that does not reach the support, so ROLLUP sees little
more than what reaches it. Groups of first words with a large share of all windows are parted by their second word
as well, and those by the third; prefixes that are parted so are left to ROLLUP.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.pieces import Words, byte_table, gathered
from matchday.llm.shared import stored
from matchday.llm.words import mix, word_hashes

LONGEST = 4
SUPPORT = 30
TOP = 2_000
# A candidate goes when a longer one around it has at least this share of its occurrences.
PERCENT = 80
# Words are counted in hashed buckets (as a power of two) first: a word whose bucket stays below the support is
# rare and ends a window. They bound the memory of a task and the broadcast, a bit each.
BUCKETS = 23
# Buckets that travel as one row.
ROW = 1 << 16
# Groups of first words, and of first two, by hash; one with more than this share of all windows is parted.
GROUPS, SHARE = 1 << 14, 1 / 1024
# Bytes of text cut into words at once.
CHUNK = 6_000_000
TABLE = byte_table(b"\t", b".,;:!?\n\x0b\x0c\r")
COLUMNS = [f"w{place}" for place in range(1, LONGEST + 1)]
SPREAD = 64
STEP = np.uint64(0x9E3779B97F4A7C15)


def texts(documents: DataFrame) -> DataFrame:
    """(lang, body) of the documents that have a text."""
    return documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.col("text").cast("string").cast("binary").alias("body"),
    ).where("body is not null")


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words, np.ndarray]]:
    """Language, words, and the hash of each word of the dictionary, which differs between languages."""
    for batch in gathered(batches, CHUNK):
        langs = batch["lang"].dictionary_encode()
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(langs.indices.to_numpy() == number)
            words = Words(batch["body"].take(pa.array(own)).to_pylist(), TABLE)
            if len(words.ids):
                salt = word_hashes(b"#" + lang.encode())[0] if lang.strip() else np.uint64(0)
                yield lang, words, mix(word_hashes(b" ".join(words.dictionary.to_pylist())) ^ salt)


def group_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(GROUPS - 1)).astype(np.int64)


def first_pass(documents: DataFrame, support: int, buckets: int) -> Broadcast:
    """(full, large): a bit per bucket of words, whether they reach the support together, and for groups of
    first words and of first two words whether they are to be parted."""
    kind = np.uint8 if support <= 255 else np.int64
    shift = np.uint64(64 - buckets)
    row = min(ROW, 1 << buckets)
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << buckets, np.uint32)
        groups = np.zeros((2, GROUPS), np.int64)
        for _, words, hashes in by_language(batches):
            times = np.bincount(words.ids, minlength=len(hashes))
            np.add.at(counts, (hashes >> shift).astype(np.int64), np.minimum(times, support).astype(np.uint32))
            # beyond the support a count tells nothing more
            np.minimum(counts, support, out=counts)
            own = hashes[words.ids]
            after = np.where(words.joined, np.append(own[1:], own[:1]), np.uint64(0))
            groups[0] += np.bincount(group_of(own), minlength=GROUPS)
            groups[1] += np.bincount(group_of(mix(own * STEP + after)), minlength=GROUPS)
        for block, part in enumerate(counts.reshape(-1, row)):
            if part.any():
                yield packed(0, block, part.astype(kind))
        for number, own in enumerate(groups, 1):
            yield packed(number, 0, own)

    def packed(number: int, block: int, values: np.ndarray) -> pa.RecordBatch:
        made = {"kind": number, "block": block, "counts": values.tobytes()}
        return pa.RecordBatch.from_pylist([made], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, np.zeros(0, np.int64)
        for batch in batches:
            for number, block, counts in zip(*(batch[name].to_pylist() for name in schema.names)):
                if (number, block) != key:
                    yield from ended(key, total)
                    key, total = (number, block), np.zeros(GROUPS if number else row, np.int64)
                total += np.frombuffer(counts, np.int64 if number else kind)
        yield from ended(key, total)

    def ended(key, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        if key:
            yield packed(*key, total if key[0] else np.packbits(total >= support))

    fields = "kind int, block int, counts binary"
    merged = (
        texts(documents).mapInArrow(count, fields)
        .repartition("kind", "block").sortWithinPartitions("kind", "block").mapInArrow(add, fields)
    )
    full, large = np.zeros(max(1, 1 << buckets >> 3), np.uint8), np.zeros((2, GROUPS), bool)
    # a bit per bucket and a number per group
    for number, block, values in merged.collect():
        if number:
            own = np.frombuffer(values, np.int64)
            large[number - 1] = own > own.sum() * SHARE
        else:
            full[block * row >> 3 : (block + 1) * row + 7 >> 3] = np.frombuffer(values, np.uint8)
    return documents.sparkSession.sparkContext.broadcast((full, large))


PACKED = pa.schema([
    ("part", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("cells", pa.binary()), ("counts", pa.binary()),
    ("levels", pa.binary()),
])


def counted(cells: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct columns of ``cells`` (LONGEST rows) in order, and the sum of their counts."""
    if not cells.shape[1]:
        return cells, np.zeros(0, np.int64)
    base = np.int64(cells.max()) + 1
    high, low = cells[0] * base + cells[1], cells[2] * base + cells[3]
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
    if counts is None:
        return cells[:, order[first]], np.diff(np.append(first, len(order)))
    return cells[:, order[first]], np.add.reduceat(counts[order], first)


def windows(documents: DataFrame, facts: Broadcast, buckets: int, parts: int) -> DataFrame:
    """Packed windows by ``part``: distinct words, four numbers of words a window (0 is padding), the number
    of places, and the shortest prefix whose windows all have the same part."""
    shift = np.uint64(64 - buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, large = facts.value
        for lang, words, hashes in by_language(batches):
            at = (hashes >> shift).astype(np.int64)
            frequent = (full[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            own = np.where(frequent[words.ids], words.ids + 1, 0)
            columns, kept = [own], own > 0
            for size in range(1, LONGEST):
                lead = np.append(own[size:], own[:size])[: len(own)]
                kept = kept & (lead > 0) & np.append(words.joined[size - 1 :], np.zeros(size - 1, bool))[: len(own)]
                columns.append(np.where(kept, lead, 0))
            cells, counts = counted(np.stack(columns))
            hashes = np.append(np.uint64(0), hashes)
            one, two, three = (hashes[cells[i]] for i in range(3))
            two = mix(one * STEP + two)
            three = mix(two * STEP + three)
            levels = 1 + large[0][group_of(one)].astype(np.uint8)
            levels += (levels == 2) & large[1][group_of(two)]
            part = np.select([levels == 1, levels == 2], [mix(one), mix(two)], mix(three)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts, dtype=np.uint64), "right").tolist()
            for number, (begin, end) in enumerate(zip([0, *ends], ends)):
                if begin < end:
                    chosen = order[begin:end]
                    yield pack(number, lang, words.dictionary, cells[:, chosen], counts[chosen], levels[chosen])

    def pack(part: int, lang: str, dictionary: pa.Array, cells, counts, levels) -> pa.RecordBatch:
        used = np.zeros(len(dictionary) + 1, bool)
        used[cells] = True
        used[0] = False
        numbers = np.cumsum(used)
        numbers[0] = 0
        names = dictionary.take(pa.array(np.flatnonzero(used) - 1)).to_pylist()
        squeeze = zstandard.ZstdCompressor(level=1).compress
        values = (
            b" ".join(names), numbers[cells].astype("<i4").tobytes(), counts.astype("<i4").tobytes(), levels.tobytes()
        )
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([lang]), *(pa.array([squeeze(x)], pa.binary()) for x in values)],
            schema=PACKED,
        )

    return texts(documents).mapInArrow(cut, "part int, lang string, words binary, cells binary, counts binary, levels binary")


def padded(packed: DataFrame, support: int) -> DataFrame:
    """(lang, w1 to w4, n): distinct windows of each part, padded from the first prefix on that is known to
    stay below the support. Empty words are padding; a window without any word stands for rare words."""
    schema = pa.schema([("lang", pa.string()), *((name, pa.string()) for name in COLUMNS), ("n", pa.int64())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                part, lang, *values = (batch[name][row].as_py() for name in PACKED.names)
                if (part, lang) != key:
                    yield from made(key, held)
                    key, held = (part, lang), []
                held.append(values)
        yield from made(key, held)

    def made(key, held: list) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        open_ = zstandard.ZstdDecompressor().decompress
        names, cells, counts, levels = [], [], [], []
        for words, own, number, level in held:
            own = np.frombuffer(open_(own), "<i4").reshape(LONGEST, -1).astype(np.int64)
            named = open_(words)
            names.append(pa.array(named.split(b" ") if named else [], pa.binary()))
            cells.append(own)
            counts.append(np.frombuffer(open_(number), "<i4").astype(np.int64))
            levels.append(np.frombuffer(open_(level), np.uint8))
        coded = pa.concat_arrays(names).dictionary_encode()
        # 0 stays 0, other numbers become those of the common dictionary
        place, begin = coded.indices.to_numpy(), 0
        for i, own in enumerate(names):
            cells[i] = np.append(0, place[begin : begin + len(own)] + 1)[cells[i]]
            begin += len(own)
        # the level of a window follows from its words, so it travels as one more part of its last column
        base = np.int64(len(coded.dictionary) + 1)
        merged = np.concatenate(cells, axis=1)
        merged[3] += np.concatenate(levels).astype(np.int64) * base
        merged, number = counted(merged, np.concatenate(counts))
        level = merged[3] // base
        merged[3] %= base
        changed, kept = np.zeros(len(number), bool), np.ones(len(number), bool)
        changed[:1] = True
        # windows of one prefix have one level where the prefix is not parted, and stand together
        for size in range(1, LONGEST + 1):
            own = merged[size - 1]
            changed[1:] |= own[1:] != own[:-1]
            start = np.flatnonzero(changed)
            total = np.repeat(np.add.reduceat(number, start), np.diff(np.append(start, len(number))))
            kept = kept & (own > 0) & ((total >= support) | (size < level))
            merged[size - 1] = np.where(kept, own, 0)
        merged, number = counted(merged, number)
        dictionary = pa.concat_arrays([pa.array([b""], pa.binary()), coded.dictionary]).cast(pa.string())
        for begin in range(0, len(number), 20_000):
            part = slice(begin, begin + 20_000)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.repeat(pa.scalar(key[1], pa.string()), len(number[part])),
                    *(dictionary.take(pa.array(column[part])) for column in merged),
                    pa.array(number[part], pa.int64()),
                ],
                schema=schema,
            )

    fields = ", ".join(["lang string", *(f"{name} string" for name in COLUMNS), "n long"])
    return packed.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(join, fields)


def prefixes(found: DataFrame, support: int) -> DataFrame:
    """(lang, size, phrase, n): occurrences of every phrase that reaches the support, and with size 0
    those of all words of a language."""
    distinct = found.groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    summed = distinct.rollup("lang", *COLUMNS).agg(F.sum("n").alias("n"), F.grouping_id().alias("rolled"))
    # 0 with all columns, 1 without the last, 3 without the last two, ...
    size = F.expr(f"{LONGEST} - bit_count(rolled)").cast("int")
    last = F.element_at(F.array(F.lit("-"), *COLUMNS), F.col("size") + 1)
    return (
        summed.where(F.col("rolled") < (1 << LONGEST + 1) - 1)
        .withColumn("size", size)
        .where((F.col("size") == 0) | (F.col("n") >= support) & (last != ""))
        .select("lang", "size", F.array_join(F.slice(F.array(*COLUMNS), 1, F.col("size")), " ").alias("phrase"), "n")
    )


def words_between(phrase: str, first: str, count: str) -> str:
    """SQL for ``count`` words of a phrase from the word ``first`` (from 1)."""
    return f"array_join(slice(split({phrase}, ' '), {first}, {count}), ' ')"


def collocations(
    documents: DataFrame, support: int = SUPPORT, top: int = TOP, percent: int = PERCENT, buckets: int = BUCKETS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces and those at spaces and
    tabs into words. A phrase of 2 to 4 words with a >= ``support`` occurrences is cut after each of its words but the
    last; l and r are the occurrences of both parts, the score is floor(2000000 * a / (l + r)), and the lowest
    score counts, of equal ones that of the shortest first part. A phrase goes if a longer candidate
    around it has 100 * occurrences >= ``percent`` * a. Ranks go by score, a and the phrase's bytes.

    Null and empty texts have no words; a null lang is ``und``. Rows that repeat count as often as they
    stand there, ids and all other columns play no part. An empty table gives an empty result.
    """
    # a few parts a task, for the luck of the hash
    parts = 2 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    facts = first_pass(documents, support, buckets)
    packed = windows(documents, facts, buckets, parts)
    known = stored(prefixes(padded(packed, support), support), "phrases")
    phrases, totals = known.where("size > 0"), known.where("size = 0")
    candidates = phrases.where("size > 1").withColumnRenamed("n", "a")

    cuts = candidates.select("lang", "phrase", "a", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr(words_between("phrase", "1", "k"))).withColumn(
        "rest", F.expr(words_between("phrase", "k + 1", "size - k"))
    )
    firsts = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rests = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = (
        cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
        # 28 digits hold the product of any two such numbers
        .withColumn("score", F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + r)"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("lowest"))
        .select("lang", "phrase", "a", "lowest.l", "lowest.r", "lowest.score")
    )

    # every candidate's shorter candidates: first word and number of words
    inner = F.expr(
        "filter(flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> struct(i, m)))),"
        " x -> x.m < size)"
    )
    around = (
        candidates.where("size > 2").select("phrase", "lang", "a", F.explode(inner).alias("x"))
        .select("lang", F.expr(words_between("phrase", "x.i", "x.m")).alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    kept = scored.join(around, ["lang", "phrase"], "left").where(
        f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {percent}"
    )
    # the best of each share of a language first, so that no task sorts all of it
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
    return ranked.join(totals.select("lang", "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
