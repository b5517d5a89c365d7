"""Toxicity by a weighted finite-state grammar over clauses.

Words are read into classes: insult, threat, target, negation, reported speech. Four small transducers read a
clause side by side, composed into one: how far a negation governs, whether speech is reported, how far a target in front
reaches, and the pattern, which pays for an insult or threat in full only if a target stands in front or
follows, and little for a lone insult. The weight of an arc is that of the word times what all four say of it; a
clause's score is the heaviest accepted path, a document's the sum over its clauses. Insults are learned from
labelled documents, with a small list to start from.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.shared import free_name, stored
from matchday.llm.words import batches_of, rows, shingle_hashes, word_hashes

# Words of the classes that are not learned.
INSULTS = "idiot moron loser scum stupid worthless pathetic disgusting trash imbecile dumb idiota imbécil imbécile dummkopf".split()
THREATS = "kill hurt destroy beat burn crush punish attack töten umbringen matar tuer detruire vernichten schlagen".split()
TARGETS = "you your yours u he she him her they them their people du dich dir ihr euch sie tu te toi vous usted ustedes ellos".split()
NEGATIONS = "not no never isn't aren't don't wasn't nicht kein keine nie ne pas jamais nunca ni".split()
REPORTS = "said says say wrote quoted claimed called reported sagte sagt schrieb dit écrit dijo escribió".split()
BUILT_IN_WEIGHT = 3.0

# At most so many labelled documents are learned from, chosen by a hash of the id.
SAMPLE = 200_000
# A form is an insult if it is exp(LEAST_LIFT) times likelier in toxic documents; the log-likelihood ratio
# must also outweigh that many forms were looked at. Strength counts up to MAX_STRENGTH.
LEAST_LIFT = 4.0
MAX_STRENGTH = 40.0
LEAST_TOXIC = 3
PREFIXES = (4, 5, 6)
HELD_FORMS = 300_000
REMEMBERED = 300_000
# Reach of a target or negation, in words, and what they do to a weight; a threat's own weight.
REACH = 4
TARGETED, LONE, NEGATED, REPORTED, THREAT = 1.25, 0.5, 0.3, 0.5, 3.0
DECIDE = 0.3
EDGE = re.compile(r"^[^\w]+|[^\w]+$", re.UNICODE)
CLAUSE_END = re.compile(r"[.!?;:,]")

PLAIN, INSULT, THREATEN, TARGET, NEGATE, REPORT = range(6)


def bare(word: str) -> str:
    """A word in lower case without what is around its letters."""
    return EDGE.sub("", word).lower()


def forms(word: str) -> list[str]:
    """A word and its beginnings (marked by ``*``), so that learned stems hold for their endings."""
    return [word, *[f"{word[:size]}*" for size in PREFIXES if len(word) > size]]


def learnable(doc_id: str = "doc_id") -> Column:
    """Rows whose labels may be learned from: the remainder of a checksum holds out a quarter."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learning_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``sample`` labelled documents that are not held out."""
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable())
        .select(F.col("doc_id").cast("long").alias("_id"), (F.col("toxic") == 1).alias("toxic"))
        .dropDuplicates(["_id"])
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    # at most ``sample`` pairs of a number and a flag
    return documents.select("doc_id", "text").join(
        F.broadcast(known), F.col("doc_id").cast("long") == F.col("_id")
    ).select(F.col("text").cast("string").alias("text"), "toxic")


def families(examples: DataFrame) -> DataFrame:
    """One document of those that share their smallest shingle, as nearly all near copies do.

    Copies of one toxic document would make each of its words look like an insult.
    """
    schema = pa.schema([("family", pa.int64()), ("text", pa.string()), ("toxic", pa.bool_())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def marked() -> Iterator[tuple]:
            for row in rows(batches):
                shingles = shingle_hashes(word_hashes((row["text"] or "").encode()), 5)
                smallest = int(shingles.min()) if len(shingles) else 0
                yield smallest - 2**63, row["text"], row["toxic"]

        yield from batches_of(marked(), schema, 500)

    marked = examples.mapInArrow(mark, "family long, text string, toxic boolean")
    alone = marked.groupBy("family", "toxic").agg(F.min("text").alias("text"))
    return stored(alone.select("text", "toxic"), "families")


def learned(examples: DataFrame) -> dict[str, float]:
    """Form -> weight, from (text, toxic) rows."""
    schema = pa.schema([("form", pa.string()), ("n_toxic", pa.int64()), ("n_clean", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}

        def counted() -> Iterator[tuple]:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for row in rows(batches):
                found: set[str] = set()
                for word in set((row["text"] or "").split()):
                    made = known.get(word)
                    if made is None:
                        made = forms(core) if (core := bare(word)) else []
                        if len(known) < REMEMBERED:
                            known[word] = made
                    found.update(made)
                seen[0 if row["toxic"] else 1].update(found)
                if len(seen[0]) + len(seen[1]) > HELD_FORMS:
                    yield from flush(seen)
                    seen = (Counter(), Counter())
            yield from flush(seen)

        yield from batches_of(counted(), schema, 20_000)

    def flush(seen: tuple[Counter, Counter]) -> Iterator[tuple]:
        for form in seen[0].keys() | seen[1].keys():
            yield form, seen[0][form], seen[1][form]

    examples = families(examples)
    size = examples.agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = size["toxic"] or 0, size["n"] - (size["toxic"] or 0)
    if not toxic or not clean:
        return {}
    # a form without a toxic document is no candidate: only the others move
    counts = stored(
        examples.mapInArrow(count, "form string, n_toxic long, n_clean long")
        .groupBy("form").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
        .where(F.col("n_toxic") >= LEAST_TOXIC),
        "forms",
    )
    tried = max(1, counts.count())
    a, b, n = F.col("n_toxic"), F.col("n_clean"), F.col("n_toxic") + F.col("n_clean")
    lift = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    expected_a, expected_b = n * (toxic / (toxic + clean)), n * (clean / (toxic + clean))
    ratio = 2 * (a * F.log(a / expected_a) + F.when(b > 0, b * F.log(b / expected_b)).otherwise(0.0))
    best = (
        counts.select("form", lift.alias("lift"), ratio.alias("ratio"))
        .where((F.col("lift") >= LEAST_LIFT) & (F.col("ratio") >= 10 + 2 * math.log(tried)))
    )
    # forms that pass both tests on a sample of bounded size are few
    return {row["form"]: round(row["lift"], 6) for row in best.collect()}


class Reader(dict):
    """Word as it stands in a text -> (class, weight, whether a clause ends there)."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = {word: BUILT_IN_WEIGHT for word in INSULTS} | weights
        self.classes = {
            **dict.fromkeys(REPORTS, REPORT), **dict.fromkeys(NEGATIONS, NEGATE),
            **dict.fromkeys(TARGETS, TARGET), **dict.fromkeys(THREATS, THREATEN),
        }

    def __missing__(self, word: str) -> tuple[int, float, bool]:
        core = bare(word)
        weight = max((self.weights.get(form, 0.0) for form in forms(core)), default=0.0) if core else 0.0
        kind = INSULT if weight else self.classes.get(core, PLAIN)
        read = (kind, weight, bool(CLAUSE_END.search(word[-1:])))
        if len(self) < REMEMBERED:
            self[word] = read
        return read


# A transducer: start, accepting states, and state -> class of a word -> [(next state, factor)]. Without an arc a path ends.
Arcs = dict[int, dict[int, list[tuple[int, float]]]]
Transducer = tuple[int, set[int], Arcs]
CLASSES = (PLAIN, INSULT, THREATEN, TARGET, NEGATE, REPORT)
PAID = (INSULT, THREATEN)


def scope(opened_by: int, reach: int | None, inside: float, outside: float = 1.0) -> Transducer:
    """Counts down from ``reach`` after a word of a class (never, if None); paid words get a factor by whether it still reaches."""
    most = reach or 1
    arcs: Arcs = {}
    for state in range(most + 1):
        after = state if reach is None else max(state - 1, 0)
        arcs[state] = {
            kind: [(most if kind == opened_by else after, (inside if state else outside) if kind in PAID else 1.0)]
            for kind in CLASSES
        }
    return 0, set(arcs), arcs


def pattern() -> Transducer:
    """What a paid word needs: state 0 waits for nothing, state k for a target within k words, and in state -k a target
    in front reaches k words on. An insult is paid in full beside a target on either side, a threat only before one.
    Waiting paths that meet no target are not accepted."""
    arcs: Arcs = {state: {} for state in range(-REACH, REACH + 1)}
    for state in arcs:
        # one word on, without a target
        on = state - 1 if state > 1 else min(state + 1, 0) if state <= 0 else None
        for kind in CLASSES:
            found: list[tuple[int, float]] = []
            if kind == TARGET:
                found.append((-REACH, 1.0))
            elif kind in PAID:
                if state > 1:
                    found.append((on, TARGETED))
                elif state <= 0:
                    found.append((REACH, TARGETED))
                    beside = TARGETED if state < 0 else LONE
                    found.append((on, beside if kind == INSULT else 0.0))
            elif on is not None:
                found.append((on, 1.0))
            arcs[state][kind] = found
    return 0, {state for state in arcs if state <= 0}, arcs


def composed(one: Transducer, other: Transducer) -> Transducer:
    """Both read every word; factors multiply. Only states that can be reached are made."""
    numbers = {(one[0], other[0]): 0}
    todo, arcs = [(one[0], other[0])], {}
    while todo:
        pair = todo.pop()
        made: dict[int, list[tuple[int, float]]] = {}
        for kind in CLASSES:
            made[kind] = []
            for left, factor in one[2][pair[0]].get(kind, []):
                for right, more in other[2][pair[1]].get(kind, []):
                    if (left, right) not in numbers:
                        numbers[left, right] = len(numbers)
                        todo.append((left, right))
                    made[kind].append((numbers[left, right], factor * more))
        arcs[numbers[pair]] = made
    accepted = {number for (left, right), number in numbers.items() if left in one[1] and right in other[1]}
    return 0, accepted, arcs


TRANSDUCERS = (pattern(), scope(NEGATE, REACH, NEGATED), scope(REPORT, None, REPORTED))
GRAMMAR = functools.reduce(composed, TRANSDUCERS)


def clause_score(clause: list[tuple[int, float, bool]]) -> float:
    """Weight of the heaviest accepted path of the grammar over one clause, never below 0."""
    start, accepted, arcs = GRAMMAR
    paths = {start: 0.0}
    for kind, weight, _ in clause:
        paid = weight if kind == INSULT else THREAT if kind == THREATEN else 0.0
        reached: dict[int, float] = {}
        for state, score in paths.items():
            for after, factor in arcs[state][kind]:
                made = score + paid * factor
                if made > reached.get(after, -1.0):
                    reached[after] = made
        paths = reached
    return max((score for state, score in paths.items() if state in accepted), default=0.0)


def text_score(text: str | None, reader: Reader) -> float:
    """Sum over the clauses that hold an insult or a threat; 0 for texts without any."""
    read = list(map(reader.__getitem__, (text or "").split()))
    hits = [i for i, word in enumerate(read) if word[0] == INSULT or word[0] == THREATEN]
    score, done = 0.0, 0
    for hit in hits:
        if hit < done:
            continue
        start, end = hit, hit
        while start > done and not read[start - 1][2]:
            start -= 1
        while end < len(read) - 1 and not read[end][2]:
            end += 1
        score += clause_score(read[start : end + 1])
        done = end + 1
    return score


def summed(texts: DataFrame, weights: dict[str, float], keep_text: bool = False) -> DataFrame:
    """Add ``strength`` (sum over clauses) to rows with a ``text``, and drop the text unless told.

    If there is such a column already, the new one has ``_`` behind its name and is the last.
    """
    names = [name for name in texts.columns if keep_text or name != "text"]
    schema = texts.select(*names).schema
    strength_name = free_name(texts, "strength")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(weights)
        for batch in batches:
            strength = [text_score(text, reader) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch[name] for name in names], pa.array(strength, pa.float64())], names=[*names, strength_name]
            )

    return texts.mapInArrow(score, schema.add(strength_name, "double"))


def calibrated(examples: DataFrame, weights: dict[str, float]) -> tuple[float, float]:
    """(bias, slope) of the logistic curve from strength to toxic, by Newton steps with a little ridge.

    Only counts by rounded strength come to the driver, at most 401 rows.
    """
    strength = F.least(F.round(F.col("strength"), 1), F.lit(MAX_STRENGTH)).alias("strength")
    bins = (
        summed(examples, weights).groupBy(strength).agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("n")).collect()
    )
    if not bins:
        return -3.0, 2.0
    x = np.array([[1.0, row["strength"]] for row in bins])
    toxic, n = (np.array([row[name] for row in bins], float) for name in ("toxic", "n"))
    prior = np.array([-3.0, 1.0])
    ridge = np.diag([0.01, 1.0])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((n * np.logaddexp(0, z) - toxic * z).sum() + (at - prior) @ ridge @ (at - prior) / 2)

    solved = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ solved, -30, 30)))
        slope = x.T @ (toxic - n * p) - ridge @ (solved - prior)
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(curve, slope)
        while np.abs(step).max() > 1e-9 and loss(solved + step) > loss(solved):
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        solved = solved + step
    return round(float(solved[0]), 6), round(max(0.0, float(solved[1])), 6)


def fitted(documents: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float, float]:
    """(weights, bias, slope) from at most SAMPLE labelled documents, none of them held out."""
    examples = stored(learning_rows(documents, labels), "examples")
    weights = learned(examples)
    return weights, *calibrated(examples, weights)


def score_of(strength: Column, bias: float, slope: float) -> Column:
    return 1 / (1 + F.exp(-(bias + slope * F.least(strength, F.lit(MAX_STRENGTH)))))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from DECIDE on).

    ``labels`` is (doc_id, toxic). A score depends on the text alone.

    Null and empty texts have the score of a text without a finding. Without labels the built-in list
    decides. Rows that repeat are scored each by itself; a null doc_id stays null and is not held
    out. Other columns are ignored. An empty table gives an empty result.
    """
    weights, bias, slope = fitted(documents, labels)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = summed(texts, weights).select("doc_id", score_of(F.col("strength"), bias, slope).alias("score"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= DECIDE, 1).otherwise(0).alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, with all their columns, that ``toxicity`` does not predict to be toxic."""
    weights, bias, slope = fitted(documents, labels)
    scored = summed(documents, weights, keep_text=True)
    return scored.where(score_of(F.col(scored.columns[-1]), bias, slope) < DECIDE).select(*documents.columns)


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
