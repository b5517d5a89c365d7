"""Quality rules: counts of a text, and how far it is from its language.

A document's character classes and common words are compared with those of all text of its language
by the Jensen-Shannon distance. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.shared import stored
from matchday.operators.totals import BROADCAST_BYTES, size_of

GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# A text fails with fewer words, or a larger share of words in repeated windows.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
WINDOW = 3
# Words a reference holds.
COMMON_WORDS = 16
# A text is rejected beyond these distances. Few words scatter: the bound for common words is for texts of many
# words, and shorter ones get an allowance of SLACK / sqrt(words).
MAX_CHARACTERS = 0.27
MAX_WORDS_APART = 0.36
SLACK = 0.8


def words_of(text: Column, pattern: str = GAP) -> Column:
    return F.array_remove(F.split(text, pattern), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that occur twice or more, the first one included.

    Equal windows stand together once their hashes are sorted. Texts whose windows all differ,
    which is cheap to see, skip the sort.
    """
    spots = F.sequence(F.lit(0), F.size(words) - window)
    marks = F.transform(spots, lambda i: F.xxhash64(*[words[i + k] for k in range(window)]))

    def count(marks: Column) -> Column:
        ranked = F.sort_array(F.transform(marks, lambda mark, i: F.struct(mark.alias("m"), i.alias("i"))))

        def covered(ranked: Column) -> Column:
            twice = F.filter(
                ranked,
                lambda spot, k: (spot["m"] == F.get(ranked, k - 1)["m"]) | (spot["m"] == F.get(ranked, k + 1)["m"]),
            )
            return F.size(
                F.array_distinct(
                    F.flatten(F.transform(twice, lambda spot: F.array(*[spot["i"] + k for k in range(window)])))
                )
            )

        return let(ranked, covered)

    some = let(marks, lambda m: F.when(F.size(F.array_distinct(m)) == F.size(m), 0).otherwise(count(m)))
    return F.when(F.size(words) <= window, 0).otherwise(some)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def character_classes(text: Column) -> Column:
    """Struct of counts: lower-case ASCII, white space, upper-case ASCII, digits, other ASCII that shows,
    beyond ASCII, and symbols (which are among those that show). Controls count nowhere.

    What is frequent goes first, so that the other counts look at short remainders.
    """

    def count(text: Column, pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("long")

    def rest(spaced: Column, dense: Column) -> Column:
        return F.struct(
            (F.length(text) - F.length(spaced)).cast("long").alias("c_lower"),
            (F.length(spaced) - F.length(dense)).cast("long").alias("c_space"),
            count(dense, "[A-Z]").alias("c_upper"),
            count(dense, "[0-9]").alias("c_digit"),
            count(dense, r"[!-/:-@\[-`{-~]").alias("c_mark"),
            count(dense, r"[^\x00-\x7F]").alias("c_beyond"),
            count(dense, SYMBOLS).alias("n_symbols"),
        )

    return let(
        F.regexp_replace(text, "[a-z]+", ""),
        lambda spaced: let(F.regexp_replace(spaced, GAP, ""), lambda dense: rest(spaced, dense)),
    )


def distance(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of counts; 0 if one is all zero."""

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0.0), lambda sum, count: sum + count)

    def part(p: Column, q: Column) -> Column:
        half = F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)
        return half + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(0.0)

    def apart(totals: Column) -> Column:
        parts = F.zip_with(left, right, lambda a, b: part(a / totals[0], b / totals[1]))
        return F.when((totals[0] > 0) & (totals[1] > 0), F.sqrt(F.greatest(total(parts) / 2, F.lit(0.0)))).otherwise(0.0)

    return let(F.array(total(left), total(right)), apart)


def references(documents: DataFrame) -> DataFrame:
    """(language, common): the most frequent words of each language, COMMON_WORDS of them.

    All words of all texts are counted, in each task before the shuffle; only the best of a task travel to
    where a language is ranked.
    """
    # one character in place of all white space lets split work without a pattern
    spaced = F.translate(F.col("text").cast("string"), "\t\n\x0b\x0c\r", " " * 5)
    spoken = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language"), F.explode(F.split(spaced, " ")).alias("word")
    ).where("word <> ''")
    counted = spoken.groupBy("language", "word").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "word"))
    best = counted.withColumn("place", place).where(F.col("place") <= COMMON_WORDS)
    return best.groupBy("language").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "word"))), lambda spot: spot["word"]).alias("common")
    )


def per_language(summary: DataFrame) -> DataFrame:
    """A row per language: sent to all tasks if it is small, else joined as Spark sees fit."""
    return F.broadcast(summary) if size_of(summary) <= BROADCAST_BYTES else summary


def features(documents: DataFrame, common: DataFrame) -> DataFrame:
    """(doc_id, language, counts, c_ counts, heard): a narrow row per document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spoken = documents.select(
        F.col("doc_id"), text.alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("language")
    )
    spoken = spoken.join(per_language(common), "language", "left")
    counted = spoken.select(
        "doc_id", "language", "text", "common", words_of(F.col("text")).alias("words"),
        character_classes(F.col("text")).alias("classes"),
    )
    heard = F.transform(
        F.coalesce("common", F.array().cast("array<string>")),
        lambda word: (F.size("words") - F.size(F.array_remove("words", word))).cast("long"),
    )
    return counted.select(
        "doc_id", "language",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.col("classes.c_space")).cast("long").alias("word_chars"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        "classes.*", heard.alias("heard"),
    )


CLASSES = ["c_lower", "c_upper", "c_digit", "c_mark", "c_space", "c_beyond"]


def judged(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, characters_apart, words_apart.

    A document is kept unless its base counts fail or a distance to its language is too large; texts of
    fewer than MIN_WORDS words are not compared. References are counted over all documents.

    Null and empty texts have no words, so they fail. A null language is a language of its own. Rows that
    repeat are judged each by itself; a null doc_id stays null. Other columns are ignored. An empty
    table gives an empty result.
    """
    common = stored(references(documents), "references")
    found = stored(features(documents, common), "features")
    heard = [F.coalesce(F.get("heard", F.lit(k)), F.lit(0)) for k in range(COMMON_WORDS)]
    # the words that are not common are a place of their own
    found = found.withColumns(
        {
            "classes": F.array(*CLASSES).cast("array<double>"),
            "spoken": F.array(*heard, F.col("n_words") - F.aggregate("heard", F.lit(0).cast("long"), lambda sum, n: sum + n)).cast("array<double>"),
        }
    )
    sums = [
        F.array(*[F.sum(F.get(name, F.lit(k))) for k in range(size)]).alias(f"all_{name}")
        for name, size in (("classes", len(CLASSES)), ("spoken", COMMON_WORDS + 1))
    ]
    totals = stored(found.groupBy("language").agg(*sums), "totals")
    compared = found.join(per_language(totals), "language")
    characters = distance(F.col("classes"), F.col("all_classes"))
    words = distance(F.col("spoken"), F.col("all_spoken"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    near = (F.col("characters_apart") <= MAX_CHARACTERS) & (
        F.col("words_apart") <= MAX_WORDS_APART + SLACK / F.sqrt(F.greatest("n_words", F.lit(1)))
    )
    return compared.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        characters.alias("characters_apart"), words.alias("words_apart"),
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "characters_apart", "words_apart",
    )
