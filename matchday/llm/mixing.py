"""Sources mixed to target numbers of words by entropy balancing.

A document of size x (words over the source's mean) gets the rate exp(l * x), at most CAP. Of all
rates that give a source its target, these are closest to one in relative entropy. The multiplier
l of each source solves the dual by Newton steps; rates are then rounded into whole copies.

Everything is integer arithmetic on sums that do not depend on the order of rows, so a rerun gives
the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchday.llm.shared import free_name, stored

WORD = r"[^\x20\x09-\x0D]+"
# Weights of the sources in order, repeating; share of all words; most copies.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
# Steps and accuracy of the multipliers; a step that leaves its bracket is replaced by its middle.
STEPS = 40
ACCURACY = 1e-7
SCALE = 10**6
# Documents of one source and size that are ranked together when copies are dealt.
DEALT_TOGETHER = 250
# Single documents that may change to bring a source closer to its target.
REPAIRS = 3


def sized(documents: DataFrame, pattern: str = WORD) -> DataFrame:
    """(doc_id, source, size): words of each text; null has none."""
    size = F.coalesce(F.regexp_count("text", F.lit(pattern)), F.lit(0)).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, target): a row per source.

    Sources by code point, null last, take ``weights`` in turn and share ``share`` of all words
    by weight. No target is above ``cap`` times its source; what is cut off goes to the others by
    weight. With the sources in order of cap / weight, those before some place are at their cap and the
    rest get one level times their weight; running sums give the level at every place. A table
    of sources is small, so its windows need no partitions.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    each = each.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size") * float(cap))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    each = each.withColumn("level", left / weights_left)
    # the first place whose source stays below its cap sets the level for all from there
    fits = F.when(F.col("weight") * F.col("level") <= F.col("most"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return each.select("source", "source_size", F.coalesce(F.least(F.col("weight") * level, "most"), "most").alias("target"))


def rate(multiplier: Column, size: Column, mean: Column, cap: float = CAP) -> Column:
    exponent = F.least(multiplier * size / mean, F.lit(50.0))
    return F.least(F.exp(exponent), F.lit(float(cap)))


def multipliers(histogram: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, multiplier, mean) that bring each source to its target; null multiplier: all at the cap.

    ``histogram`` is (source, size, n). A step sums words and slopes per source on the cluster;
    only the table of sources carries over.
    """
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = goals.join(mean.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "target", "mean",
        # at the cap, or without a word, there is nothing to solve
        ((F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * float(cap))).alias("open"),
        F.lit(0.0).alias("multiplier"), F.lit(-64.0).alias("low"), F.lit(64.0).alias("high"), F.lit(None).cast("double").alias("error"),
    )
    state = stored(state, "multipliers")
    for _ in range(STEPS):
        drawn = rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap)
        words = F.col("size") * F.col("n") * drawn
        slope = F.when(drawn < cap, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            histogram.withColumnRenamed("source", "of")
            .join(state.where("open").select("source", "mean", "multiplier"), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("source")
            .agg(*[(F.sum(F.round(c * 1000).cast("decimal(38,0)")) / 1000).cast("double").alias(name) for name, c in (("words", words), ("slope", slope))])
            .withColumnRenamed("source", "of")
        )
        off = F.col("words") - F.col("target")
        low = F.when(off < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - off / F.when(F.col("slope") > 0, F.col("slope"))
        inside = (newton > low) & (newton < high)
        step = F.round(F.when(inside, newton).otherwise((low + high) / 2), 12)
        done = F.abs(off) <= F.greatest(F.col("target") * ACCURACY, F.lit(1e-3))
        state = stored(
            state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left").select(
                "source", "target", "mean", "open",
                F.when(F.col("words").isNull() | done, F.col("multiplier")).otherwise(step).alias("multiplier"),
                F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"),
                F.when(F.col("words").isNull() | done, F.lit(0.0)).otherwise(F.abs(off)).alias("error"),
            ),
            "multipliers",
        )
        if state.where("open and error > 0").isEmpty():
            break
    return state.select("source", F.when(F.col("open"), F.col("multiplier")).alias("multiplier"), "mean")


def drawn_copies(sizes: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, copies): whole copies that follow the rates.

    Within a source, documents in order of size take the whole part of their rate and one more
    each time the running sum of fractions passes a whole number, so both copies and words stay
    near what the rates ask. Running sums come from the histogram; documents of one source and
    size differ by their place only, which a hash gives, in groups of DEALT_TOGETHER.
    """
    histogram = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    solved = multipliers(histogram, goals, cap)
    scaled = F.round(F.coalesce(rate(F.col("multiplier"), F.col("size"), F.col("mean"), cap), F.lit(float(cap))) * SCALE).cast("long")
    rates = (
        histogram.withColumnRenamed("source", "of")
        .join(solved, F.col("of").eqNullSafe(F.col("source")))
        .select("source", "size", "n", scaled.alias("rate"))
        .withColumns({"whole": F.floor(F.col("rate") / SCALE), "part": F.col("rate") % SCALE})
    )
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rates = rates.withColumn("before", F.coalesce(F.sum(F.col("part") * F.col("n")).over(by_size), F.lit(0)))
    rates = rates.select(F.col("source").alias("of"), F.col("size").alias("of_size"), "n", "whole", "part", "before")
    placed = sizes.join(rates, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size"))).select(
        "doc_id", "source", "size", "whole", "part", "before",
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("n") / DEALT_TOGETHER)).alias("group"),
    )
    placed = stored(placed, "placed")
    groups = placed.groupBy("source", "size", "group").agg(F.count("*").alias("n"))
    by_group = Window.partitionBy("source", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        F.col("source").alias("of"), F.col("size").alias("of_size"), F.col("group").alias("of_group"),
        F.coalesce(F.sum("n").over(by_group), F.lit(0)).alias("ahead"),
    )
    inside = Window.partitionBy("source", "size", "group").orderBy(F.xxhash64("doc_id", "size"), "doc_id")
    ranked = placed.withColumn("rank", F.row_number().over(inside)).join(
        groups,
        F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size")) & (F.col("group") == F.col("of_group")),
    )
    # half a unit in front makes the first document of a source no worse off than the others
    at = F.col("before") + SCALE // 2 + F.col("part") * (F.col("ahead") + F.col("rank"))
    more = F.floor(at / SCALE) - F.floor((at - F.col("part")) / SCALE)
    return ranked.select("doc_id", "source", "size", (F.col("whole") + more).cast("long").alias("copies"))


def repaired(drawn: DataFrame, goals: DataFrame, cap: int = CAP) -> DataFrame:
    """Change one document of each source by one copy, where that brings the source closest."""
    taken = drawn.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    off = goals.join(taken.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.round(F.col("target") - F.col("taken"), 3).alias("off")
    )
    free = drawn.join(off, F.col("source").eqNullSafe(F.col("of"))).where(
        F.when(F.col("off") > 0, F.col("copies") < cap).otherwise(F.col("copies") > 0)
        & (F.col("size") > 0)
        & (F.col("size") < 2 * F.abs("off"))
    )
    chosen = free.groupBy("of").agg(
        F.min(
            F.struct(
                F.abs(F.col("size") - F.abs("off")).alias("far"), F.xxhash64("doc_id").alias("order"), "doc_id", "size",
                "copies", F.signum("off").cast("long").alias("way"),
            )
        ).alias("change")
    ).select(
        "of", F.col("change.doc_id").alias("at"), F.col("change.size").alias("at_size"),
        F.col("change.copies").alias("at_copies"), F.col("change.way").alias("way"),
    )
    hit = (
        F.col("source").eqNullSafe(F.col("of")) & F.col("doc_id").eqNullSafe(F.col("at"))
        & (F.col("size") == F.col("at_size")) & (F.col("copies") == F.col("at_copies"))
    )
    # a source has one change at most; rows that repeat the document all change
    return drawn.join(chosen, hit, "left").select(
        "doc_id", "source", "size", (F.col("copies") + F.coalesce("way", F.lit(0))).alias("copies")
    )


def mixed(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, pattern: str = WORD
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (copies * size).

    See ``targets`` for the targets and ``drawn_copies`` for the copies; no document is taken more than ``cap``
    times. Null and empty texts have size 0 and are taken like the smallest documents, which
    adds nothing. Null is a source of its own, the last. Repeated rows are documents of their own. Other
    columns are ignored. An empty table gives an empty result.
    """
    sizes = stored(sized(documents, pattern), "sizes")
    goals = stored(targets(sizes, weights, share, cap), "targets")
    drawn = stored(drawn_copies(sizes, goals, cap), "drawn")
    for _ in range(REPAIRS):
        drawn = stored(repaired(drawn, goals, cap), "drawn")
    goals = goals.withColumnRenamed("source", "of")
    return drawn.join(goals, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def take_copies(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """Every document as often as ``mix`` (from ``mixed``) takes it, with all its columns.

    Documents meet their copies by id and source; rows that repeat an id in one source are told apart by size only,
    and those that share that too are taken as often as the first of them says.
    """
    to, of, words, copies, copy = (free_name(documents, name) for name in ("_to", "_of", "_words", "_copies", "_copy"))
    times = mix.groupBy(F.col("doc_id").alias(to), F.col("source").alias(of), F.col("size").alias(words)).agg(
        F.min("copies").cast("int").alias(copies)
    )
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    same = (
        F.col("doc_id").cast("long").eqNullSafe(F.col(to)) & F.col("source").cast("string").eqNullSafe(F.col(of)) & (size == F.col(words))
    )
    repeated = documents.join(times, same).withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copies))))
    return repeated.select(*documents.columns)
