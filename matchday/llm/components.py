"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchday.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node it can reach.

    Large-star and small-star steps by turns: each replaces links by links to the smallest
    neighbour, as grouped minima and joins, until every node hangs on its root. The number of
    rounds grows with the logarithm of a component's size. Links that repeat, point both ways or
    to the node itself change nothing; an empty table gives an empty result.
    """
    current = stored(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .where("high <> low")
        .distinct(),
        "links",
    )
    while True:
        large = hang(current.union(current.select(F.col("low"), F.col("high"))), ">")
        small = stored(hang(large, "<=").where("high <> low").distinct(), "links")
        # done when no node has two parents and no parent has a parent
        parents = small.select(F.col("low").alias("high")).join(small, "high", "left_semi").limit(1).count()
        double = small.groupBy("high").count().where("count > 1").limit(1).count()
        if not parents and not double:
            break
        current = small
    roots = small.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("root"))
    return small.select(F.col("high").alias("node"), F.col("low").alias("root")).union(roots)


def hang(pairs: DataFrame, which: str) -> DataFrame:
    """Link neighbours of each ``high`` to the smallest of them and itself: larger neighbours of a
    node (``>``, pairs given both ways), or smaller ones and the node (``<=``)."""
    smallest = pairs.groupBy("high").agg(F.least(F.min("low"), F.col("high")).alias("least"))
    joined = pairs.join(smallest, "high")
    if which == ">":
        return joined.where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()
    return joined.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
        smallest.select("high", F.col("least").alias("low"))
    )
