"""URL filter: a list of host rules first, then association rules mined from labelled URLs.

A URL is a set of tokens: levels of its host, words of its path with digits folded, names of its
parameters. FP-growth finds combinations of tokens that come with the label ``block`` often enough.
Each mined rule is indexed by its rarest token, so a URL meets only rules of tokens that it has.
Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.shared import stored

# The list, as (host, path, verdict).
LIST = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BLOCK = "label=block"
# A mined rule must hold for this share of the labelled URLs with its tokens, cover this share of all
# labelled URLs, and this many of them.
CONFIDENCE = 0.7
SUPPORT = 0.002
LEAST_URLS = 20
# Longer tokens stand as their hash.
LONGEST_TOKEN = 100


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def parsed(urls: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, host, path, tokens); tokens are distinct and sorted."""
    url = F.col("url").cast("string")
    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    levels = F.split("host", r"\.")
    hosts = F.transform(levels, lambda _, i: F.concat(F.lit("h="), F.array_join(F.slice(levels, i + 1, F.size(levels)), ".")))
    steps = F.transform(
        F.split("path", r"[/.]"), lambda step: F.concat(F.lit("p="), F.regexp_replace(F.lower(step), "[0-9]+", "#"))
    )
    names = F.transform(F.split("query", "&"), lambda pair: F.concat(F.lit("q="), F.split(pair, "=")[0]))
    full = F.filter(F.concat(hosts, steps, names), lambda token: F.length(token) >= 3)
    short = F.transform(
        full,
        lambda token: F.when(F.length(token) <= LONGEST_TOKEN, token).otherwise(
            F.concat(F.substring(token, 1, 2), F.sha2(token, 256))
        ),
    )
    tokens = F.array_sort(F.array_distinct(short))
    return urls.select(
        F.col(key).cast("long").alias(key), host_of(url).alias("host"), path_of(url).alias("path"), query.alias("query")
    ).select(key, "host", "path", tokens.alias("tokens"))


def listed(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = LIST) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host, or a subdomain of it, and starts the path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shorter rules first: each longer one that fits replaces what was found
    for at, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def mined(tokens: DataFrame, labels: DataFrame, key: str = "page_id") -> DataFrame:
    """(rarest, antecedent, confidence): the smallest token combinations that mean ``block``.

    ``labels`` is (key, block boolean). All labelled URLs are mined with all of their tokens. Three things keep the
    combinations few and lose no rule that is smallest: tokens that stand in the same labelled URLs count as
    one, the first of them; tokens that mean ``block`` by themselves, and those in too few blocked URLs, take no part in others;
    a rule that contains a smaller one goes.
    """
    spark = tokens.sparkSession
    nothing = spark.createDataFrame([], "rarest string, antecedent array<string>, confidence double")
    known = stored(
        tokens.select(key, "tokens")
        .join(labels.where("block is not null").select(F.col(key).alias("_key"), "block").dropDuplicates(["_key"]), F.col(key) == F.col("_key"))
        .where(F.size("tokens") > 0)
        .select(F.monotonically_increasing_id().alias("row"), "tokens", "block"),
        "labelled",
    )
    count = known.count()
    if not count or LEAST_URLS > count:
        return nothing
    support = max(SUPPORT, LEAST_URLS / count)
    single = known.select("row", "block", F.explode("tokens").alias("token"))
    # tokens of the same URLs have the same checksums
    seen = single.groupBy("token").agg(
        F.count("*").alias("n"), F.count_if("block").alias("blocked"),
        *[F.bit_xor(F.xxhash64("row", F.lit(seed))).alias(f"mark{seed}") for seed in range(2)],
    ).where(F.col("blocked") >= F.ceil(F.lit(support * count)))
    seen = stored(
        seen.groupBy("n", "blocked", "mark0", "mark1").agg(F.min("token").alias("token")).select(
            "token", "n", (F.col("blocked") / F.col("n")).alias("confidence")
        ),
        "tokens",
    )
    alone = seen.where(F.col("confidence") >= CONFIDENCE).select(F.array("token").alias("antecedent"), "confidence")
    others = seen.where(F.col("confidence") < CONFIDENCE).select("token")
    listed_tokens = single.join(others, "token").groupBy("row").agg(F.collect_list("token").alias("tokens"))
    block = F.when(F.col("block"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>"))
    items = stored(
        known.select("row", "block").join(listed_tokens, "row", "left").select(
            F.concat(F.coalesce("tokens", F.array().cast("array<string>")), block).alias("items")
        ),
        "items",
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=CONFIDENCE).fit(items)
    together = model.associationRules.where(F.col("consequent")[0] == BLOCK).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence"
    )
    # the index is by the rarest token
    spread = alone.union(together).withColumn("token", F.explode("antecedent")).join(seen.select("token", "n"), "token")
    rules = stored(
        spread.groupBy("antecedent").agg(
            F.min(F.struct("n", "token"))["token"].alias("rarest"), F.first("confidence").alias("confidence")
        ).select("rarest", "antecedent", "confidence"),
        "rules",
    )
    smaller = rules.select(F.col("rarest").alias("token"), F.col("antecedent").alias("part"))
    larger = (
        rules.select("antecedent", F.explode("antecedent").alias("token")).join(smaller, "token")
        .where((F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0))
        .select("antecedent")
    )
    return rules.join(larger, "antecedent", "left_anti").select("rarest", "antecedent", "confidence")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = LIST) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and confidence of the best mined rule.

    ``rule`` is the listed rule that fits, like ``net/``, and gives the verdict; otherwise mined rules do: block
    if one fits, else allow. ``labels`` is (page_id, block boolean) for some pages.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed.
    Rows that repeat are judged each by itself; a null page_id stays null. Other columns are
    ignored. An empty table gives an empty result; without labels nothing is mined.
    """
    urls = stored(parsed(pages), "urls")
    index = stored(mined(urls, labels), "rules")
    # URLs with the same tokens are judged once
    sets = urls.where(F.size("tokens") > 0).select("tokens").distinct()
    best = (
        sets.select("tokens", F.explode("tokens").alias("token"))
        .join(index.withColumnRenamed("rarest", "token"), "token")
        .where(F.size(F.array_except("antecedent", "tokens")) == 0)
        .groupBy("tokens")
        .agg(F.max("confidence").alias("confidence"))
    )
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    return urls.join(best, "tokens", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "confidence",
    )


def page_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, block) from the table of labels, by id: low quality or toxic is to be blocked."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return labels.select(
        F.col("doc_id").cast("long").alias("page_id"),
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"),
    )
