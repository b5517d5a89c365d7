"""Which versions of a table may hold a key: a Bloom filter and the range of keys beside each version."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.streaming.snapshots import Commit, folder, read

# 24 bits and 4 hashes a key: a version without a key is taken for one with it in 6 of 10,000 cases.
BITS_PER_KEY, HASHES = 24, 4
# Bits of one row of an index, as Spark's bitmaps have them.
ROW = 32_768
# Beyond so many keys some key of a batch would meet every filter by chance, so only ranges are asked.
PROBED = 100_000


def bits_for(keys: int) -> int:
    """Size of a filter as a power of two."""
    return max(15, math.ceil(math.log2(max(keys, 1) * BITS_PER_KEY)))


def positions(key: list[str], bits: int):
    """(bucket, bit) of a key for each hash."""
    places = [F.pmod(F.xxhash64(F.lit(i), *key), F.lit(1 << bits)) for i in range(HASHES)]
    return F.array(*[
        F.struct(F.shiftright(place, 15).alias("bucket"), (place % ROW).alias("bit"))
        for place in places
    ])


def write_index(rows: DataFrame, key: list[str], table: str, made: Commit) -> None:
    """Write the index of a version's ``rows``; its size is ``made.bits``."""
    names = F.struct(*key)
    spots = rows.select(F.explode(positions(key, made.bits)).alias("x")).select("x.bucket", "x.bit")
    filters = spots.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    spans = rows.agg(F.min(names).alias("lowest"), F.max(names).alias("highest")).where("lowest is not null")
    # the one row of spans stands beside all of the filter's
    filters.join(F.broadcast(spans)).write.parquet(folder(table, "index", made))


def holding(spark: SparkSession, table: str, commits: list[Commit], keys: DataFrame, key: list[str]) -> list[Commit]:
    """The commits that may hold one of ``keys`` (distinct); all others hold none."""
    indexed = [made for made in commits if made.bits]
    if not indexed:
        return []
    index, names = read(spark, table, "index", indexed), F.struct(*key)
    count = keys.count()
    ends = keys.agg(F.min(names).alias("first"), F.max(names).alias("last"))
    near = index.join(F.broadcast(ends), F.expr("highest >= first AND lowest <= last"))
    if count > PROBED:
        found = near.select("version").distinct()
    else:
        sizes = spark.createDataFrame([(made.version, made.bits) for made in indexed], "version long, bits int")
        asked = None
        for bits in sorted({made.bits for made in indexed}):
            own = keys.select(F.xxhash64(*key).alias("name"), F.explode(positions(key, bits)).alias("x")).select(
                F.lit(bits).alias("bits"), "name", "x.bucket", "x.bit"
            )
            asked = own if asked is None else asked.union(own)
        # at most HASHES * PROBED entries for a size; equal positions of one key count as often as they occur
        asked = asked.groupBy("bits", "bucket").agg(F.collect_list(F.struct("name", "bit")).alias("asked"))
        tested = near.join(F.broadcast(sizes), "version").join(asked, ["bits", "bucket"]).select(
            "version", F.explode(F.expr(f"filter(asked, x -> {is_set('bitmap', 'x.bit')})")).alias("x")
        )
        found = tested.groupBy("version", "x.name").agg(F.count("*").alias("hits")).where(
            F.col("hits") >= HASHES
        ).select("version").distinct()
    versions = {row["version"] for row in found.collect()}
    return [made for made in indexed if made.version in versions]


def is_set(bitmap: str, bit: str) -> str:
    """SQL: whether a bit of a Spark bitmap is set."""
    octet = f"cast(conv(hex(substring({bitmap}, cast({bit} div 8 as int) + 1, 1)), 16, 10) as int)"
    return f"(shiftright({octet}, cast({bit} % 8 as int)) & 1) = 1"
