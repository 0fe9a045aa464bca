"""Baskets as vertical bitmaps: one row per item and 32,768 baskets.

Baskets are numbered without gaps within a file, so that a bitmap's bits are dense. A set of items is counted by AND of
its items' bitmaps, bucket by bucket; no basket is put together, and a basket may hold any number of items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.session import stage

# Rows of set and item that are broadcast at a time, 100 bytes or so each.
BLOCK_ROWS = 200_000


def vertical(occurrences: DataFrame) -> DataFrame:
    """Bitmaps of baskets from distinct rows ``chunk, basket, item``: ``chunk, item, bucket, bitmap``.

    Rows of an item and bucket, 32,768 at most, meet before a bitmap is made, so none is shuffled half empty.
    """
    numbers = stage(
        occurrences.select("chunk", "basket").distinct().withColumn("number", F.monotonically_increasing_id() + 1)
    )
    key = ["chunk", "item", "bucket"]
    return (
        occurrences.join(numbers, ["chunk", "basket"])
        .select("chunk", "item", F.bitmap_bucket_number("number").alias("bucket"), "number")
        .repartition(*key)
        .groupBy(*key)
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap"))
    )


def supports(sets: DataFrame, bitmaps: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Baskets that hold all items of a set: ``id, freq``, zero counts left out.

    ``sets`` are rows ``chunk, id, itemset``, staged; ``bitmaps`` those of ``vertical``. Bitmaps are dealt by bucket once for a block of
    sets and met there by the sets, which are broadcast in blocks of a bounded size; a set is counted in place, bucket by
    bucket, and only counts are shuffled.
    """
    n = -(-(sets.agg(F.sum(F.size("itemset"))).first()[0] or 0) // block_rows) or 1
    if n > 1:
        bitmaps = stage(bitmaps)
    dealt = bitmaps.repartition("chunk", "bucket")
    found = []
    for block in range(n):
        own = sets.where(F.pmod(F.xxhash64("id"), F.lit(n)) == block)
        wanted = own.select("chunk", "id", F.size("itemset").alias("size"), F.explode("itemset").alias("item"))
        all_of = (
            dealt.join(F.broadcast(wanted), ["chunk", "item"])
            .groupBy("chunk", "bucket", "id", "size")
            .agg(F.count(F.lit(1)).alias("held"), F.bitmap_and_agg("bitmap").alias("both"))
        )
        found.append(all_of.where(F.col("held") == F.col("size")).select("id", F.bitmap_count("both").alias("n")))
    counts = reduce(DataFrame.unionByName, found).groupBy("id").agg(F.sum("n").alias("freq"))
    return counts.where(F.col("freq") > 0)
