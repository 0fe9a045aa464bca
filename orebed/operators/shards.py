"""Frequent itemsets by group-dependent shards.

Items are ranked by their counts, the most frequent first, and cut into groups of neighbouring ranks. A set belongs to the
group of its rarest item, so a group needs of each basket only the items up to the last one of the group there: the prefix of the
basket. Prefixes are rows, never arrays, and one prefix serves all items of a group. A group whose prefixes are too many for one
task is cut by baskets into shards; each asks for its share of the support, and what the shards find is counted on bitmaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.functions.skew import join_within
from orebed.operators.chunks import batched, counted
from orebed.operators.encode import numbered
from orebed.operators.itemsets import CHUNK_ROWS, count_candidates
from orebed.session import stage

# Items of neighbouring ranks that share the prefixes of a group.
GROUP_ITEMS = 64

_SHARD = ["group", "shard"]


def sharded_itemsets(
    b: DataFrame,
    support: int,
    basket: str = "basket_id",
    item: str = "item",
    group_items: int = GROUP_ITEMS,
    shard_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Itemsets in at least ``support`` baskets: ``itemset, size, freq``.

    A basket counts once however often it repeats an item; rows with a null basket or item are in no set. ``shard_rows`` are
    the rows of prefixes in a task, about; the result does not depend on it.
    """
    once = b.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()
    once = stage(once)
    singles = once.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    ranked = numbered(singles.withColumn("rarity", -F.col("n")), "rarity", "item")
    ranked = stage(ranked.select("item", F.col("position").alias("rank")))
    coded = stage(once.join(ranked, "item").select("basket", "rank"))
    found = _mined(prefixes(coded, group_items, shard_rows), support, group_items)
    found = stage(found)
    # A set counted in all its group's baskets at once is done; others are counted anew over all baskets.
    done = found.where(F.col("freq").isNotNull()).select("ranks", "freq")
    parts = found.where(F.col("freq").isNull())
    if not parts.isEmpty():
        candidates = parts.select(F.col("ranks").alias("itemset")).distinct()
        more = count_candidates(candidates, coded, "basket", "rank").where(F.col("freq") >= support)
        done = done.unionByName(more.select(F.col("itemset").alias("ranks"), "freq"))
    rows = stage(done.withColumn("id", F.monotonically_increasing_id()))
    named = rows.select("id", "freq", F.explode("ranks").alias("rank")).join(ranked, "rank")
    sets = named.groupBy("id", "freq").agg(F.array_sort(F.collect_list("item")).alias("itemset"))
    return sets.select("itemset", F.size("itemset").alias("size"), "freq")


def prefixes(coded: DataFrame, group_items: int = GROUP_ITEMS, shard_rows: int = CHUNK_ROWS) -> DataFrame:
    """For each group and basket with an item of the group the items up to the last such one:
    ``group, shard, shards, baskets, basket, rank``, ``baskets`` those of the whole group.

    ``coded`` are distinct rows ``basket, rank``, staged. The length of a prefix is the place of its last item in the basket, so shards are
    cut before a prefix is made; baskets with many items make theirs in several tasks.
    """
    place = F.row_number().over(Window.partitionBy("basket").orderBy("rank"))
    placed = stage(coded.withColumn("place", place))
    group = F.floor(F.col("rank") / group_items).cast("int").alias("group")
    heads = stage(placed.groupBy("basket", group).agg(F.max("place").alias("last")))
    sizes = heads.groupBy("group").agg(F.sum("last").alias("rows"), F.count(F.lit(1)).alias("baskets"))
    shards = F.ceil(F.col("rows") / shard_rows).cast("int").alias("shards")
    heads = heads.join(sizes.select("group", "baskets", shards), "group")
    within = F.col("a.place") <= F.col("b.last")
    return join_within(placed, heads, ["basket"], ["rank"], within).select(
        "b.group",
        F.pmod(F.xxhash64("b.basket", "b.group"), F.col("b.shards")).cast("int").alias("shard"),
        "b.shards",
        "b.baskets",
        "a.basket",
        "a.rank",
    )


def _mined(rows: DataFrame, support: int, group_items: int) -> DataFrame:
    """Sets of a group that are frequent in one of its shards: ``ranks, freq``, ``freq`` null where the group has more shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        group, shards, baskets = (table.column(c)[0].as_py() for c in ("group", "shards", "baskets"))
        basket = pc.dictionary_encode(table.column("basket").combine_chunks()).indices.to_numpy()
        # The rarest item comes first, so that a set's class is that of its rarest item.
        ranks, codes = np.unique(-table.column("rank").to_numpy(), return_inverse=True)
        ranks = -ranks
        own = int((ranks >= group * group_items).sum())
        m = int(basket.max()) + 1
        need = max(1, -(-m * support // baskets))
        for found in batched(counted(basket, codes, m, need, own)):
            offsets = np.r_[0, np.cumsum([len(s) for s, _ in found])].astype(np.int32)
            flat = ranks[np.array([x for s, _ in found for x in s[::-1]], np.int64)]
            freq = pa.array([n if shards == 1 else None for _, n in found], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), freq], ["ranks", "freq"])

    return rows.groupBy(*_SHARD).applyInArrow(run, "ranks array<long>, freq long")
