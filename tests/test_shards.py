from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from orebed.operators import itemsets, shards


def as_dict(df):
    got = df.collect()
    found = {tuple(r.itemset): r.freq for r in got}
    assert len(found) == len(got) and all(r.size == len(r.itemset) for r in got)
    return found


def brute(bags, support):
    found, items = {}, sorted(set().union(*bags))
    for k in range(1, len(items) + 1):
        counts = {c: sum(set(c) <= v for v in bags) for c in combinations(items, k)}
        more = {c: n for c, n in counts.items() if n >= support}
        found |= more
        if not more:
            break
    return found


@pytest.mark.parametrize("group_items, shard_rows", [(64, 10_000), (1, 10_000), (2, 30), (3, 7)])
def test_shards_match_brute_force(spark, group_items, shard_rows):
    draw = random.Random(group_items)
    rows = [(f"b{draw.randint(0, 40)}", f"i{min(int(draw.expovariate(0.4)), 9)}") for _ in range(260)]
    b = spark.createDataFrame(rows + rows[:20] + [(None, "i0"), ("b0", None)], "basket_id string, item string").repartition(4)
    bags = {}
    for k, x in rows:
        bags.setdefault(k, set()).add(x)
    for support in (2, 12):
        found = as_dict(shards.sharded_itemsets(b, support, group_items=group_items, shard_rows=shard_rows))
        assert found == brute(list(bags.values()), support)


def test_no_baskets(spark):
    b = spark.createDataFrame([], "basket_id long, item string")
    assert shards.sharded_itemsets(b, 1).count() == 0


def test_a_prefix_is_sent_once_for_a_group(spark):
    """Rows of a basket of n items: for each group with an item of it, the items up to the last such one."""
    coded = spark.range(100).selectExpr("1L AS basket", "id AS rank").union(spark.sql("SELECT 2L, 35L"))
    sent = shards.prefixes(coded, group_items=10, shard_rows=55)
    got = {(r.group, r.basket): r.n for r in sent.groupBy("group", "basket").agg(F.count("rank").alias("n")).collect()}
    assert got == {(g, 1): 10 * (g + 1) for g in range(10)} | {(3, 2): 1}
    assert {r.group: (r.shards, r.baskets) for r in sent.collect()}[3] == (1, 2)
    assert {r.group: r.shards for r in sent.collect()}[9] == 2


def test_a_basket_of_many_items(spark):
    """A basket of 20,000 frequent items is rows of prefixes, and no array; its pairs are in two other baskets each."""
    many = spark.range(20_000).selectExpr("-1L AS basket_id", "concat('i', id) AS item")
    two = spark.range(20_000).selectExpr("id AS basket_id", "explode(array(concat('i', id DIV 2 * 2), concat('i', id DIV 2 * 2 + 1))) AS item")
    b = many.unionByName(two)
    found = shards.sharded_itemsets(b, 3)
    assert found.groupBy("size", "freq").count().orderBy("size").collect() == [(1, 3, 20_000), (2, 3, 10_000)]
    n = lambda i: F.substring(F.col("itemset")[i], 2, 9).cast("int")
    assert found.where("size = 2").where(F.floor(n(0) / 2) != F.floor(n(1) / 2)).isEmpty()


def test_agrees_with_levels_on_transactions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    b = docs.select(F.col("l_orderkey").alias("basket_id"), (F.col("l_partkey") % 30).alias("item"))
    wanted = as_dict(itemsets.frequent_itemsets(b, 12))
    assert as_dict(shards.sharded_itemsets(b, 12, group_items=4, shard_rows=2_000)) == wanted and len(wanted) > 100
