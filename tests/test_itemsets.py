from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.operators import bitmaps, chunks, itemsets
from orebed.sources.writers import itemset_report, write_itemset_report

BASKETS = {
    1: "aabc",
    2: "abcd",
    3: "abd",
    4: "acd",
    5: "bcd",
    6: "abcde",
    7: "e",
    8: "ee",
    9: "abce",
}


@pytest.fixture(scope="module")
def b(spark):
    rows = [(k, x) for k, v in BASKETS.items() for x in v]
    return spark.createDataFrame(rows, "basket_id long, item string").repartition(5)


def brute(support, bags=None):
    bags = [set(v) for v in (bags or BASKETS).values()]
    found = {}
    for k in range(1, 6):
        for c in combinations(sorted(set().union(*bags)), k):
            n = sum(set(c) <= x for x in bags)
            if n >= support:
                found[c] = n
    return found


def as_dict(df):
    return {tuple(r.itemset): r.freq for r in df.collect()}


@pytest.mark.parametrize("support", [1, 2, 3, 4, 6, 20])
def test_levels_match_brute_force(b, support):
    assert as_dict(itemsets.frequent_itemsets(b, support)) == brute(support)


@pytest.mark.parametrize("support", [2, 4, 5])
def test_heavy_baskets_are_counted_by_lookup(b, support):
    assert as_dict(itemsets.frequent_itemsets(b, support, heavy_basket=2)) == brute(support)


@pytest.mark.parametrize("support, heavy_basket", [(2, 100), (4, 100), (5, 2)])
def test_fpgrowth_agrees(b, support, heavy_basket):
    found = itemsets.frequent_itemsets_fpgrowth(b, support, heavy_basket=heavy_basket)
    assert as_dict(found) == brute(support)


@pytest.mark.parametrize("chunks", [1, 2, 4, 7])
def test_two_phases_do_not_depend_on_chunks(b, chunks):
    candidates, frequent = itemsets.son(b, 4, chunks)
    found = as_dict(frequent)
    assert found == brute(4)
    assert set(found) <= {tuple(r.itemset) for r in candidates.collect()}


def test_large_chunks_are_mined_in_parts(spark, monkeypatch):
    draw = random.Random(11)
    rows = [(draw.choice([None, *range(60)]), draw.choice("aaabbcdefg")) for _ in range(900)]
    rows += [(k, None) for k in range(5)]
    b = spark.createDataFrame(rows, "basket_id long, item string").repartition(5)
    # Null baskets are one basket of a chunk of their own, which stays whole.
    chunk = F.coalesce(F.col("basket_id") % 2, F.lit(2))
    want = {tuple(r.itemset) for r in itemsets.son_candidates(b, 25, chunk=chunk).collect()}
    sizes, mined = [], itemsets.mine
    monkeypatch.setattr(itemsets, "CHUNK_ROWS", 60)

    def seen(rows, *args):
        keys = [c for c in ("chunk", "part") if c in rows.columns]
        sizes.extend(rows.groupBy(*keys).count().collect())
        return mined(rows, *args)

    monkeypatch.setattr(itemsets, "mine", seen)
    got = [tuple(r.itemset) for r in itemsets.son_candidates(b, 25, chunk=chunk).collect()]
    assert sorted(got) == sorted(want) and len(want) > 10
    assert max(r["count"] for r in sizes) <= 120


def test_local_threshold_and_repeated_singles(spark):
    # chunk 0 holds 2 of 4 baskets: support 4 needs 2 there
    rows = [(0, "x"), (0, "x"), (2, "y"), (1, "y"), (3, "z")]
    b = spark.createDataFrame(rows, "basket_id long, item string")
    found = itemsets.son_candidates(b, 4, chunk=b["basket_id"] % 2).collect()
    assert [tuple(r.itemset) for r in found] == [("x",)]


def test_max_size(b):
    wanted = {k: v for k, v in brute(2).items() if len(k) <= 2}
    assert as_dict(itemsets.frequent_itemsets(b, 2, max_size=2)) == wanted


def test_baskets_cut_into_pieces(spark):
    """With a need of 1 no basket is left out of pair making; large ones are cut."""
    bags = {1: "abcdefg", 2: "abcdef", 3: "ag", 4: "bcg"}
    b = spark.createDataFrame([(k, x) for k, v in bags.items() for x in v], "basket_id long, item string")
    found = as_dict(itemsets.frequent_itemsets(b, 1, heavy_basket=2))
    items = sorted(set("".join(bags.values())))
    every = [c for k in range(1, len(items) + 1) for c in combinations(items, k)]
    counts = {c: sum(set(c) <= set(v) for v in bags.values()) for c in every}
    assert found == {c: n for c, n in counts.items() if n}


def test_containment_with_an_item_in_all_baskets(spark):
    """The rarest item decides which baskets are looked at; "a" is in all and heavy."""
    b = spark.range(12_000).selectExpr("id AS basket_id", "explode(array('a', concat('x', id % 3))) AS item")
    sets = [["a"], ["a", "x0"], ["a", "x2"], ["x0", "x1"], ["a", "none"]]
    df = spark.createDataFrame([(s,) for s in sets], "itemset array<string>")
    found = as_dict(itemsets.count_candidates(df, b))
    assert found == {("a",): 12_000, ("a", "x0"): 4_000, ("a", "x2"): 4_000}


def test_baskets_are_shuffled_once(spark, b, monkeypatch):
    """Levels above pairs exchange itemsets with counts, and no basket."""
    plans = []
    write = itemsets.stage

    def stage(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df)

    monkeypatch.setattr(itemsets, "stage", stage)
    itemsets.frequent_itemsets(b, 2)
    by_basket = [p for p in plans if "Aggregate [chunk" in p and "collect_list" in p]
    assert len(by_basket) == 1
    heads = [p for p in plans if "posexplode(rest" in p]
    assert heads and not any("Aggregate" in p for p in heads)


def test_support_exact(b):
    counts = brute(1)
    s = counts[("a", "b")]
    assert ("a", "b") in as_dict(itemsets.frequent_itemsets(b, s))
    assert ("a", "b") not in as_dict(itemsets.frequent_itemsets(b, s + 1))


def test_count_candidates(spark, b):
    sets = spark.createDataFrame([(["a", "b"],), (["d", "e"],), (["b", "x"],)], "itemset array<string>")
    assert as_dict(itemsets.count_candidates(sets, b)) == {("a", "b"): 5, ("d", "e"): 1}


def test_candidates(spark):
    sets = [["a", "b"], ["a", "c"], ["b", "c"], ["b", "d"]]
    df = spark.createDataFrame([(s,) for s in sets], "itemset array<string>")
    pruned = {tuple(r.itemset) for r in itemsets.gen_candidates(df).collect()}
    assert pruned == {("a", "b", "c")}
    every = {tuple(r.itemset) for r in itemsets.gen_candidates(df, prune=False).collect()}
    assert every == {("a", "b", "c"), ("a", "b", "d"), ("b", "c", "d")}


def test_basket_key_and_filter(spark, rows):
    tx = spark.createDataFrame(
        [("1/2/2000", "7", "p"), ("11/1/2000", "7", "p"), ("11/10/2000", "7", "p")] * 2
        + [("11/10/2000", "7", "q")],
        "d string, c string, i string",
    )
    b = itemsets.baskets(tx, "d", "c", "i")
    assert {r[0] for r in rows(b)} == {"1/2/200-7", "11/1/00-7", "11/1000-7"}
    assert rows(itemsets.filter_baskets(b, 2)) == [
        ("11/1000-7", "p"),
        ("11/1000-7", "p"),
        ("11/1000-7", "q"),
    ]
    typed = tx.selectExpr("to_date(d, 'M/d/yyyy') AS d", "c", "i")
    assert ("01/02/00-7", "p") in rows(itemsets.baskets(typed, "d", "c", "i"))


def test_report(spark, tmp_path):
    df = spark.createDataFrame([(["b"],), (["a"],), (["a", "b"],)], "itemset array<string>")
    report = itemset_report(("Candidates:", df), ("Frequent Itemsets:", df.limit(0)))
    write_itemset_report(report, str(tmp_path / "r"))
    lines = []
    for part in sorted((tmp_path / "r").glob("part-*")):
        lines += part.read_text().splitlines()
    assert lines == ["Candidates:", "('a')", "('b')", "", "('a', 'b')", "", "Frequent Itemsets:"]


def brute_chunk(rows, need):
    """Sets of items in ``need`` baskets or rows, from rows (basket, item)."""
    bags, counts = {}, {}
    for k, x in rows:
        bags.setdefault(k, set()).add(x)
        counts[x] = counts.get(x, 0) + 1
    singles = sorted(x for x, n in counts.items() if n >= need)
    found = {(x,) for x in singles}
    for k in range(2, len(singles) + 1):
        more = {c for c in combinations(singles, k) if sum(set(c) <= v for v in bags.values()) >= need}
        found |= more
        if not more:
            break
    return found


@pytest.mark.parametrize("seed", range(20))
def test_depth_first_mining_matches_brute_force(seed):
    draw = random.Random(seed)
    rows = [(draw.randint(0, 40), draw.randint(0, 8)) for _ in range(draw.choice([5, 60, 200]))]
    baskets = {k: i for i, k in enumerate(sorted({k for k, _ in rows}))}
    basket, item = np.array([baskets[k] for k, _ in rows]), np.array([x for _, x in rows])
    for need in (1, 2, 4):
        found = list(chunks.frequent(basket, item, len(baskets), need))
        assert len(found) == len(set(found)) and set(found) == brute_chunk(rows, need)


def test_chunks_are_the_only_exchange_of_occurrences(spark, b):
    """Rows of baskets are exchanged by chunk; what comes after are itemsets."""
    plan = itemsets.son_candidates(b, 3, chunk=F.col("basket_id") % 3)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x]
    assert len(exchanges) == 2 and "hashpartitioning(itemset" in exchanges[0] and "hashpartitioning(chunk" in exchanges[1]


def test_null_items_and_baskets(spark):
    rows = [(1, "a"), (1, None), (None, "a"), (None, "b"), (2, "b"), (2, "a"), (3, None)]
    b = spark.createDataFrame(rows, "basket_id long, item string")
    found = {tuple(r.itemset) for r in itemsets.son_candidates(b, 2, chunks=1).collect()}
    assert found == {("a",), ("b",), ("a", "b")}
    assert itemsets.son_candidates(b.limit(0), 2).count() == 0


@pytest.mark.parametrize("block_rows", [1, 5, 1000])
def test_bitmaps_in_blocks_of_sets(spark, b, monkeypatch, block_rows):
    monkeypatch.setattr(bitmaps.supports, "__defaults__", (block_rows,))
    sets = [list(c) for k in (1, 2, 3) for c in combinations("abcdex", k)]
    df = spark.createDataFrame([(s,) for s in sets], "itemset array<string>")
    wanted = {c: n for c, n in brute(1).items() if len(c) <= 3}
    assert as_dict(itemsets.count_candidates(df, b)) == wanted


def test_a_basket_of_many_items(spark):
    """A basket of 20,000 items beside many of two is no array anywhere; bits of 70,000 baskets take three buckets."""
    one = spark.range(20_000).selectExpr("-1L AS basket_id", "concat('i', id) AS item")
    rest = spark.range(70_000).selectExpr("id AS basket_id", "explode(array('i1', concat('i', id % 2 + 2))) AS item")
    b = one.unionByName(rest)
    sets = [["i1"], ["i1", "i2"], ["i2", "i3"], ["i1", "i3", "i999"], ["i1", "none"]]
    df = spark.createDataFrame([(s,) for s in sets], "itemset array<string>")
    found = as_dict(itemsets.count_candidates(df, b))
    assert found == {("i1",): 70_001, ("i1", "i2"): 35_001, ("i2", "i3"): 1, ("i1", "i3", "i999"): 1}
    _, frequent = itemsets.son(b, 30_000, chunks=3)
    assert as_dict(frequent) == {
        ("i1",): 70_001,
        ("i2",): 35_001,
        ("i3",): 35_001,
        ("i1", "i2"): 35_001,
        ("i1", "i3"): 35_001,
    }
