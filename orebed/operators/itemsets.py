"""Baskets, frequent itemsets by levels, and two-phase mining by chunks.

Baskets are put together once, as sorted arrays of their frequent items; an array is at
most as long as there are frequent items. From then on a level is held as rows
``(chunk, id, rest)``: some basket contains the frequent itemset ``id``, and ``rest`` are its
items after the last one of the set. Itemsets one longer are the set with each item of ``rest``,
so a level is counted row by row, and only itemsets with their counts, combined before, cross a
shuffle. Rows meet the table of a level, which Spark broadcasts where its size allows. The
items of an itemset are kept in the level's own, smaller table. Only the loop over
levels runs on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orebed.functions import scalar
from orebed.functions.skew import MIN_ROWS, join_within
from orebed.operators.bitmaps import supports, vertical
from orebed.operators.chunks import mine
from orebed.session import stage

# Baskets with more frequent items than this are left out of pair making,
# at most MOST_HEAVY of them per chunk, and counted by look-up at the end.
HEAVY_BASKET = 5_000
MOST_HEAVY = 1_000

# Rows of baskets in a chunk of two-phase mining.
CHUNK_ROWS = 2_000_000

_SET = ["chunk", "parent", "last"]


def baskets(tx: DataFrame, date: str, customer: str, item: str) -> DataFrame:
    """One basket per day and customer: ``basket_id, item``, duplicates kept.

    Text dates are sliced (first five and last two characters); date and
    timestamp columns are written as ``MM/dd/yy``.
    """
    day = F.col(date)
    if not isinstance(tx.schema[date].dataType, StringType):
        day = F.date_format(day, "MM/dd/yy")
        key = F.concat(day, F.lit("-"), F.col(customer))
    else:
        key = scalar.basket_key(day, F.col(customer))
    return tx.select(key.alias("basket_id"), F.col(item).alias("item"))


def basket_sizes(b: DataFrame, threshold: int, basket: str = "basket_id") -> DataFrame:
    """Baskets with more than ``threshold`` rows, duplicates counted: ``basket, n``."""
    return b.groupBy(basket).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > threshold)


def filter_baskets(b: DataFrame, threshold: int, basket: str = "basket_id") -> DataFrame:
    """The rows of baskets with more than ``threshold`` rows."""
    return b.join(basket_sizes(b, threshold, basket), basket, "left_semi")


def frequent_itemsets(
    b: DataFrame,
    support: int,
    basket: str = "basket_id",
    item: str = "item",
    within: DataFrame | None = None,
    heavy_basket: int = HEAVY_BASKET,
    max_size: int | None = None,
) -> DataFrame:
    """Itemsets in at least ``support`` baskets: ``itemset, size, freq``.

    A basket counts once however often it repeats an item. ``within`` limits
    the search to given itemsets, which must hold all subsets of each; ``max_size``
    limits it to itemsets of so many items.
    """
    occurrences = _occurrences(b, F.lit(0), basket, item)
    need = _need(b, support)
    singles = _at_least(_count(occurrences, "chunk", "item"), need)
    if within is not None:
        first = within.where(F.size("itemset") == 1)
        singles = singles.join(
            first.select(F.col("itemset")[0].alias("item")), "item", "left_semi"
        )
    levels = _levels(occurrences, singles, need, within, heavy_basket, max_size)
    return levels.select("itemset", F.size("itemset").alias("size"), "freq")


def son_candidates(
    b: DataFrame,
    support: int,
    chunks: int | None = None,
    basket: str = "basket_id",
    item: str = "item",
    chunk: Column | None = None,
) -> DataFrame:
    """Phase one: itemsets frequent in some chunk of the baskets, ``itemset, size``.

    A chunk with ``m`` of all ``N`` baskets needs ``count * N >= support * m``.
    Single items count every occurrence, larger sets once per basket. Chunks
    are cut by a hash of the basket, into as many as hold ``CHUNK_ROWS`` rows each if no number is given,
    unless a ``chunk`` expression is given. Each is mined by one task, see ``chunks.mine``; a chunk of more than ``4 * CHUNK_ROWS``
    rows is mined in parts of baskets, since a set frequent in it is frequent in some part, and what they find is counted in the chunk.
    """
    if chunk is None:
        if chunks is None:
            chunks = -(-b.count() // CHUNK_ROWS) or 1
        chunk = F.pmod(F.xxhash64(basket), F.lit(chunks))
    total = b.select(F.count_distinct(F.struct(basket))).first()[0]
    rows = b.select(chunk.cast("int").alias("chunk"), F.col(basket).alias("basket"), F.col(item).alias("item"))
    sizes = stage(rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n")))
    large = sizes.where(F.col("n") > 4 * CHUNK_ROWS)
    if large.isEmpty():
        found = mine(rows, support, total)
    else:
        n = F.coalesce("n", F.lit(1))
        parts = F.when(n > 4 * CHUNK_ROWS, F.ceil(n / CHUNK_ROWS)).otherwise(F.lit(1))
        part = F.pmod(F.xxhash64(F.lit("part"), "basket"), parts).cast("int").alias("part")
        dealt = rows.join(sizes, "chunk", "left").select("chunk", part, "basket", "item")
        found = stage(mine(dealt, support, total).distinct())
        # One part is the whole chunk, so its sets are frequent already.
        in_parts = found.join(large.select("chunk"), "chunk", "left_semi")
        whole = found.join(large.select("chunk"), "chunk", "left_anti")
        found = whole.unionByName(_frequent_in_chunk(rows.join(large.select("chunk"), "chunk", "left_semi"), in_parts, support, total))
    return found.select("itemset").distinct().select("itemset", F.size("itemset").alias("size"))


def _frequent_in_chunk(rows: DataFrame, sets: DataFrame, support: int, total: int) -> DataFrame:
    """Those of ``chunk, itemset`` that are frequent in their chunk, as ``chunks.mine`` counts."""
    # A struct, so that rows without a basket stay one basket.
    rows = rows.select("chunk", F.struct("basket").alias("basket"), "item")
    m = rows.groupBy("chunk").agg(F.count_distinct("basket").alias("m"))
    singles = rows.groupBy("chunk", F.array("item").alias("itemset")).agg(F.count(F.lit(1)).alias("freq"))
    singles = singles.join(sets.where(F.size("itemset") == 1), ["chunk", "itemset"], "left_semi")
    larger = _contained(sets.where(F.size("itemset") > 1), rows.distinct())
    enough = F.col("freq") * F.lit(total) >= F.lit(support) * F.col("m")
    return singles.unionByName(larger).join(stage(m), "chunk").where(enough).select("chunk", "itemset")


def son(
    b: DataFrame,
    support: int,
    chunks: int | None = None,
    basket: str = "basket_id",
    item: str = "item",
    chunk: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both phases: the candidates of the chunks, and those frequent overall.

    A set that is frequent overall is frequent in some chunk, so phase two counts the candidates and mines nothing.
    """
    b = stage(b.select(basket, item))
    candidates = stage(son_candidates(b, support, chunks, basket, item, chunk))
    counted = count_candidates(candidates, b, basket, item).where(F.col("freq") >= support)
    return candidates, counted.select("itemset", F.size("itemset").alias("size"), "freq")


def gen_candidates(sets: DataFrame, prune: bool = True) -> DataFrame:
    """Itemsets one item longer than the given ones, all of one size.

    With ``prune`` only those whose subsets are all given. Without, the union
    of every two sets that differ in one item.
    """
    if prune:
        return _candidates(sets.select(F.lit(0).alias("chunk"), "itemset")).select("itemset")
    # Two sets differ in one item when they agree after leaving one item out.
    parts = sets.select(
        F.expr(
            "explode(transform(itemset, x -> struct(array_remove(itemset, x) AS rest, x AS item)))"
        ).alias("part")
    ).select("part.rest", "part.item")
    pairs = join_within(
        parts, parts, ["rest"], ["item"], F.col("a.item") < F.col("b.item")
    )
    union = F.array_sort(F.concat("a.rest", F.array("a.item", "b.item")))
    return pairs.select(union.alias("itemset")).distinct()


def count_candidates(
    candidates: DataFrame, b: DataFrame, basket: str = "basket_id", item: str = "item"
) -> DataFrame:
    """Baskets holding each candidate: ``itemset, freq``, zero counts left out."""
    occurrences = b.select(
        F.lit(0).alias("chunk"), F.col(basket).alias("basket"), F.col(item).alias("item")
    ).distinct()
    sets = candidates.select(F.lit(0).alias("chunk"), "itemset").distinct()
    return _contained(sets, occurrences).select("itemset", "freq")


def frequent_itemsets_fpgrowth(
    b: DataFrame,
    support: int,
    basket: str = "basket_id",
    item: str = "item",
    heavy_basket: int = HEAVY_BASKET,
) -> DataFrame:
    """The same itemsets by Spark's FP-growth: ``itemset, size, freq``.

    Each basket becomes one array, of its distinct frequent items. The heavy
    baskets ``frequent_itemsets`` leaves out of pair making are left out here.
    """
    occurrences = _occurrences(b, F.lit(0), basket, item)
    need = _need(b, support)
    singles = _at_least(_count(occurrences, "chunk", "item"), need)
    occurrences = stage(occurrences.join(singles, ["chunk", "item"], "left_semi"))
    light, lower, heavy = _set_heavy_aside(occurrences, need, heavy_basket)
    arrays = stage(light.groupBy("basket").agg(F.collect_list("item").alias("items")))
    least = lower.first()["need"]
    n = arrays.count()
    # The model keeps counts >= ceil(share * n); half a basket less is exact.
    share = min(1.0, max(0.0, (least - 0.5) / max(n, 1)))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0).fit(arrays)
    found = model.freqItemsets.select(
        F.lit(0).alias("chunk"), F.array_sort("items").alias("itemset"), "freq"
    )
    if heavy is not None:
        found = _with_heavy(stage(found), occurrences, heavy, need)
    return found.where(F.col("freq") >= support).select(
        "itemset", F.size("itemset").alias("size"), "freq"
    )


def _need(b: DataFrame, support: int) -> DataFrame:
    """The support asked for, as the one row of a single chunk.

    Written, since a join with a literal chunk would become a nested loop.
    """
    need = F.lit(support).cast("long").alias("need")
    return stage(b.sparkSession.range(1).select(F.lit(0).alias("chunk"), need))


def _occurrences(b: DataFrame, chunk: Column, basket: str, item: str) -> DataFrame:
    """Distinct rows of chunk, basket and item, with how often each occurs."""
    rows = b.select(
        chunk.cast("int").alias("chunk"), F.col(basket).alias("basket"), F.col(item).alias("item")
    )
    return stage(rows.groupBy("chunk", "basket", "item").agg(F.count(F.lit(1)).alias("times")))


def _count(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("freq"))


def _at_least(counted: DataFrame, need: DataFrame) -> DataFrame:
    return counted.join(need, "chunk").where(F.col("freq") >= F.col("need")).drop("need")


def _levels(
    occurrences: DataFrame,
    singles: DataFrame,
    need: DataFrame,
    within: DataFrame | None,
    heavy_basket: int,
    max_size: int | None = None,
) -> DataFrame:
    """All frequent itemsets per chunk: ``chunk, itemset, freq``.

    ``occurrences`` are staged, distinct rows of chunk, basket, item;
    ``singles`` the frequent items per chunk; ``need`` the count each chunk
    asks for.
    """
    number = F.monotonically_increasing_id().alias("id")
    level = stage(singles.select("chunk", "item", F.array("item").alias("itemset"), "freq", number))
    occurrences = stage(
        occurrences.join(level.select("chunk", "item", "id"), ["chunk", "item"])
    )
    light, lower, heavy = _set_heavy_aside(occurrences, need, heavy_basket)
    rows = _heads_of_baskets(light)
    found = [level.select("chunk", "itemset", "freq")]
    size = 2
    while max_size is None or size <= max_size:
        allowed = None
        if within is not None:
            allowed = within.where(F.size("itemset") == size).withColumn("chunk", F.lit(0))
        elif size > 2:
            allowed = _candidates(level)
        if allowed is not None:
            allowed = stage(_by_parent(allowed, level))
            if allowed.isEmpty():
                break
        if size > 2:
            rows = stage(_heads(rows, level))
        longer = rows.select("chunk", F.col("id").alias("parent"), F.explode("rest").alias("last"))
        if allowed is not None:
            longer = longer.join(allowed, _SET, "left_semi")
        parents = level.select("chunk", F.col("id").alias("parent"), F.col("itemset").alias("head"))
        itemset = F.concat("head", F.array("last")).alias("itemset")
        level = stage(
            _at_least(_count(longer, *_SET), lower)
            .join(parents, ["chunk", "parent"])
            .select(*_SET, itemset, "freq", number)
        )
        if level.isEmpty():
            break
        found.append(level.select("chunk", "itemset", "freq"))
        size += 1

    singles, larger = found[0], found[1:]
    if heavy is not None and larger:
        larger = [_with_heavy(reduce(DataFrame.unionByName, larger), occurrences, heavy, need)]
    return reduce(DataFrame.unionByName, [singles, *larger])


def _set_heavy_aside(
    occurrences: DataFrame, need: DataFrame, heavy_basket: int
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Leave out the largest baskets of each chunk, no more than half of what
    it needs.

    A set in ``need`` baskets is in ``need - h`` of those left after any ``h``
    go. Returns the occurrences left, with the ``splits`` of their basket, the
    lower needs, and the baskets left out or None.
    """
    large = stage(
        _count(occurrences, "chunk", "basket").where(F.col("freq") > heavy_basket)
    )
    if large.isEmpty():
        return occurrences.withColumn("splits", F.lit(1)), need, None
    largest = Window.partitionBy("chunk").orderBy(F.desc("freq"), "basket")
    heavy = stage(
        large.withColumn("place", F.row_number().over(largest))
        .where(F.col("place") <= MOST_HEAVY)
        .join(need, "chunk")
        .where(F.col("place") <= F.expr("(need - 1) div 2"))
        .select("chunk", "basket")
    )
    share = F.col("freq").cast("double") / heavy_basket
    splits = F.ceil(share * share).cast("int").alias("splits")
    light = stage(
        occurrences.join(heavy, ["chunk", "basket"], "left_anti")
        .join(large.select("chunk", "basket", splits), ["chunk", "basket"], "left")
        .withColumn("splits", F.coalesce("splits", F.lit(1)))
    )
    lower = need.join(_count(heavy, "chunk"), "chunk", "left").select(
        "chunk", (F.col("need") - F.coalesce("freq", F.lit(0))).alias("need")
    )
    return light, lower, heavy


def _with_heavy(
    found: DataFrame, occurrences: DataFrame, heavy: DataFrame, need: DataFrame
) -> DataFrame:
    """Add the counts of the baskets left out and ask for the full need."""
    theirs = occurrences.join(heavy, ["chunk", "basket"], "left_semi")
    more = _contained(found.select("chunk", "itemset"), theirs)
    both = found.unionByName(more).groupBy("chunk", "itemset")
    return _at_least(both.agg(F.sum("freq").alias("freq")), need)


def _heads_of_baskets(light: DataFrame) -> DataFrame:
    """A row for each frequent item of a basket with items after it: ``chunk, id, rest``.

    Baskets are shuffled here only. The rows of a basket with many items are made in as many
    pieces as its square holds squares of the bound, on different tasks.
    """
    member = F.struct("item", "id").alias("member")
    baskets = (
        light.select("chunk", "basket", "splits", member)
        .groupBy("chunk", "basket", "splits")
        .agg(F.array_sort(F.collect_list("member")).alias("items"))
        .where(F.size("items") > 1)
    )
    baskets = stage(baskets)
    whole = baskets.where(F.col("splits") == 1).withColumn("piece", F.lit(0))
    pieces = F.explode(F.sequence(F.lit(0), F.col("splits") - 1)).alias("piece")
    cut = baskets.where(F.col("splits") > 1).select("*", pieces).repartition("chunk", "basket", "piece")
    return (
        whole.unionByName(cut)
        .select("chunk", "splits", "piece", "items", F.posexplode("items").alias("place", "member"))
        .where((F.col("place") % F.col("splits") == F.col("piece")) & (F.col("place") < F.size("items") - 1))
        .select("chunk", "member.id", _after("place", F.col("items.item")).alias("rest"))
    )


def _heads(rows: DataFrame, level: DataFrame) -> DataFrame:
    """The rows of sets one item longer, those of ``level``, with items after them."""
    return (
        rows.select("chunk", F.col("id").alias("parent"), "rest", F.posexplode("rest").alias("place", "last"))
        .where(F.col("place") < F.size("rest") - 1)
        .select(*_SET, _after("place", F.col("rest")).alias("rest"))
        .join(level.select(*_SET, "id"), _SET)
        .select("chunk", "id", "rest")
    )


def _after(place: str, items: Column) -> Column:
    """The items after a place, counted from 0."""
    return F.slice(items, F.col(place) + 2, F.size(items))


def _by_parent(sets: DataFrame, level: DataFrame) -> DataFrame:
    """Itemsets as the number of all but their last item, and that item."""
    head = F.slice("itemset", 1, F.size("itemset") - 1)
    parents = level.select("chunk", F.col("itemset").alias("head"), F.col("id").alias("parent"))
    return (
        sets.select("chunk", head.alias("head"), F.element_at("itemset", -1).alias("last"))
        .join(parents, ["chunk", "head"])
        .select(*_SET)
    )


def _candidates(level: DataFrame) -> DataFrame:
    """Itemsets one longer whose subsets are all in the level: ``chunk, itemset``."""
    # In a level of few sets no group of sets alike but for the last item is heavy.
    few = level.limit(MIN_ROWS).count() < MIN_ROWS
    sets = level.select(
        "chunk",
        F.slice("itemset", 1, F.size("itemset") - 1).alias("head"),
        F.element_at("itemset", -1).alias("last"),
    )
    ordered = F.col("a.last") < F.col("b.last")
    splits = F.lit(1) if few else None
    pairs = join_within(sets, sets, ["chunk", "head"], ["last"], ordered, splits).select(
        "a.chunk", F.concat("a.head", F.array("a.last", "b.last")).alias("itemset")
    )
    # The two sets joined are in the level; left are those lacking an earlier item.
    others = F.size("itemset") - 2
    lacking = F.concat(
        F.slice("itemset", F.lit(1), F.col("gap") - 1),
        F.slice("itemset", F.col("gap") + 1, F.size("itemset")),
    )
    every = F.when(others > 0, F.sequence(F.lit(1), others))
    return (
        pairs.select("chunk", "itemset", F.explode_outer(every).alias("gap"))
        .withColumn("subset", lacking)
        .join(
            level.select("chunk", F.col("itemset").alias("subset"), F.lit(1).alias("hit")),
            ["chunk", "subset"],
            "left",
        )
        .groupBy("chunk", "itemset")
        .agg(F.count("hit").alias("hits"))
        .where(F.col("hits") == others)
        .select("chunk", "itemset")
    )


def _contained(sets: DataFrame, occurrences: DataFrame) -> DataFrame:
    """Baskets of the same chunk that hold each set: ``chunk, itemset, freq``, zero counts left out.

    Counted on bitmaps of the items that the sets hold.
    """
    sets = stage(sets.withColumn("id", F.monotonically_increasing_id()))
    wanted = sets.select("chunk", F.explode("itemset").alias("item")).distinct()
    occurrences = stage(occurrences.select("chunk", "basket", "item").join(wanted, ["chunk", "item"], "left_semi"))
    counted = supports(sets, vertical(occurrences))
    return counted.join(sets, "id").select("chunk", "itemset", "freq")
