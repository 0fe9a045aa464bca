"""Frequent itemsets of the transactions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalogue.registry import ORACLES, query
from orebed.fixtures import view, with_views
from orebed.functions import scalar
from orebed.operators import encode, itemsets, shards
from orebed.session import shared_folder, stage
from orebed.sources import writers

# One basket in so many has to hold a frequent itemset. The SQL checks list sets of one to three items; larger
# ones occur at this share only in the chunks of tables of a few hundred baskets.
ONE_IN = 130

# Where sets of four and more items are asked for; the SQL checks list sets of one to six; larger ones do not occur at this share.
FEW_IN = 500


def _support(b: DataFrame, one_in: int = ONE_IN) -> int:
    """The fixed share of the baskets, rounded up."""
    return max(1, -(-b.select("basket_id").distinct().count() // one_in))


def _support_sql(one_in: int) -> str:
    return f"(SELECT (count(DISTINCT basket_id) + {one_in - 1}) // {one_in} FROM big_tx)"


_SUPPORT_SQL = _support_sql(ONE_IN)


def _big_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(itemsets.filter_baskets(view(spark, sf_dir, "tx"), 3))


def _as_text(sets: DataFrame) -> DataFrame:
    return sets.withColumn("itemset", F.array_join("itemset", ","))


def _sets_sql(name: str, rows: str, need: str, most: int = 3) -> str:
    """Frequent sets of one to ``most`` items per chunk as CTEs ending in ``name``.

    ``rows`` gives chunk, basket_id, item; ``need`` is a condition on n and chunk.
    """
    joined, counts = f"{name}_once AS a1", []
    for size in range(2, most + 1):
        last = f"a1.basket_id = a{size}.basket_id AND a{size - 1}.item < a{size}.item"
        joined += f" JOIN {name}_once AS a{size} ON {last}"
        items = ", ".join(f"a{i}.item" for i in range(1, size + 1))
        line = f"concat('(''', concat_ws(''', ''', {items}), ''')')"
        counts.append(
            f"UNION ALL SELECT a1.chunk, {size}, concat_ws(',', {items}), {line}, count(*)"
            f" FROM {joined} GROUP BY a1.chunk, {items}"
        )
    return f"""{name}_rows AS ({rows}),
    {name}_once AS (SELECT DISTINCT chunk, basket_id, item FROM {name}_rows),
    {name}_count AS (
        SELECT chunk, 1 AS size, item AS itemset, concat('(''', item, ''')') AS line, count(*) AS n
        FROM {name}_rows GROUP BY chunk, item
        {" ".join(counts)}),
    {name} AS (SELECT * FROM {name}_count WHERE {need})"""


_FREQUENT = _sets_sql(
    "frequent", "SELECT DISTINCT 0 AS chunk, basket_id, item FROM big_tx", f"n >= {_SUPPORT_SQL}"
)
# The transactions in four chunks; each needs its share of the support.
_LOCAL = _sets_sql(
    "local",
    "SELECT basket_id % 4 AS chunk, basket_id, item FROM big_tx",
    f"""n * (SELECT count(DISTINCT basket_id) FROM big_tx) >= {_SUPPORT_SQL} *
       (SELECT count(DISTINCT basket_id) FROM local_once AS o WHERE o.chunk = local_count.chunk)""",
)


def _chunk():
    return F.col("basket_id") % 4


@query(
    "daily_baskets",
    with_views("purchases")
    + """, days AS (SELECT strftime(day, '%m/%d/%Y') AS day, customer, item FROM purchases)
    SELECT concat(left(day, 5), right(day, 2), '-', customer) AS basket_id, count(*) AS n,
    count(DISTINCT item) AS n_items FROM days GROUP BY 1""",
)
def daily_baskets(spark, sf_dir):
    """Baskets of a day's text and a customer, as the transactions are read from files."""
    tx = view(spark, sf_dir, "purchases").withColumn("day", F.date_format("day", "MM/dd/yyyy"))
    b = itemsets.baskets(tx, "day", "customer", "item")
    return b.groupBy("basket_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("item").alias("n_items")
    )


@query(
    "basket_subset",
    with_views("tx")
    + """SELECT basket_id, count(DISTINCT CASE WHEN item IN ('Brand#11', 'Brand#22') THEN item END) = 2
    AS holds_both FROM tx GROUP BY basket_id""",
)
def basket_subset(spark, sf_dir):
    """Whether a basket holds two items; there are few brands, so few items in a basket's set."""
    items = view(spark, sf_dir, "tx").groupBy("basket_id").agg(F.collect_set("item").alias("items"))
    wanted = F.array(F.lit("Brand#11"), F.lit("Brand#22"))
    return items.select("basket_id", scalar.is_subset(wanted, F.col("items")).alias("holds_both"))


@query(
    "basket_filter",
    with_views("tx")
    + "SELECT basket_id, count(*) AS n FROM tx GROUP BY basket_id HAVING count(*) > 3",
)
def basket_filter(spark, sf_dir):
    return itemsets.basket_sizes(view(spark, sf_dir, "tx"), 3)


@query(
    "frequent_itemsets",
    with_views("big_tx") + f", {_FREQUENT} SELECT itemset, size, n AS freq FROM frequent",
)
def frequent_itemsets(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    return _as_text(itemsets.frequent_itemsets(b, _support(b)))


_LARGE = _sets_sql(
    "large",
    "SELECT DISTINCT 0 AS chunk, basket_id, item FROM big_tx",
    f"n >= {_support_sql(FEW_IN)}",
    most=6,
)
_LARGE_SQL = with_views("big_tx") + f", {_LARGE} SELECT itemset, size, n AS freq FROM large"


@query("large_itemsets", _LARGE_SQL)
def large_itemsets(spark, sf_dir):
    """Sets of up to four items and more, by levels."""
    b = _big_baskets(spark, sf_dir)
    return _as_text(itemsets.frequent_itemsets(b, _support(b, FEW_IN)))


@query("large_son_itemsets", _LARGE_SQL)
def large_son_itemsets(spark, sf_dir):
    """The same in two phases, the chunks cut by a hash."""
    b = _big_baskets(spark, sf_dir)
    return _as_text(itemsets.son(b, _support(b, FEW_IN), chunks=2)[1])


@query("sharded_itemsets", _LARGE_SQL)
def sharded_itemsets(spark, sf_dir):
    """The same by shards of item groups."""
    b = _big_baskets(spark, sf_dir)
    return _as_text(shards.sharded_itemsets(b, _support(b, FEW_IN)))


@query(
    "frequent_pairs_fpgrowth",
    with_views("big_tx")
    + f", {_FREQUENT} SELECT itemset, size, n AS freq FROM frequent WHERE size = 2",
)
def frequent_pairs_fpgrowth(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    sets = itemsets.frequent_itemsets_fpgrowth(b, _support(b))
    return _as_text(sets.where(F.col("size") == 2))


@query(
    "son_candidates",
    with_views("big_tx") + f", {_LOCAL} SELECT DISTINCT itemset, size FROM local",
)
def son_candidates(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    return _as_text(itemsets.son_candidates(b, _support(b), chunk=_chunk()))


@query("son_itemsets", ORACLES["frequent_itemsets"])
def son_itemsets(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    _, frequent = itemsets.son(b, _support(b), chunk=_chunk())
    return _as_text(frequent)


@query(
    "itemset_report",
    with_views("big_tx")
    + f""", {_LOCAL}, {_FREQUENT},
    lines AS (SELECT DISTINCT 0 AS section, size, 1 AS kind, line FROM local
        UNION ALL SELECT 1, size, 1, line FROM frequent)
    SELECT section, size, kind, line FROM lines
    UNION ALL SELECT DISTINCT section, size, 2, '' FROM lines
    UNION ALL SELECT 0, 0, 0, 'Candidates:'
    UNION ALL SELECT 1, 0, 0, 'Frequent Itemsets:'""",
)
def itemset_report(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    candidates, frequent = itemsets.son(b, _support(b), chunk=_chunk())
    sections = (("Candidates:", candidates), ("Frequent Itemsets:", frequent))
    return writers.itemset_report(*sections).drop("itemset")


@query(
    "itemset_report_lines",
    f"""SELECT line, row_number() OVER (ORDER BY section, size, kind, line) - 1 AS position
    FROM ({ORACLES["itemset_report"]}) AS t""",
)
def itemset_report_lines(spark, sf_dir):
    """The report as a text file, its lines numbered as they stand there."""
    b = _big_baskets(spark, sf_dir)
    candidates, frequent = itemsets.son(b, _support(b), chunk=_chunk())
    folder = f"{shared_folder(spark).rstrip('/')}/orebed-{uuid.uuid4().hex}"
    writers.write_itemset_report(
        writers.itemset_report(("Candidates:", candidates), ("Frequent Itemsets:", frequent)), folder
    )
    lines = spark.read.text(folder).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    return encode.numbered(stage(lines), "file", "block", "at").select("line", "position")


@query(
    "itemset_candidates",
    with_views("big_tx")
    + f""", {_FREQUENT},
    pairs AS (SELECT split_part(itemset, ',', 1) AS x, split_part(itemset, ',', 2) AS y
        FROM frequent WHERE size = 2)
    SELECT concat(a.x, ',', a.y, ',', b.y) AS itemset FROM pairs AS a
    JOIN pairs AS b ON a.x = b.x AND a.y < b.y JOIN pairs AS c ON c.x = a.y AND c.y = b.y""",
)
def itemset_candidates(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    sets = itemsets.frequent_itemsets(b, _support(b), max_size=2)
    return _as_text(itemsets.gen_candidates(sets.where(F.col("size") == 2).select("itemset")))


@query(
    "itemset_unions",
    with_views("big_tx")
    + f""", {_FREQUENT},
    pairs AS (SELECT itemset, split_part(itemset, ',', 1) AS x, split_part(itemset, ',', 2) AS y
        FROM frequent WHERE size = 2)
    SELECT DISTINCT array_to_string(list_sort(list_distinct([a.x, a.y, b.x, b.y])), ',') AS itemset
    FROM pairs AS a JOIN pairs AS b ON a.itemset < b.itemset
        AND (a.x = b.x OR a.x = b.y OR a.y = b.x OR a.y = b.y)""",
)
def itemset_unions(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    sets = itemsets.frequent_itemsets(b, _support(b), max_size=2)
    pairs = sets.where(F.col("size") == 2).select("itemset")
    return _as_text(itemsets.gen_candidates(pairs, prune=False))


@query(
    "candidate_support",
    with_views("big_tx")
    + f""", {_FREQUENT},
    singles AS (SELECT itemset AS item FROM frequent WHERE size = 1),
    once AS (SELECT DISTINCT basket_id, big_tx.item FROM big_tx
        JOIN singles ON big_tx.item = singles.item)
    SELECT concat(a.item, ',', b.item) AS itemset, count(*) AS freq
    FROM once AS a JOIN once AS b ON a.basket_id = b.basket_id AND a.item < b.item
    GROUP BY a.item, b.item""",
)
def candidate_support(spark, sf_dir):
    b = _big_baskets(spark, sf_dir)
    n = b.distinct().groupBy("item").count()
    singles = n.where(F.col("count") >= _support(b)).select(F.array("item").alias("itemset"))
    return _as_text(itemsets.count_candidates(itemsets.gen_candidates(singles), b))
