"""The review, rating and transaction views over the driver tables.

Each view is one SQL text that Spark and DuckDB both run, so a query and its
SQL check start from the same definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("nation", "supplier", "part", "orders", "lineitem", "documents")

VIEWS = {
    "reviews": """
        SELECT concat(l_orderkey, '-', l_linenumber) AS review_id, o_custkey AS user_id,
               l_suppkey AS business_id,
               cast(1 + floor((l_quantity - 1) / 10) AS double) AS stars,
               l_linenumber AS useful, cast(round(l_discount * 100) AS int) AS funny,
               cast(round(l_tax * 100) AS int) AS cool, o_orderdate AS date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "business": """
        SELECT s_suppkey AS business_id, n_name AS city, avg(stars) AS stars,
               count(review_id) AS review_count,
               CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS is_open
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
             LEFT JOIN reviews ON business_id = s_suppkey
        GROUP BY s_suppkey, n_name, s_acctbal""",
    "tips": """
        SELECT l_suppkey AS business_id FROM lineitem""",
    "photos": """
        SELECT 1 + o_custkey % (SELECT max(s_suppkey) FROM supplier) AS business_id, o_orderkey AS photo_id
        FROM orders""",
    "ratings": """
        SELECT user_id, business_id, avg(stars) AS stars,
               CASE WHEN max(date) < TIMESTAMP '2000-06-01 00:00:00' THEN 'train'
                    ELSE 'val' END AS split
        FROM reviews GROUP BY user_id, business_id""",
    "brand_ratings": """
        SELECT o_custkey AS user_id, p_brand AS item, avg(l_quantity) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
        GROUP BY o_custkey, p_brand""",
    "purchases": """
        SELECT o_orderdate AS day, o_custkey AS customer, p_brand AS item
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""",
    "tx": """
        SELECT l_orderkey AS basket_id, p_brand AS item
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "big_tx": """
        SELECT tx.basket_id, item FROM tx
        JOIN (SELECT basket_id FROM tx GROUP BY basket_id HAVING count(*) > 3) AS kept
          ON tx.basket_id = kept.basket_id""",
}

NEEDS = {"business": ("reviews",), "ratings": ("reviews",), "big_tx": ("tx",)}


def with_views(*names: str) -> str:
    """A WITH clause defining the views and those they are built on."""
    ordered: list[str] = []
    for name in names:
        for each in (*NEEDS.get(name, ()), name):
            if each not in ordered:
                ordered.append(each)
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered) + "\n"


def register(spark: SparkSession, sf_dir: str) -> None:
    """Make the driver tables visible to Spark SQL by name."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views as a DataFrame."""
    register(spark, sf_dir)
    return spark.sql(f"{with_views(name)} SELECT * FROM {name}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
