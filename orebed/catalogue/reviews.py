"""Review analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orebed.catalogue.registry import ORACLES, query, rounded
from orebed.fixtures import view, with_views
from orebed.operators import cities, counts, encode, layout
from orebed.session import stage

_TOP = "SELECT {key}, count(*) AS n FROM reviews GROUP BY {key} ORDER BY n DESC, {key} LIMIT 10"


def _top_text(key: str) -> str:
    return (
        f"(SELECT string_agg(concat({key}, ':', n), ',' ORDER BY n DESC, {key}) FROM "
        f"({_TOP.format(key=key)}) AS t)"
    )


@query(
    "review_summary",
    with_views("reviews")
    + f"""SELECT count(*) AS n_review,
        count(*) FILTER (WHERE year(date) = 1998) AS n_review_year,
        count(DISTINCT user_id) AS n_user, count(DISTINCT business_id) AS n_business,
        {_top_text('user_id')} AS top_user, {_top_text('business_id')} AS top_business
        FROM reviews""",
)
def review_summary(spark, sf_dir):
    summary = counts.review_summary(view(spark, sf_dir, "reviews"), year=1998)

    def text(column, key):
        pairs = F.transform(column, lambda x: F.concat(x[key], F.lit(":"), x["n"]))
        return F.array_join(pairs, ",").alias(column)

    return summary.select(
        "n_review",
        "n_review_year",
        "n_user",
        "n_business",
        text("top_user", "user_id"),
        text("top_business", "business_id"),
    )


@query(
    "distinct_users_and_businesses",
    with_views("reviews")
    + """SELECT 'user_id' AS field, count(DISTINCT user_id) AS n FROM reviews
    UNION ALL SELECT 'business_id', count(DISTINCT business_id) FROM reviews""",
)
def distinct_users_and_businesses(spark, sf_dir):
    reviews = view(spark, sf_dir, "reviews")
    user, business = (
        counts.distinct_count(reviews, f).select(F.lit(f).alias("field"), "n") for f in ("user_id", "business_id")
    )
    return user.unionByName(business)


@query("top_users", with_views("reviews") + _TOP.format(key="user_id"))
def top_users(spark, sf_dir):
    return counts.top_k(view(spark, sf_dir, "reviews"), "user_id")


@query("top_businesses", with_views("reviews") + _TOP.format(key="business_id"))
def top_businesses(spark, sf_dir):
    return counts.top_k(view(spark, sf_dir, "reviews"), "business_id")


@query("clustered_top_businesses", ORACLES["top_businesses"])
def clustered_top_businesses(spark, sf_dir):
    keys = view(spark, sf_dir, "reviews").select("business_id", "review_id")
    return counts.top_k(layout.cluster_by(keys, "business_id", 10), "business_id")


@query("partition_profile")
def partition_profile(spark, sf_dir):
    keys = view(spark, sf_dir, "reviews").select("business_id")
    return layout.partition_profile(layout.cluster_by(keys, "business_id", 10, False), 10)


@query(
    "partition_totals",
    with_views("reviews")
    + """SELECT 10 AS n_partitions, count(*) AS n_items, cast(0 AS bigint) AS n_split_keys FROM reviews""",
)
def partition_totals(spark, sf_dir):
    """What holds of any clustering by key: partitions, rows, and keys in more than one."""
    keys = view(spark, sf_dir, "reviews").select("business_id")
    rows = layout.cluster_by(keys, "business_id", 10, False).groupBy(
        "business_id", F.spark_partition_id().alias("partition_id")
    )
    places = stage(rows.agg(F.count(F.lit(1)).alias("n")))
    split = places.groupBy("business_id").count().where("count > 1").agg(F.count(F.lit(1)).alias("n_split_keys"))
    profile = layout.partition_profile(layout.cluster_by(keys, "business_id", 10, False), 10)
    totals = profile.agg(
        F.count(F.lit(1)).cast("int").alias("n_partitions"), F.sum("n_items").alias("n_items")
    )
    return totals.withColumn("n_split_keys", split.scalar())


@query(
    "bucketed_businesses",
    with_views("reviews", "business")
    + """SELECT b.business_id, city, n, round(mean, 6) AS mean FROM business AS b JOIN
    (SELECT business_id, count(*) AS n, avg(stars) AS mean FROM reviews GROUP BY business_id) AS r
    ON b.business_id = r.business_id""",
)
def bucketed_businesses(spark, sf_dir):
    """Grouped by and joined on the key of tables that are bucketed by it."""
    reviews = layout.bucketed(view(spark, sf_dir, "reviews").select("business_id", "stars"), ["business_id"], 8)
    business = layout.bucketed(view(spark, sf_dir, "business").select("business_id", "city"), ["business_id"], 8)
    by_business = reviews.groupBy("business_id").agg(F.count(F.lit(1)).alias("n"), F.avg("stars").alias("mean"))
    return rounded(business.hint("merge").join(by_business, "business_id"), "mean")


_CITY = """SELECT city, round(avg(r.stars), 6) AS stars
    FROM business AS b JOIN reviews AS r ON b.business_id = r.business_id GROUP BY city"""


@query("city_mean_stars", with_views("reviews", "business") + _CITY)
def city_mean_stars(spark, sf_dir):
    means = cities.city_mean_stars(view(spark, sf_dir, "business"), view(spark, sf_dir, "reviews"))
    return rounded(means, "stars")


@query("top_cities", with_views("reviews", "business") + _CITY + " ORDER BY stars DESC, city LIMIT 10")
def top_cities(spark, sf_dir):
    means = city_mean_stars(spark, sf_dir)
    return cities.sorted_cities(means).limit(10)


@query(
    "sorted_city_means",
    with_views("reviews", "business")
    + f"""SELECT city, stars, row_number() OVER (ORDER BY stars DESC, city NULLS FIRST) - 1 AS position
    FROM ({_CITY}) AS t""",
)
def sorted_city_means(spark, sf_dir):
    return encode.in_order(cities.sorted_cities(city_mean_stars(spark, sf_dir)))
