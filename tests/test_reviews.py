from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orebed.operators import cities, counts, layout


@pytest.fixture(scope="module")
def tied(spark):
    # twelve keys; the third to twelfth tie across rank ten
    rows = [("a", i) for i in range(5)] + [("b", i) for i in range(4)]
    rows += [(k, i) for k in "lkjihgfedc" for i in range(2)]
    return spark.createDataFrame(rows, "k string, i int").repartition(6)


def test_ties_at_rank_ten(tied):
    top = [(r.k, r.n) for r in counts.top_k(tied, "k").collect()]
    assert top == [("a", 5), ("b", 4)] + [(k, 2) for k in "cdefghij"]


def test_clustered_top_is_the_same(tied):
    plain = counts.top_k(tied, "k").collect()
    for split in (True, False):
        assert counts.top_k(layout.cluster_by(tied, "k", 4, split), "k").collect() == plain


def test_clustering_needs_one_exchange(tied, spark):
    clustered = counts.count_by(layout.cluster_by(tied, "k", 10, split_heavy=False), "k")
    plan = clustered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_heavy_key_is_spread(spark):
    rows = [("hot", i) for i in range(900)] + [(f"k{i}", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, i int")
    profile = layout.partition_profile(layout.cluster_by(df, "k", 10), 10).collect()
    assert sum(r.n_items for r in profile) == 1000
    assert max(r.n_items for r in profile) < 500
    hashed = layout.partition_profile(layout.cluster_by(df, "k", 10, False), 10).collect()
    assert max(r.n_items for r in hashed) >= 900


def test_profile_counts_empty_partitions(spark, rows):
    df = spark.createDataFrame([("a",), ("a",)], "k string").repartition(3, "k")
    assert sorted(n for _, n in rows(layout.partition_profile(df, 3))) == [0, 0, 2]
    assert len(rows(layout.partition_profile(df))) == 3


def test_summary(spark):
    rows = [
        ("u1", "b1", "2018-01-01 00:00:00"),
        ("u1", "b2", "2017-01-01 00:00:00"),
        ("u2", "b1", "2018-12-31 23:59:59"),
    ]
    df = spark.createDataFrame(rows, "user_id string, business_id string, date string")
    df = df.withColumn("date", F.to_timestamp("date"))
    row = counts.review_summary(df, k=1).first()
    assert (row.n_review, row.n_review_year, row.n_user, row.n_business) == (3, 2, 2, 2)
    assert [tuple(x) for x in row.top_user] == [("u1", 2)]
    assert [tuple(x) for x in row.top_business] == [("b1", 2)]
    empty = counts.review_summary(df.limit(0)).first()
    assert (empty.n_review, empty.n_user, empty.top_user) == (0, 0, [])


def test_city_means(spark):
    business = spark.createDataFrame(
        [("b1", "x"), ("b1", "x"), ("b2", "x"), ("b3", None), ("b4", "quiet"), ("b5", "w")],
        "business_id string, city string",
    )
    reviews = spark.createDataFrame(
        [("b1", 5.0), ("b2", 2.0), ("b2", 4.0), ("b3", 1.0), ("b9", 3.0), ("b5", 4.0)],
        "business_id string, stars double",
    )
    got = [tuple(r) for r in cities.sorted_cities(cities.city_mean_stars(business, reviews)).collect()]
    # b1 is listed twice, b4 has no review, b9 no business; w and x tie
    assert got == [("w", 4.0), ("x", 4.0), (None, 1.0)]
    top = [tuple(r) for r in cities.top_cities(business, reviews, k=1).collect()]
    assert top == [("w", 4.0)]


def test_rmse(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, 3.0, "a")], "prediction double, label double, k string")
    assert counts.rmse(df).first().rmse == pytest.approx(0.5**0.5)
    assert counts.rmse(df, "prediction", "label", "k").first().k == "a"


def test_distinct_count(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    assert counts.distinct_count(df, "x").first().n == 2
