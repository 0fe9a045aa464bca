"""Row counts, top-k keys and the review summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.session import stage


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key, not distinct; combined before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Exact number of distinct values, NULL not counted."""
    return df.agg(F.countDistinct(column).alias(name))


def top_k(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` keys with the most rows: count descending, then key. A NULL is no key."""
    return count_by(df, key).where(F.col(key).isNotNull()).orderBy(F.desc("n"), F.asc(key)).limit(k)


def ranked_list(top: DataFrame, key: str, value: str = "n") -> Column:
    """A top-k table as one array of (key, value) structs, best first."""
    rows = F.collect_list(F.struct((-F.col(value)).alias("rank"), F.col(key), F.col(value)))
    kept = F.transform(F.array_sort(rows), lambda x: F.struct(x[key].alias(key), x[value].alias(value)))
    return top.agg(kept.alias("top")).scalar()


def review_summary(
    reviews: DataFrame,
    year: int = 2018,
    k: int = 10,
    user: str = "user_id",
    business: str = "business_id",
    time: str = "date",
) -> DataFrame:
    """One row: n_review, n_review_year, n_user, top_user, n_business, top_business.

    Users and businesses are each counted once, in one pass of per-key partial
    counts; the totals, the number of keys and the top follow from those.
    """
    in_year = F.count_if(F.year(time) == year)
    by_user = stage(
        reviews.groupBy(user).agg(F.count(F.lit(1)).alias("n"), in_year.alias("n_year"))
    )
    by_business = stage(count_by(reviews, business))
    totals = by_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_review"),
        F.coalesce(F.sum("n_year"), F.lit(0)).alias("n_review_year"),
        F.count(user).alias("n_user"),
    )

    def top(counts: DataFrame, key: str) -> Column:
        kept = counts.where(F.col(key).isNotNull()).orderBy(F.desc("n"), F.asc(key)).limit(k)
        return ranked_list(kept, key)

    return totals.select(
        "n_review",
        "n_review_year",
        "n_user",
        top(by_user, user).alias("top_user"),
        by_business.agg(F.count(business)).scalar().alias("n_business"),
        top(by_business, business).alias("top_business"),
    )


def rmse(
    df: DataFrame, prediction: str = "prediction", label: str = "label", *keys: str
) -> DataFrame:
    """Root mean squared error, one row or one per key."""
    error = F.col(prediction) - F.col(label)
    return df.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
