"""Mean stars per city over a join of businesses and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def city_mean_stars(
    business: DataFrame,
    reviews: DataFrame,
    key: str = "business_id",
    city: str = "city",
    stars: str = "stars",
) -> DataFrame:
    """Mean over reviews of the businesses of a city: ``city, stars``.

    Reviews are summed per business before the join, so the join sees one
    row per business however many reviews it has. A NULL city is a group of
    its own and a business listed twice counts its reviews twice.
    """
    per_business = reviews.groupBy(key).agg(
        F.sum(stars).alias("_sum"), F.count(stars).alias("_n")
    )
    joined = business.select(key, city).join(per_business, key)
    mean = F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))
    return joined.groupBy(city).agg(mean.alias("stars"))


def sorted_cities(means: DataFrame, city: str = "city") -> DataFrame:
    """All cities, mean descending, then name."""
    return means.orderBy(F.desc("stars"), F.asc_nulls_first(city))


def top_cities(
    business: DataFrame, reviews: DataFrame, k: int = 10, city: str = "city", **columns: str
) -> DataFrame:
    """The ``k`` cities with the highest mean, ties by name."""
    return sorted_cities(city_mean_stars(business, reviews, city=city, **columns), city).limit(k)
