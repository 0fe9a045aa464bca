"""The end-to-end jobs: each reads files, runs the operators and writes its
result folder. All return what they wrote as DataFrames; their other staged tables are freed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.functions import scalar
from orebed.functions.hashing import SEED
from orebed.operators import (
    cf,
    cities,
    counts,
    encode,
    features,
    itemsets,
    layout,
    regression,
    similarity,
)
from orebed.session import freeing, stage
from orebed.sources import readers, schemas, writers

# Column names of the result files.
PAIR_COLUMNS = ["business_id_1", "business_id_2", "similarity"]
PREDICTION_COLUMNS = ["user_id", "business_id", "prediction"]


@freeing
def review_summary_job(
    spark: SparkSession, reviews_path: str, out_path: str, year: int = 2018, k: int = 10
) -> DataFrame:
    """Counts, distinct counts and top users and businesses as one JSON document."""
    needed = ("user_id", "business_id", "date")
    reviews = readers.read_json_lines(spark, reviews_path, schemas.REVIEW, needed)
    timed = reviews.withColumn("date", scalar.parse_timestamp(F.col("date")))
    summary = stage(counts.review_summary(timed, year, k), keep=True)
    writers.write_json(summary, out_path)
    return summary


@freeing
def layout_job(
    spark: SparkSession, reviews_path: str, out_path: str, n: int = 10, k: int = 10
) -> DataFrame:
    """Partition sizes and top businesses as scanned and clustered by business:
    ``layout, n_partition, n_items, top``, one JSON document per layout."""
    reviews = readers.read_json_lines(spark, reviews_path, schemas.REVIEW)
    keys = reviews.select(F.coalesce("business_id", F.lit("")).alias("business_id"), "review_id")
    both = {"default": keys, "customized": layout.cluster_by(keys, "business_id", n)}
    rows = None
    for name, table in both.items():
        profile = layout.partition_profile(table, n if name == "customized" else None)
        top = counts.ranked_list(counts.top_k(table, "business_id", k), "business_id")
        # One entry per partition of the layout.
        ordered = F.array_sort(F.collect_list(F.struct("partition_id", "n_items")))
        row = profile.agg(
            F.lit(name).alias("layout"),
            F.count(F.lit(1)).alias("n_partition"),
            F.transform(ordered, lambda x: x["n_items"]).alias("n_items"),
        ).withColumn("top", top)
        rows = row if rows is None else rows.unionByName(row)
    rows = stage(rows, keep=True)
    writers.write_json(rows, out_path)
    return rows


@freeing
def city_job(
    spark: SparkSession,
    business_path: str,
    reviews_path: str,
    means_path: str,
    top_path: str,
    k: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Mean stars of all cities as CSV and the top cities as JSON."""
    business = readers.read_json_lines(spark, business_path, schemas.BUSINESS, ("business_id",))
    needed = ("business_id", "stars")
    reviews = readers.read_json_lines(spark, reviews_path, schemas.REVIEW, needed)
    means = stage(cities.city_mean_stars(business, reviews), keep=True)
    ordered = cities.sorted_cities(means)
    writers.write_csv(ordered, means_path)
    top = ordered.limit(k)
    writers.write_json(top, top_path)
    return ordered, top


@freeing
def itemset_job(
    spark: SparkSession,
    threshold: int,
    support: int,
    in_path: str,
    out_path: str,
    chunks: int | None = None,
    baskets_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Candidates and frequent itemsets of the customers' daily baskets.

    The transaction file has a header, the date in the first column, the
    customer in the second and the product in the sixth. Baskets of more than
    ``threshold`` products count. ``baskets_path`` also writes the baskets.
    """
    columns = ["date", "customer", None, None, None, "product"]
    tx = readers.read_split_csv(spark, in_path, columns, header=True, drop_quotes=True)
    b = itemsets.baskets(tx, "date", "customer", "product")
    if baskets_path is not None:
        writers.write_csv(
            b.withColumnsRenamed({"basket_id": "DATE-CUSTOMER_ID", "item": "PRODUCT_ID"}),
            baskets_path,
        )
    b = itemsets.filter_baskets(b, threshold)
    candidates, frequent = itemsets.son(b, support, chunks)
    candidates, frequent = stage(candidates, keep=True), stage(frequent, keep=True)
    report = writers.itemset_report(
        ("Candidates:", candidates), ("Frequent Itemsets:", frequent)
    )
    writers.write_itemset_report(report, out_path)
    return candidates, frequent


@freeing
def similarity_job(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    threshold: float = 0.5,
    bands: int = similarity.BANDS,
    rows: int = similarity.ROWS,
    seed: int = SEED,
    copies_path: str | None = None,
) -> DataFrame:
    """Businesses rated by similar sets of users, as CSV in the order of ids.

    With ``copies_path`` businesses with equal sets of users appear in the
    pairs by the first of them only, and the others are listed there.
    """
    ratings = readers.read_ratings(spark, in_path)
    sets = similarity.char_sets(ratings, "business_id", "user_id")
    pairs, members = similarity.similar_groups(sets, threshold, bands, rows, seed)
    if copies_path is None:
        pairs = similarity.list_pairs(pairs, members, threshold)
    else:
        writers.write_csv(members.select("set_id", "first_id"), copies_path)
    ordered = similarity.sorted_pairs(stage(pairs, keep=True)).toDF(*PAIR_COLUMNS)
    writers.write_csv(ordered, out_path)
    return ordered


@freeing
def cf_job(
    spark: SparkSession,
    train_path: str,
    val_path: str,
    out_path: str,
    min_common: int = 2,
    n_neighbours: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Item-item weights and predictions; writes the predictions as CSV."""
    columns = ("user_id", "business_id", "stars")
    train = stage(cf.triples(readers.read_ratings(spark, train_path), *columns))
    val = cf.triples(readers.read_ratings(spark, val_path), *columns)
    weights = stage(cf.item_weights(train, min_common), keep=True)
    predictions = stage(cf.predict(train, weights, val, n_neighbours), keep=True).toDF(*PREDICTION_COLUMNS)
    writers.write_csv(predictions, out_path)
    return weights, predictions


@freeing
def rating_job(
    spark: SparkSession,
    train_path: str,
    val_path: str,
    business_path: str,
    reviews_path: str,
    tips_path: str,
    photos_path: str,
    out_path: str,
    model_path: str | None = None,
    codes_path: str | None = None,
    **parameters,
) -> DataFrame:
    """Predicted ratings of a validation file from joined features.

    Writes the predictions as CSV, and the model and the label codes where a
    path is given. Returns ``part, rmse`` for train and val.
    """
    business, user = ("business_id",), ("user_id", "business_id")
    train = readers.read_ratings(spark, train_path)
    val = readers.read_ratings(spark, val_path)
    sources = (
        # Of several lines for a business the last in the files counts.
        readers.read_json_lines(spark, business_path, schemas.BUSINESS, business).withColumn("order", readers.place()),
        readers.read_json_lines(spark, reviews_path, schemas.REVIEW, user),
        readers.read_json_lines(spark, tips_path, schemas.TIP, business),
        readers.read_json_lines(spark, photos_path, schemas.PHOTO, business),
    )
    both = train.withColumn("part", F.lit("train")).unionByName(
        val.withColumn("part", F.lit("val"))
    )
    table = stage(features.rating_features(both, *sources, order="order"))
    if codes_path is not None:
        for column in ("user_id", "business_id"):
            known = stage(encode.encode(train, column))
            encode.encode(val, column, known).write.parquet(f"{codes_path}/{column}")
    model = regression.fit_ratings(table.where(F.col("part") == "train"), **parameters)
    if model_path is not None:
        regression.save_model(model, model_path)
    scored = stage(regression.predict_ratings(model, table), keep=True)
    writers.write_csv(scored.where(F.col("part") == "val").select(*PREDICTION_COLUMNS), out_path)
    return counts.rmse(scored, "prediction", "stars", "part")
