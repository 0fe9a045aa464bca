"""Tables written to files and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orebed.catalogue.registry import ORACLES, query, rounded
from orebed.fixtures import view, with_views
from orebed.functions import scalar
from orebed.session import shared_folder
from orebed.sources import readers, schemas, writers


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/orebed-{uuid.uuid4().hex}"


@query(
    "json_roundtrip",
    with_views("reviews")
    + """SELECT review_id, cast(user_id AS varchar) AS user_id,
    cast(business_id AS varchar) AS business_id, stars, useful, funny, cool,
    strftime(date, '%Y-%m-%d %H:%M:%S') AS date, year(date) AS year FROM reviews""",
)
def json_roundtrip(spark, sf_dir):
    folder = _new_folder(spark)
    text_date = F.date_format("date", scalar.TIMESTAMP_FORMAT)
    writers.write_json(view(spark, sf_dir, "reviews").withColumn("date", text_date), folder)
    # The ids are written as numbers; a text column takes them as they stand.
    required = ("review_id", "user_id", "business_id", "date")
    back = readers.read_json_lines(spark, folder, schemas.REVIEW, required)
    return back.drop("text").withColumn("year", F.year(scalar.parse_timestamp(F.col("date"))))


@query(
    "csv_roundtrip",
    with_views("ratings")
    + """SELECT cast(user_id AS varchar) AS user_id, cast(business_id AS varchar) AS business_id,
    round(stars, 6) AS stars FROM ratings""",
)
def csv_roundtrip(spark, sf_dir):
    folder = _new_folder(spark)
    writers.write_csv(view(spark, sf_dir, "ratings").drop("split"), folder)
    return rounded(readers.read_ratings(spark, folder), "stars")


def _quoted_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder of lines with quotes, blanks at the ends and a comma between quotes, which does not protect it."""
    folder = _new_folder(spark)
    ids = view(spark, sf_dir, "ratings").select("user_id", "business_id")
    line = F.format_string(' "%d","b,%d"x ', F.col("user_id"), F.col("business_id"))
    ids.select(line.alias("line")).write.text(folder)
    return folder


_NO_HEADER = with_views("ratings") + "SELECT {} FROM ratings"


@query(
    "split_csv_roundtrip",
    _NO_HEADER.format(
        "cast(user_id AS varchar) AS first, 'b' AS second, concat(business_id, 'x') AS third"
    ),
)
def split_csv_roundtrip(spark, sf_dir):
    """The split reader, every quote deleted."""
    return readers.read_split_csv(spark, _quoted_lines(spark, sf_dir), ["first", "second", "third"], drop_quotes=True)


@query(
    "plain_csv_roundtrip",
    _NO_HEADER.format(
        """concat('"', user_id, '"') AS first, '"b' AS second, concat(business_id, '"x') AS third"""
    ),
)
def plain_csv_roundtrip(spark, sf_dir):
    """The split reader with quotes left as they are."""
    return readers.read_split_csv(spark, _quoted_lines(spark, sf_dir), ["first", "second", "third"])


@query("headed_csv_roundtrip", ORACLES["csv_roundtrip"])
def headed_csv_roundtrip(spark, sf_dir):
    """The split reader with a header, which each part file repeats."""
    folder = _new_folder(spark)
    writers.write_csv(view(spark, sf_dir, "ratings").drop("split"), folder)
    columns = ["user_id", "business_id", "stars"]
    back = readers.read_split_csv(spark, folder, columns, header=True)
    return rounded(back.withColumn("stars", F.col("stars").cast("double")), "stars")


@query("unlabelled_ratings", ORACLES["csv_roundtrip"])
def unlabelled_ratings(spark, sf_dir):
    """A file with stars read without asking for a label: all its columns."""
    folder = _new_folder(spark)
    writers.write_csv(view(spark, sf_dir, "ratings").drop("split"), folder)
    return rounded(readers.read_ratings(spark, folder, labelled=False), "stars")


@query(
    "rating_lines",
    with_views("ratings") + "SELECT concat(user_id, ',', business_id, ',', split) AS line FROM ratings",
)
def rating_lines(spark, sf_dir):
    columns = (F.col(c) for c in ("user_id", "business_id", "split"))
    return view(spark, sf_dir, "ratings").select(scalar.row_text(*columns).alias("line"))


@query(
    "default_key",
    with_views("reviews", "business")
    + """SELECT cast(business_id AS varchar) AS business_id,
    CASE WHEN is_open = 1 THEN city ELSE '' END AS city FROM business""",
)
def default_key(spark, sf_dir):
    """A key that some lines lack, with the empty text as its default."""
    folder = _new_folder(spark)
    known = F.when(F.col("is_open") == 1, F.col("city")).alias("city")
    writers.write_json(view(spark, sf_dir, "business").select("business_id", known), folder)
    schema = StructType().add("business_id", "string").add("city", "string")
    back = readers.read_json_lines(spark, folder, schema, ("business_id",))
    return back.withColumn("city", F.coalesce("city", F.lit("")))
