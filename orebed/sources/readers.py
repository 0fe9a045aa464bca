"""Scans of JSON-lines and comma-separated files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from orebed.functions import scalar
from orebed.sources.schemas import RATING


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job on a row where one of ``columns`` is NULL, whichever columns are used later.

    The check is a row filter: unlike a column's expression it is not pruned with the column.
    """
    if not columns:
        return df
    checks = [
        F.when(F.col(name).isNull(), F.raise_error(F.lit(f"required field {name} is missing")).cast("boolean"))
        for name in columns
    ]
    return df.where(F.coalesce(*checks, F.lit(True)))


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType, required: Sequence[str] = ()
) -> DataFrame:
    """One object per line. A malformed line fails the job, an absent field
    is NULL, and an absent ``required`` field fails the job."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return require(df, required)


def place() -> Column:
    """Where a row of a file scan stands, in the order of files by name and lines within; for a column of the scan itself."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def read_split_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    header: bool = False,
    drop_quotes: bool = False,
) -> DataFrame:
    """Lines trimmed and cut at every comma, all columns text.

    Quotes never protect a comma; ``drop_quotes`` deletes them. With
    ``header`` every line whose fields equal those of the first line of the first file, by name, is
    dropped, wherever it stands. Fields beyond ``columns`` are ignored.
    """
    text = spark.read.text(path)
    fields = scalar.split_fields(F.col("value"), drop_quotes)
    rows = text.select(fields.alias("fields"))
    if header:
        first = _first_line(spark, text, fields)
        if first is not None:
            rows = rows.where(F.col("fields") != F.lit(first))
    return rows.select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(columns) if name]
    )


def _first_line(spark: SparkSession, text: DataFrame, fields: Column) -> list[str] | None:
    """The fields of the first line of the first file with a line, by name."""
    for name in sorted(text.inputFiles()):
        first = spark.read.text(name).select(fields.alias("fields")).first()
        if first is not None:
            return first["fields"]
    return None


def read_csv(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> DataFrame:
    """Ordinary CSV with quoting; a field that does not parse fails the job."""
    return (
        spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)
    )


def read_ratings(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """User, business and, when labelled, stars; one header line.

    Without ``labelled`` the columns of the header are kept, stars included if there are
    any, and only user and business have to parse.
    """
    if labelled:
        return read_csv(spark, path, RATING)
    names = spark.read.option("header", True).csv(path).columns
    types = {f.name: f.dataType for f in RATING.fields}
    schema = StructType([StructField(n, types.get(n, StringType())) for n in names])
    return read_csv(spark, path, schema)
