"""Finding and splitting keys that hold more than their share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is heavy from its share of one in so many; in sessions with more shuffle partitions, from
# one partition's share.
PARTS = 1000
MIN_ROWS = 10_000


def heavy_keys(
    df: DataFrame,
    keys: Sequence[str],
    parts: int | None = None,
    min_rows: int = MIN_ROWS,
    pairs: bool = False,
) -> DataFrame:
    """Keys that make more than ``1/parts`` of the work, with at least
    ``min_rows`` rows: ``keys..., n_rows, splits``.

    The work of a key is its rows, or its rows squared when its rows are to
    be ``pairs``. Cutting a key into ``splits`` pieces brings each piece down
    to the share. There are fewer than ``parts`` such keys whatever the
    table's size, so the result may be broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return heavy_of(counts, parts, min_rows, pairs)


def heavy_of(
    counts: DataFrame, parts: int | None = None, min_rows: int = MIN_ROWS, pairs: bool = False
) -> DataFrame:
    """``heavy_keys`` from the rows per key, ``keys..., n_rows``, where known."""
    if parts is None:
        parts = max(PARTS, int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = F.col("n_rows").cast("double")
    work = rows * rows if pairs else rows
    least = float(min_rows) ** (2 if pairs else 1)
    share = counts.agg(F.greatest(F.sum(work) / F.lit(parts), F.lit(least))).scalar()
    return counts.where(work > share).withColumn("splits", F.ceil(work / share).cast("int"))


def salted(
    df: DataFrame, heavy: DataFrame, keys: Sequence[str], spread_by: Sequence[str]
) -> DataFrame:
    """Add ``salt``: 0 for ordinary keys, 0..splits-1 by row for heavy ones."""
    splits = F.broadcast(heavy.select(*keys, "splits"))  # fewer than `parts` rows
    return (
        df.join(splits, list(keys), "left")
        .withColumn(
            "salt",
            F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("splits")), F.lit(0)).cast("int"),
        )
        .drop("splits")
    )


def replicated(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One copy of each row per salt of its key: the other side of ``salted``."""
    splits = F.broadcast(heavy.select(*keys, "splits"))  # fewer than `parts` rows
    return (
        df.join(splits, list(keys), "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)))
        .drop("splits")
    )


def join_within(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    condition: Column,
    splits: Column | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Inner join, as ``a`` and ``b``, on ``keys`` and ``condition`` with
    heavy keys split.

    The rows of a key are spread over ``splits`` tasks on the left and copied
    to those tasks on the right. ``splits`` is an expression of the key known
    to both sides, or ``heavy`` the table of heavy keys; without either those
    are counted on the left.
    """
    if splits is None:
        heavy = heavy_keys(left, keys, pairs=True) if heavy is None else heavy
        left, right = salted(left, heavy, keys, spread_by), replicated(right, heavy, keys)
    else:
        salt = F.pmod(F.xxhash64(*spread_by), splits).cast("int")
        left = left.withColumn("salt", salt)
        every = F.sequence(F.lit(0), splits.cast("int") - 1)
        right = right.withColumn("salt", F.explode(every))
    on = condition
    for key in [*keys, "salt"]:
        on = on & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    return left.alias("a").join(right.alias("b"), on)
