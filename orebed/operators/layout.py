"""Key-clustered layouts and the row counts of partitions."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.functions.skew import heavy_keys, salted
from orebed.session import shared_folder


def cluster_by(df: DataFrame, key: str, n: int = 10, split_heavy: bool = True) -> DataFrame:
    """Hash the rows into ``n`` partitions by key.

    A later grouping by the key needs no further exchange of rows. With
    ``split_heavy`` a key holding more than an even share of the table is
    spread over as many partitions as it has shares; a grouping then merges
    its partial results in a second, small exchange.
    """
    if not split_heavy:
        return df.repartition(n, key)
    heavy = heavy_keys(df, [key], parts=n, min_rows=1)  # fewer than n rows
    salty = salted(df, heavy, [key], df.columns)
    return salty.repartition(n, key, "salt").drop("salt")


def partition_profile(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows per partition, empty ones included: ``partition_id, n_items``.

    Of ``n`` partitions where their number is known; otherwise each partition is asked.
    """
    if n is None:
        return df.select(F.lit(1)).mapInArrow(_count_rows, "partition_id int, n_items long")
    counts = df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("n_items")
    )
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias("partition_id"))
    return every.join(counts, "partition_id", "left").select(
        "partition_id", F.coalesce("n_items", F.lit(0)).alias("n_items")
    )


def _count_rows(batches):
    n = sum(batch.num_rows for batch in batches)
    part = TaskContext.get().partitionId()
    arrays = [pa.array([part], pa.int32()), pa.array([n], pa.int64())]
    yield pa.RecordBatch.from_arrays(arrays, ["partition_id", "n_items"])


def bucketed(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The rows as a table in the shared folder, hashed by ``keys`` into ``n`` buckets and sorted by them in each.

    The layout lasts: groupings and joins of such tables by the keys, with one number of buckets, exchange nothing, however
    often they are asked. A bucket is read by one task, so choose ``n`` for the largest one.
    """
    name = f"orebed_{uuid.uuid4().hex}"
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{name}"
    # One task a bucket, or each task would write a file for every bucket.
    dealt = df.repartition(n, *keys)
    dealt.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
