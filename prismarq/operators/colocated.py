"""Datasets laid out by image id, so that published rows meet their originals without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismarq.sources.shared import shared_folder

#: Rows of a bucket that a layout aims at, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 20_000


def buckets_for(rows: int) -> int:
    """Buckets for so many rows: a power of two, so that layouts of different sizes still fit each other."""
    return min(MOST_BUCKETS, 1 << max(3, (-(-rows // BUCKET_ROWS) - 1).bit_length()))


def lay_out(df: DataFrame, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by ``key``: one shuffle, paid once for all later joins."""
    spark, name = df.sparkSession, name or f"laid_out_{uuid.uuid4().hex}"
    # One file per bucket: else every task would write a file of each.
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", shared_folder(spark)).saveAsTable(name)
    return spark.table(name)


def published_with_originals(published: DataFrame, originals: DataFrame, key: str = "image_id") -> DataFrame:
    """Every published row with its original, and what one side has alone, for two layouts of equal buckets.

    ``side`` says ``both``, ``published`` or ``original``.  Columns of the originals that clash get the prefix ``original_``.
    """
    clash = {c: f"original_{c}" for c in originals.columns if c in published.columns and c != key}
    other = originals.withColumnsRenamed(clash).withColumn("__there", F.lit(1))
    here = published.withColumn("__here", F.lit(1))
    rows = here.hint("merge").join(other, key, "full")
    side = F.when(F.col("__here").isNull(), "original").when(F.col("__there").isNull(), "published").otherwise("both")
    return rows.withColumn("side", side).drop("__here", "__there")


def drop_layout(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
