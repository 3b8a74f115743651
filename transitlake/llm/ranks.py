"""Ranks within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, group: list[str], order: str, ties: list[str], counts: DataFrame) -> DataFrame:
    """``rows`` with ``rank_`` from 0 within ``group``, by ``order`` (a number in [0, 1)) and ``ties``.

    ``counts`` has ``group`` and ``n``. A group of n rows is cut into about sqrt(n) buckets by
    ``order``; a rank is the rows of earlier buckets and the place in the own one, so that
    no task sees more than about sqrt(n) rows of a group.
    """
    bucket = F.floor(F.col(order) * F.ceil(F.sqrt("n"))).cast("long").alias("bucket_")
    dealt = rows.join(counts, group).select("*", bucket)
    sizes = dealt.groupBy(*group, "bucket_").agg(F.count("*").alias("in_bucket_"))
    before = Window.partitionBy(*group).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "bucket_", F.coalesce(F.sum("in_bucket_").over(before), F.lit(0)).alias("before_"))
    own = Window.partitionBy(*group, "bucket_").orderBy(order, *ties)
    return dealt.withColumn("place_", F.row_number().over(own)).join(sizes, [*group, "bucket_"]) \
        .withColumn("rank_", F.col("before_") + F.col("place_") - 1).drop("bucket_", "place_", "before_")
