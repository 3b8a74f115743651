"""Health tables: counters, cumulative histograms and last-seen gauges.

The counters also run on a stream, in update or complete mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.operators.statistics import valid_column

STREAM_KEYS = ("source_id", "stream_id")


def fetch_attempts(ticks: DataFrame) -> DataFrame:
    """Outcomes per stream; a tick still running has none yet."""
    return (
        ticks.filter(F.col("result") != "running")
        .groupBy(*STREAM_KEYS, "result").agg(F.count(F.lit(1)).alias("n"))
    )


def validation_totals(captures: DataFrame) -> DataFrame:
    flags = captures.select(*STREAM_KEYS, F.explode("validation_flags").alias("flag"))
    return flags.groupBy(*STREAM_KEYS, "flag").agg(F.count(F.lit(1)).alias("n"))


def skipped_totals(ticks: DataFrame) -> DataFrame:
    return (
        ticks.filter(F.col("result") == "skipped")
        .groupBy(*STREAM_KEYS, "skip_reason").agg(F.count(F.lit(1)).alias("n"))
    )


def publication_totals(publications: DataFrame) -> DataFrame:
    """Outcomes of publication attempts per destination."""
    return (
        publications.filter(F.col("status").isin("verified", "retry", "permanent_failure"))
        .groupBy("destination_id", F.col("status").alias("result")).agg(F.count(F.lit(1)).alias("n"))
    )


def histogram(df: DataFrame, value: Column, buckets: Sequence[float],
              keys: Sequence[str] = STREAM_KEYS) -> DataFrame:
    """Cumulative counts per upper bound, plus the unbounded one, in long form.

    One aggregate per bound in a single map-side pass: rows are not multiplied.
    """
    counts = [F.count_if(value <= F.lit(float(le))).alias(f"_b{i}") for i, le in enumerate(buckets)]
    wide = df.filter(value.isNotNull()).groupBy(*keys).agg(*counts, F.count(value).alias("_all"))
    bounds = [
        F.struct(F.lit(float(le)).alias("le"), F.col(f"_b{i}").alias("n")) for i, le in enumerate(buckets)
    ]
    bounds.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("n")))
    return wide.select(*keys, F.inline(F.array(*bounds)))


def last_seen(captures: DataFrame) -> DataFrame:
    """Most recent capture, valid capture, and feed timestamp of a valid capture."""
    valid = valid_column()
    order = F.struct("completed_at", "capture_id")
    stamped = valid & F.col("feed_timestamp").isNotNull()
    return captures.groupBy(*STREAM_KEYS).agg(
        F.unix_seconds(F.max("completed_at")).alias("last_capture"),
        F.unix_seconds(F.max(F.when(valid, F.col("completed_at")))).alias("last_valid_capture"),
        F.max_by(F.when(stamped, F.col("feed_timestamp")), F.when(stamped, order)).alias("last_feed_timestamp"),
    )
