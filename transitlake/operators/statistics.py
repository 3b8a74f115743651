"""Daily statistics of ticks and captures, per (source, stream, local day).

Every aggregate combines on the map side. The one order-dependent statistic, the
largest gap, is computed in time slices first, so that no window ever holds a whole
stream-day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.bodies import is_valid_snapshot
from transitlake.functions.calendar import local_date_text, millis_between
from transitlake.operators.slices import FENCE_EVERY, with_cuts

DAY = ("source_id", "stream_id", "archive_date")


def with_local_day(ticks: DataFrame, streams: DataFrame) -> DataFrame:
    """Ticks with the ``archive_date`` of their stream's timezone."""
    zones = streams.select("source_id", "stream_id", F.col("timezone").alias("_tz"))
    return (
        ticks.join(zones, ["source_id", "stream_id"])
        .withColumn("archive_date", local_date_text(F.col("scheduled_at"), F.col("_tz")))
        .drop("_tz")
    )


def tick_counters() -> list[Column]:
    category = F.coalesce(F.col("error_category"), F.lit(""))
    return [
        F.count(F.lit(1)).alias("scheduled_ticks"),
        F.count_if(F.col("result") == "skipped").alias("skipped_ticks"),
        F.count_if(category == "http_status").alias("http_failures"),
        F.count_if(category.isin(*K.NETWORK_CATEGORIES)).alias("network_failures"),
    ]


def day_stats(ticks: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    return ticks.groupBy(*keys).agg(*tick_counters())


def long_counts(df: DataFrame, value: str, keys: tuple[str, ...] = DAY, name: str = "n") -> DataFrame:
    """(keys, value, count), leaving out empty values."""
    return (
        df.filter(F.col(value).isNotNull() & (F.col(value) != ""))
        .groupBy(*keys, value).agg(F.count(F.lit(1)).alias(name))
    )


def failure_category_counts(ticks: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    return long_counts(ticks, "error_category", keys)


def parse_status_counts(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    return long_counts(captures, "parse_status", keys)


def validation_flag_counts(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    flags = captures.select(*keys, F.explode("validation_flags").alias("flag"))
    return long_counts(flags, "flag", keys)


def valid_column() -> Column:
    return is_valid_snapshot(F.col("parse_status"), F.col("transport_complete"))


def capture_order() -> Column:
    """Capture order inside a day: scheduled instant, then id."""
    return F.struct("scheduled_at", "capture_id")


def capture_counters() -> list[Column]:
    valid = valid_column()
    timestamp = F.when(valid, F.col("feed_timestamp"))
    return [
        F.count(F.lit(1)).alias("captured_responses"),
        F.count_if(valid).alias("valid_snapshots"),
        F.count_if(~valid).alias("invalid_payloads"),
        F.coalesce(F.sum("entity_count"), F.lit(0)).cast("bigint").alias("entity_total"),
        F.min(timestamp).alias("earliest_feed_timestamp"),
        F.max(timestamp).alias("latest_feed_timestamp"),
        F.min_by("completed_at", capture_order()).alias("earliest_capture"),
        F.max_by("completed_at", capture_order()).alias("latest_capture"),
    ]


def capture_stats(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    return captures.groupBy(*keys).agg(*capture_counters())


def _summed(entries: Column, keys: Column, belongs) -> Column:
    """A map from each key to the summed counts of the entries it belongs to."""
    def total(k: Column) -> Column:
        mine = F.filter(entries, lambda e: belongs(e, k))
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"])

    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(keys)), lambda k: F.struct(k, total(k))))


def tick_facts(ticks: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    """All tick statistics in one pass: rows are first combined per outcome, of which
    there are a dozen, and those are folded to one row and one map per key."""
    category = F.coalesce("error_category", F.lit("")).alias("error_category")
    outcomes = ticks.groupBy(*keys, "result", category).agg(F.count(F.lit(1)).alias("n"))
    entries = F.collect_list(F.struct("error_category", "n")).alias("_entries")
    n, name = F.col("n"), F.col("error_category")

    def total(test: Column) -> Column:
        return F.sum(F.when(test, n).otherwise(0))

    folded = outcomes.groupBy(*keys).agg(
        F.sum(n).alias("scheduled_ticks"),
        total(F.col("result") == "skipped").alias("skipped_ticks"),
        total(name == "http_status").alias("http_failures"),
        total(name.isin(*K.NETWORK_CATEGORIES)).alias("network_failures"),
        entries,
    )
    failed = F.filter("_entries", lambda e: e["error_category"] != "")
    counts = _summed(failed, F.transform(failed, lambda e: e["error_category"]), lambda e, k: e["error_category"] == k)
    return folded.withColumn("failure_category_counts", counts).drop("_entries")


def capture_facts(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    """All order-free capture statistics in one pass.

    Rows are first combined per (status, completeness, flags). Both vocabularies are
    closed and small, so what is left of a day, however large, is a handful of rows.
    """
    valid = valid_column()
    ordered = F.struct("scheduled_at", "capture_id", "completed_at")
    shapes = captures.groupBy(*keys, "parse_status", "transport_complete", "validation_flags").agg(
        F.count(F.lit(1)).alias("n"), F.sum("entity_count").alias("_entities"),
        F.min("feed_timestamp").alias("_low"), F.max("feed_timestamp").alias("_high"),
        F.min(ordered).alias("_first"), F.max(ordered).alias("_last"),
        F.min("sanitized_url").alias("_url"), F.max("sanitized_url").alias("_other_url"),
    )
    n = F.col("n")
    folded = shapes.groupBy(*keys).agg(
        F.sum(n).alias("captured_responses"),
        F.sum(F.when(valid, n).otherwise(0)).alias("valid_snapshots"),
        F.sum(F.when(valid, 0).otherwise(n)).alias("invalid_payloads"),
        F.coalesce(F.sum("_entities"), F.lit(0)).cast("bigint").alias("entity_total"),
        F.min(F.when(valid, F.col("_low"))).alias("earliest_feed_timestamp"),
        F.max(F.when(valid, F.col("_high"))).alias("latest_feed_timestamp"),
        F.min("_first").alias("_first"), F.max("_last").alias("_last"),
        F.min("_url").alias("captured_url"), (F.min("_url") == F.max("_other_url")).alias("urls_agree"),
        F.collect_list(F.struct("parse_status", "validation_flags", "n")).alias("_shapes"),
    )
    statuses = F.transform("_shapes", lambda e: e["parse_status"])
    flags = F.flatten(F.transform("_shapes", lambda e: e["validation_flags"]))
    return folded.withColumns({
        "earliest_capture": F.col("_first.completed_at"), "latest_capture": F.col("_last.completed_at"),
        "parse_status_counts": _summed(F.col("_shapes"), statuses, lambda e, k: e["parse_status"] == k),
        "validation_flag_counts": _summed(F.col("_shapes"), flags, lambda e, k: F.array_contains(e["validation_flags"], k)),
    }).drop("_first", "_last", "_shapes")


SLICE_SECONDS = 900


def largest_fetch_gap(captures: DataFrame, keys: tuple[str, ...] = DAY, every: int = FENCE_EVERY) -> DataFrame:
    """Largest positive distance of consecutive completions, in whole milliseconds.

    Slices of a quarter hour, cut further where many captures lie in one, are windowed on
    their own and reduced to their first and last completion; a second, small window over the
    slices adds the gaps between them.
    """
    done = F.col("completed_at")
    sliced = captures.select(
        *keys, "scheduled_at", "capture_id", "completed_at",
        F.floor(F.unix_seconds("scheduled_at") / SLICE_SECONDS).alias("_slice"),
    )
    in_slice = Window.partitionBy(*keys, "_slice", "_cut").orderBy("scheduled_at", "capture_id")
    slices = (
        with_cuts(sliced, keys, "_slice", ("scheduled_at", "capture_id"), every)
        .withColumn("_gap", millis_between(done, F.lag(done).over(in_slice)))
        .groupBy(*keys, "_slice", "_cut")
        .agg(
            F.max("_gap").alias("_gap"),
            F.min_by(done, capture_order()).alias("_first"),
            F.max_by(done, capture_order()).alias("_last"),
        )
    )
    across = Window.partitionBy(*keys).orderBy("_slice", "_cut")
    step = millis_between(F.col("_first"), F.lag("_last").over(across))
    return (
        slices.withColumn("_step", step)
        .groupBy(*keys)
        .agg(F.greatest(F.max("_gap"), F.max("_step"), F.lit(0)).cast("bigint").alias("largest_fetch_gap_ms"))
    )


def url_agreement(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    """The one sanitized URL of each stream-day; ``urls_agree`` is false otherwise."""
    lowest, highest = F.min("sanitized_url"), F.max("sanitized_url")
    return captures.groupBy(*keys).agg(
        lowest.alias("captured_url"), (lowest == highest).alias("urls_agree")
    )


def input_captures(captures: DataFrame, keys: tuple[str, ...] = DAY) -> DataFrame:
    """The inputs of a stream-day in long form, in capture order within a partition."""
    return captures.select(
        *keys, "scheduled_at", F.col("capture_id").alias("id"),
        F.col("body_sha256").alias("sha256"), F.col("decoded_length").alias("bytes"),
    )


def earliest_tick(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("source_id", "stream_id").agg(F.min("scheduled_at").alias("earliest_tick"))
