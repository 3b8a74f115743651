"""Which stream-days are due for compaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.calendar import day_end, local_date
from transitlake.operators import ledger as L
from transitlake.operators.statistics import DAY, earliest_tick


def candidate_days(streams: DataFrame, ticks: DataFrame, now: Column,
                   close_delay_s: int = K.CLOSE_DELAY_S) -> DataFrame:
    """Every local day of every stream, from its first tick to its last closed day."""
    tz = F.col("timezone")
    first = local_date(F.col("earliest_tick"), tz)
    last = F.date_sub(local_date(now - F.make_interval(secs=F.lit(close_delay_s)), tz), 1)
    # a delay across a clock change can still leave the last day open: check each end
    days = (
        streams.select("source_id", "stream_id", "timezone").join(earliest_tick(ticks), ["source_id", "stream_id"])
        .withColumn("_first", first).withColumn("_last", F.date_add(last, 1)).filter("_first <= _last")
        .withColumn("_day", F.explode(F.sequence("_first", "_last")))
    )
    closed = now >= day_end(F.col("_day"), tz) + F.make_interval(secs=F.lit(close_delay_s))
    return days.filter(closed).select(
        "source_id", "stream_id", F.date_format("_day", "yyyy-MM-dd").alias("archive_date")
    )


def days_due(streams: DataFrame, ticks: DataFrame, captures: DataFrame, digests: DataFrame, summaries: DataFrame,
             now: Column, close_delay_s: int = K.CLOSE_DELAY_S) -> DataFrame:
    """The days of :func:`days_to_compact`, from digests: a day is due where its captures' digest is not that of its
    latest revision's inputs. No list of inputs is read. ``digests`` has one row for every revision."""
    day = list(DAY)
    ticked = ticks.select(*DAY).distinct()
    captured = captures.groupBy(*DAY).agg(L.captures_digest(F.col("capture_id")).alias("_digest"))
    latest = L.latest_revision(digests).select(*DAY, "revision", "inputs_digest")
    due = candidate_days(streams, ticks, now, close_delay_s).join(ticked, day, "left_semi")
    due = L.without_summary(due, summaries).join(captured, day, "left").join(latest, day, "left")
    differs = F.coalesce("_digest", F.lit(L.NO_CAPTURES)) != F.col("inputs_digest")
    return due.filter(F.col("revision").isNull() | differs).select(
        *DAY, (F.coalesce("revision", F.lit(0)) + 1).cast("int").alias("revision"))


def days_to_compact(streams: DataFrame, ticks: DataFrame, captures: DataFrame, compactions: DataFrame,
                    inputs: DataFrame, summaries: DataFrame, now: Column,
                    close_delay_s: int = K.CLOSE_DELAY_S) -> DataFrame:
    """Closed, not summarised, at least one tick, and either never compacted or
    compacted from other captures than there are now. One plan for all streams;
    ``revision`` is the number to write. ``ticks`` carry ``archive_date``."""
    day = list(DAY)
    ticked = ticks.groupBy(*DAY).agg(F.count(F.lit(1)).alias("_ticks"))
    captured = captures.groupBy(*DAY).agg(F.count(F.lit(1)).alias("_captures"))
    latest = L.latest_revision(compactions).select(*DAY, "revision", F.col("rows").alias("_rows"))
    missing = (
        L.missing_from_latest(captures.select(*DAY, "capture_id"), inputs, compactions)
        .groupBy(*DAY).agg(F.count(F.lit(1)).alias("_missing"))
    )
    due = (
        candidate_days(streams, ticks, now, close_delay_s)
        .join(ticked, day)
        .join(captured, day, "left")
        .join(latest, day, "left")
        .join(missing, day, "left")
    )
    due = L.without_summary(due, summaries)
    changed = (
        F.col("revision").isNull()
        | (F.col("_rows") != F.coalesce("_captures", F.lit(0)))
        | F.col("_missing").isNotNull()
    )
    return due.filter(changed).select(
        *DAY, (F.coalesce("revision", F.lit(0)) + 1).cast("int").alias("revision")
    )
