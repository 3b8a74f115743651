"""Statistics of ticks as they come in, in windows that close.

Windows are a quarter hour of UTC: every zone's offset is a multiple of it, so they
nest in local days, and a watermark on UTC closes no zone early. Ticks later than
the watermark are not lost to the lake: they reach the day through a new revision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.calendar import local_date_text
from transitlake.operators.statistics import tick_counters

WINDOW = "15 minutes"


def tick_windows(ticks: DataFrame, delay_s: int = K.CLOSE_DELAY_S) -> DataFrame:
    """Counters per stream and window, emitted once when the window has closed."""
    counted = (
        ticks.withWatermark("scheduled_at", f"{delay_s} seconds")
        .groupBy("source_id", "stream_id", F.window("scheduled_at", WINDOW).alias("w"))
        .agg(*tick_counters())
    )
    return counted.select("source_id", "stream_id", F.col("w.start").alias("window_start"),
                          "scheduled_ticks", "skipped_ticks", "http_failures", "network_failures")


def roll_up_days(windows: DataFrame, streams: DataFrame) -> DataFrame:
    """Closed windows summed to local days."""
    zoned = windows.join(streams.select("source_id", "stream_id", "timezone"), ["source_id", "stream_id"])
    day = local_date_text(F.col("window_start"), F.col("timezone"))
    names = ("scheduled_ticks", "skipped_ticks", "http_failures", "network_failures")
    return zoned.groupBy("source_id", "stream_id", day.alias("archive_date")).agg(
        *[F.sum(n).alias(n) for n in names])
