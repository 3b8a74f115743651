"""The fixed-rate poll grid, its coverage, and a hysteresis flag on a metric."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.functions.policy import stable_phase_ns
from transitlake.operators.slices import FENCE_EVERY, with_cuts

_HOUR_US = 3_600_000_000


def with_phase(streams: DataFrame) -> DataFrame:
    """Stream dimension with the stable phase of each stream, in microseconds."""
    key = F.concat_ws("/", "source_id", "stream_id")
    phase = stable_phase_ns(key, F.col("interval_ms") * 1000000)
    return streams.withColumn("phase_us", F.floor(phase / 1000).cast("bigint"))


def tick_grid(streams: DataFrame, after: Column, until: Column) -> DataFrame:
    """Expected tick instants in (after, until]: phase plus a whole number of intervals.

    Hours are laid out first and ticks within an hour second, so that no array grows
    with the time range, and the hours spread over the cluster.
    """
    us, interval = F.unix_micros, F.col("_interval")
    first = F.floor(us(after) / _HOUR_US)
    last = F.floor(us(until) / _HOUR_US)
    hours = (
        streams.select("source_id", "stream_id", "phase_us",
                       (F.col("interval_ms") * 1000).alias("_interval"),
                       us(after).alias("_after"), us(until).alias("_until"),
                       F.explode(F.sequence(first, last)).alias("_hour"))
        .withColumn("_from", F.greatest(F.col("_hour") * _HOUR_US - 1, F.col("_after")))
        .withColumn("_to", F.least((F.col("_hour") + 1) * _HOUR_US - 1, F.col("_until")))
    )
    low = F.floor((F.col("_from") - F.col("phase_us")) / interval) + 1
    high = F.floor((F.col("_to") - F.col("phase_us")) / interval)
    numbered = hours.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
    return (
        numbered.select("source_id", "stream_id", "phase_us", "_interval",
                        F.explode(F.sequence("_low", "_high")).alias("tick_number"))
        .select("source_id", "stream_id", "tick_number",
                F.timestamp_micros(F.col("phase_us") + F.col("tick_number") * interval).alias("scheduled_at"))
    )


def missed_ticks(grid: DataFrame, ticks: DataFrame) -> DataFrame:
    """Expected ticks nobody recorded."""
    recorded = ticks.select("source_id", "stream_id", "scheduled_at")
    return grid.join(recorded, ["source_id", "stream_id", "scheduled_at"], "left_anti")


def hysteresis(df: DataFrame, value: str, series: tuple[str, ...], order: tuple[str, ...],
               high: float, low: float, instant: str, slice_seconds: int = 3600, every: int = FENCE_EVERY) -> DataFrame:
    """``paused``: set at or above ``high``, cleared at or below ``low``, otherwise held.

    A held value may reach back any distance. Time slices, cut further where many rows lie in one, are
    windowed on their own; the last signal of every slice is carried over a small window of slices
    and joined back, so neither a long series nor a crowded second is sorted by one task.
    """
    signal = F.when(F.col(value) >= high, F.lit(True)).when(F.col(value) <= low, F.lit(False))
    marked = df.withColumn("_slice", F.floor(F.unix_seconds(F.col(instant).cast("timestamp")) / slice_seconds)) \
               .withColumn("_signal", signal)
    marked = with_cuts(marked, series, "_slice", order, every)
    position = F.when(F.col("_signal").isNotNull(), F.struct(*order))
    ends = marked.groupBy(*series, "_slice", "_cut").agg(F.max_by("_signal", position).alias("_end"))
    before = Window.partitionBy(*series).orderBy("_slice", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*series, "_slice", "_cut", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    running = Window.partitionBy(*series, "_slice", "_cut").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        marked.withColumn("_held", F.last("_signal", ignorenulls=True).over(running))
        .join(carried, [*series, "_slice", "_cut"])
        .withColumn("paused", F.coalesce("_held", "_carried", F.lit(False)))
        .drop("_slice", "_cut", "_signal", "_held", "_carried")
    )
