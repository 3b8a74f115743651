"""Running counters and gauges, in update mode, upserted into a table of change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitlake.operators.ledger import latest_by


def start_counters(counters: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``counters``: a streaming aggregate such as those of the metrics operators."""

    def append(batch: DataFrame, batch_id: int) -> None:
        # a batch that runs again replaces its own rows
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")) \
            .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        counters.writeStream.outputMode("update").foreachBatch(append)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def current_counters(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest value of every counter."""
    return latest_by(changes, keys, "batch_id").drop("batch_id")
