"""Arriving bodies: decoded once, kept with their facts in a columnar bronze table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitlake.functions.bodies import body_sha256
from transitlake.operators.decode import decode_bodies, header_metadata
from transitlake.schemas import ENTITY_KIND_MESSAGE
from transitlake.session import light_logs

BRONZE = ("source", "stream", "date", "hour", "raw_path", "body", "body_bytes", "body_sha256", "parse_status",
          "parse_error", "feed_version", "incrementality", "feed_timestamp", "entity_count")
PARTITIONS = ("source", "stream", "date")


def decode_arrivals(bodies: DataFrame) -> DataFrame:
    """Facts of every arriving body; a malformed one is kept with its status.

    Works on a stream and on a batch alike. The body stays: this table replaces the
    many small files as the input of later jobs.
    """
    hashed = bodies.withColumn("body_sha256", body_sha256(F.col("body")))
    decoded = header_metadata(decode_bodies(hashed, wanted=ENTITY_KIND_MESSAGE))
    # a document whose body is not there: nothing was decoded, and nothing empty either
    gone = F.col("body_bytes").isNull()
    return decoded.withColumns({
        "parse_status": F.when(gone, F.lit("missing_body")).otherwise(F.col("parse_status")),
        "parse_error": F.when(gone, F.lit("no file at the document's path")).otherwise(F.col("parse_error")),
    }).select(*BRONZE)


def start_bronze(bodies: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Decode arrivals into the table at ``path``; bodies of one day that arrive in one batch share a file, unless they are
    more than a task should have.

    Opening a file costs more than a small body does, and every file has an entry in the table's log. A small batch is written by one task:
    starting more takes longer than the writing.
    """
    light_logs(bodies.sparkSession, checkpoint)
    tasks = 2 * bodies.sparkSession.sparkContext.defaultParallelism
    return (
        decode_arrivals(bodies).hint("rebalance", tasks, *map(F.col, PARTITIONS)).writeStream.format("parquet").outputMode("append")
        .partitionBy(*PARTITIONS)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
