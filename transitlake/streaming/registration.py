"""Captures as they arrive: registered once, and late ones open a new revision."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transitlake.operators.ledger import latest_revision, revision_digests
from transitlake.operators.statistics import DAY
from transitlake.plans import jobs
from transitlake.plans.compact import CompactionResult, ledger_id
from transitlake.schemas import CAPTURE, COMPACTION
from transitlake.sources.ledger import Ledger


def register(ledger: Ledger, batch: DataFrame, seq: int) -> DataFrame:
    """Append the captures the ledger does not know; returns the rows of this batch.

    However late a capture is, it is registered: repeats are told by the ledger, not by a
    watermark. Only the days of the batch are looked at. The rows carry the batch's change number, so
    a batch that is run again after a failure finds its own rows and adds none.
    """
    known = ledger.changes("captures", batch).select("capture_id")
    fresh = batch.dropDuplicates(["capture_id"]).join(known, "capture_id", "left_anti").select(*CAPTURE.names)
    ledger.append("captures", fresh, seq)
    mine = ledger.changes("captures", batch).filter(F.col("change_seq") == seq)
    return mine.select(*CAPTURE.names)


def touched_days(captures: DataFrame, arrived: DataFrame, compactions: DataFrame) -> DataFrame:
    """Stream-days that new captures belong to, with the revision they now need."""
    days = arrived.select(*DAY).distinct()
    latest = latest_revision(compactions).select(*DAY, F.col("revision").alias("_latest"))
    totals = captures.join(days, list(DAY), "left_semi").groupBy(*DAY).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("entity_count"), F.lit(0)).cast("bigint").alias("entities"))
    return totals.join(latest, list(DAY), "left").select(
        *DAY, (F.coalesce("_latest", F.lit(0)) + 1).cast("int").alias("revision"), "rows", "entities")


def stream_of(batch: DataFrame) -> str:
    """The id of the stream a batch comes from: it lasts as long as the stream's checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batches"


def revise_late_days(ledger: Ledger, created_at: Column,
                     compact: Callable[[DataFrame], CompactionResult | None] | None = None,
                     destinations: DataFrame | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: register a batch, then open revisions of its days.

    Before anything else a batch claims a number of the ledger's one sequence, by its stream's id and its
    own. So streams, restarts with a new checkpoint and jobs never share numbers, later changes
    have higher ones, and a batch that is run again knows its own rows by its number: revisions it has
    recorded are left alone, and all others' count for the next revision.

    ``compact`` writes the data of the days it is given. What it returns is what the ledger
    gets: its revisions with their paths and hashes, their inputs, and a publication for each
    of ``destinations``; a day it refused gets no row. Without ``compact``, or where it only
    takes note of the days, rows without data are made, for a ledger kept elsewhere.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        seq = ledger.claim(f"stream {stream_of(batch)}", batch_id)
        arrived = register(ledger, batch, seq)
        captures = ledger.current("captures", arrived)
        recorded = ledger.changes("compactions", arrived)
        mine = recorded.filter(F.col("change_seq") == seq).select(*DAY).distinct()
        others = ledger.current("compactions", arrived).join(mine, list(DAY), "left_anti")
        days = touched_days(captures, arrived.join(mine, list(DAY), "left_anti"), others)
        result = None if compact is None else compact(days)
        if result is not None:
            jobs.record_compaction(ledger, result, destinations, created_at, seq)
            return
        values = {"compaction_id": ledger_id(), "format_version": F.lit(1), "status": F.lit("ready"), "created_at": created_at}
        rows = days.withColumns(values)
        columns = [F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in COMPACTION.fields]
        # inputs first: a revision is never in the ledger without them, and repeats of a
        # batch that failed in between have the same keys
        inputs = captures.join(rows.select(*DAY, "compaction_id"), list(DAY)).select("compaction_id", "capture_id")
        ledger.append("compaction_inputs", inputs, seq)
        ledger.append("revision_digests", revision_digests(rows, inputs), seq)
        ledger.append("compactions", rows.select(*columns), seq)

    return run


def start(captures: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return (
        captures.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
