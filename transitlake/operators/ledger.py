"""Relational operators over the ledger tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.operators.statistics import DAY

REVISION = (*DAY, "revision")


# --- lookups and order --------------------------------------------------------

def scan_day(captures: DataFrame, source: str, stream: str, date: str) -> DataFrame:
    """One stream-day in capture order."""
    day = captures.filter(
        (F.col("source_id") == source) & (F.col("stream_id") == stream) & (F.col("archive_date") == date)
    )
    return day.orderBy("scheduled_at", "capture_id")


def capture_exists(captures: DataFrame, capture_id: str) -> bool:
    return not captures.filter(F.col("capture_id") == capture_id).select("capture_id").limit(1).isEmpty()


def compaction_by_id(compactions: DataFrame, compaction_id: int) -> DataFrame:
    return compactions.filter(F.col("compaction_id") == compaction_id).limit(1)


def compaction_for_revision(compactions: DataFrame, source: str, stream: str, date: str,
                            revision: int) -> DataFrame:
    return compactions.filter(
        (F.col("source_id") == source) & (F.col("stream_id") == stream)
        & (F.col("archive_date") == date) & (F.col("revision") == revision)
    ).limit(1)


def live_captures(captures: DataFrame) -> DataFrame:
    """Captures whose files should still exist."""
    return captures.filter(~F.col("raw_path").startswith(K.RETAINED_PREFIX))


def jobs_in_order(days: DataFrame) -> DataFrame:
    return days.orderBy("archive_date", "source_id", "stream_id")


def publication_queue(publications: DataFrame, now: Column, destination: str | None = None) -> DataFrame:
    """Publications that are due, oldest first."""
    due = publications.filter(F.col("status").isin(*K.PUBLICATION_OPEN) & (F.col("next_attempt_at") <= now))
    if destination is not None:
        due = due.filter(F.col("destination_id") == destination)
    return due.orderBy("next_attempt_at", "publication_id")


# --- latest state and revisions -----------------------------------------------

def latest_by(df: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key. The limit runs before the shuffle as well, so a key
    with very many rows sends one row per task."""
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def latest_revision(compactions: DataFrame) -> DataFrame:
    return latest_by(compactions, DAY, "revision")


# What a later change of a tick may not alter.
TICK_IDENTITY = ("source_id", "stream_id", "scheduled_at", "config_fingerprint")


def upsert_ticks(changes: DataFrame, sequence: str = "change_seq") -> DataFrame:
    """Current ticks from change rows: identity of the first, outcome of the last."""
    outcome = [c for c in changes.columns if c not in ("tick_id", sequence, *TICK_IDENTITY)]
    first = F.min_by(F.struct(*TICK_IDENTITY), sequence).alias("_first")
    last = F.max_by(F.struct(*outcome), sequence).alias("_last")
    merged = changes.groupBy("tick_id").agg(first, last)
    order = [c for c in changes.columns if c != sequence]
    return merged.select("tick_id", "_first.*", "_last.*").select(*order)


def next_revision(days: DataFrame, compactions: DataFrame) -> DataFrame:
    """Stream-days with the number their next revision will have."""
    highest = compactions.groupBy(*DAY).agg(F.max("revision").alias("_highest"))
    return (
        days.join(highest, list(DAY), "left")
        .withColumn("revision", (F.coalesce("_highest", F.lit(0)) + 1).cast("int"))
        .drop("_highest")
    )


def predecessor(compactions: DataFrame) -> DataFrame:
    """Revisions are dense, so the predecessor needs no window."""
    number = F.col("revision")
    return compactions.withColumn("predecessor_revision", F.when(number > 1, number - 1))


# --- joins --------------------------------------------------------------------

def capture_revisions(captures: DataFrame, inputs: DataFrame, compactions: DataFrame) -> DataFrame:
    """Each capture with every revision it went into."""
    revisions = compactions.select("compaction_id", "revision", "published_at")
    return captures.join(inputs, "capture_id").join(revisions, "compaction_id")


def missing_from_latest(captures: DataFrame, inputs: DataFrame, compactions: DataFrame) -> DataFrame:
    """Captures of a compacted day that its latest revision does not contain."""
    latest = latest_revision(compactions).select(*DAY, "compaction_id")
    return captures.join(latest, list(DAY)).join(inputs, ["compaction_id", "capture_id"], "left_anti")


def captures_digest(capture_id: Column) -> Column:
    """An aggregate that names a set of captures whatever its order: count, xor and sum of hashes of the ids.

    The sum takes 32 bits of a hash of its own, so it cannot overflow below two thousand million captures.
    """
    second = F.xxhash64(F.lit("sum"), capture_id).bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))
    parts = (F.count(capture_id), F.coalesce(F.bit_xor(F.xxhash64(capture_id)), F.lit(0)), F.coalesce(F.sum(second), F.lit(0)))
    return F.concat_ws(":", *[p.cast("string") for p in parts])


NO_CAPTURES = "0:0:0"


def revision_digests(compactions: DataFrame, inputs: DataFrame) -> DataFrame:
    """Each revision with the digest of its inputs (``compaction_id``, ``capture_id``)."""
    digests = inputs.groupBy("compaction_id").agg(captures_digest(F.col("capture_id")).alias("_digest"))
    return compactions.select("compaction_id", *REVISION).join(digests, "compaction_id", "left").select(
        "compaction_id", *REVISION, F.coalesce("_digest", F.lit(NO_CAPTURES)).alias("inputs_digest"))


def without_summary(days: DataFrame, summaries: DataFrame) -> DataFrame:
    return days.join(summaries.select(*DAY), list(DAY), "left_anti")


def compare_inputs(manifest_inputs: DataFrame, captures: DataFrame) -> DataFrame:
    """Inputs named by manifests that the ledger lacks or knows with another hash."""
    known = captures.select(F.col("capture_id").alias("id"), F.col("body_sha256").alias("_known"))
    problem = F.when(F.col("_known").isNull(), F.lit("input_missing")) \
        .when(F.col("_known") != F.col("sha256"), F.lit("input_hash_mismatch"))
    joined = manifest_inputs.join(known, "id", "left").withColumn("violation", problem).drop("_known")
    return joined.filter(F.col("violation").isNotNull())


def split_adoption(manifests: DataFrame, compactions: DataFrame) -> DataFrame:
    """Manifests with ``action``: verify those the ledger knows, adopt the others."""
    known = compactions.select(*REVISION, "compaction_id")
    joined = manifests.join(known, list(REVISION), "left")
    return joined.withColumn(
        "action", F.when(F.col("compaction_id").isNull(), F.lit("adopt")).otherwise(F.lit("verify"))
    )


def select_streams(df: DataFrame, streams: DataFrame) -> DataFrame:
    """Rows of configured streams, with the stream's columns. The dimension's size
    is left to the engine's own broadcast threshold."""
    extra = [c for c in streams.columns if c not in df.columns or c in ("source_id", "stream_id")]
    return df.join(streams.select(*extra), ["source_id", "stream_id"])


def publication_work(queue: DataFrame, destinations: DataFrame, compactions: DataFrame,
                     manifests: DataFrame) -> DataFrame:
    """Due publications with destination, revision and manifest; an unknown
    destination becomes a retry."""
    targets = destinations.select(F.col("id").alias("destination_id"), F.col("remote"))
    revisions = compactions.select("compaction_id", *REVISION, "directory")
    facts = manifests.select(*REVISION, "expected_kind", "sanitized_url")
    work = (
        queue.join(targets, "destination_id", "left")
        .join(revisions, "compaction_id", "left")
        .join(facts, list(REVISION), "left")
    )
    problem = F.when(F.col("remote").isNull(), F.lit("destination_not_configured")) \
        .when(F.col("expected_kind").isNull(), F.lit("local_integrity"))
    return work.withColumn("error_category", problem)


def adopt_rows(ledger: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Ledger rows plus the found rows it does not have yet."""
    return ledger.unionByName(found.join(ledger.select(key), key, "left_anti").select(*ledger.columns))


def same_required(df: DataFrame) -> DataFrame:
    """Does the destination snapshot name the same required ids as the list?"""
    snapshot = F.transform(F.filter("destinations", lambda d: d["required"]), lambda d: d["id"])
    expected = F.coalesce("required_destinations", F.array().cast("array<string>"))
    return df.withColumn("same_required", F.array_sort(snapshot) == F.array_sort(expected))


def destination_snapshot(destinations: DataFrame) -> DataFrame:
    """One row: all destinations, and the required ids, both sorted. The destination
    list is configuration, a handful of rows."""
    entry = F.struct("id", "required")
    return destinations.agg(
        F.array_sort(F.collect_list(F.when(F.col("required"), F.col("id")))).alias("required_destinations"),
        F.array_sort(F.collect_list(entry)).alias("destinations"),
    )


def ledger_status(ticks: DataFrame, captures: DataFrame, compactions: DataFrame,
                  publications: DataFrame, summaries: DataFrame) -> DataFrame:
    """Eight counters in one row. Each table is counted on its own and the counts
    are added up; no table is joined to another."""
    def counts(df: DataFrame, **columns: Column) -> DataFrame:
        return df.agg(*[F.count_if(test).alias(name) for name, test in columns.items()])

    status, every = F.col("status"), F.lit(True)
    parts = [
        counts(ticks, ticks=every),
        counts(captures, captures=every),
        counts(compactions, compactions=every),
        counts(
            publications,
            pending_publications=status.isin("pending", "uploading"),
            failed_publications=status.isin("retry", "permanent_failure"),
            verified_publications=status == "verified",
            retired_publications=status == "retired",
        ),
        counts(summaries, summarized_days=every),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.agg(*[F.max(name).alias(name) for name in union.columns])
