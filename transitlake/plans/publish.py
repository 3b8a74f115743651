"""Publish revisions to a destination, and the state machine around it."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.paths import publish_error, publish_path
from transitlake.functions.policy import next_attempt_at, retry_status
from transitlake.functions.urls import sanitize_url
from transitlake.operators import ledger as L
from transitlake.operators.ledger import REVISION
from transitlake.plans.verify import verify_revisions
from transitlake.session import located
from transitlake.sources import revisions as R

_CHUNK = 4 << 20
COPY_RESULT = "source string, target string, expected string, actual string, bytes bigint, status string"


def with_publish_path(work: DataFrame, streams: DataFrame) -> DataFrame:
    """Due publications with ``remote_path``, or the category they fail with.

    A manifest without URL falls back to its stream's configured one.
    """
    configured = streams.select("source_id", "stream_id", F.col("url").alias("_configured"))
    joined = work.join(configured, ["source_id", "stream_id"], "left")
    url = F.coalesce(F.nullif(F.col("sanitized_url"), F.lit("")), sanitize_url(F.col("_configured")))
    kind, date, revision = F.col("expected_kind"), F.col("archive_date"), F.col("revision")
    path = publish_path(kind, date, revision, url, F.col("remote"))
    error = publish_error(kind, date, revision, url, F.col("_configured").isNotNull())
    return joined.withColumns({
        "error_category": F.coalesce(F.col("error_category"), error),
        "remote_path": F.when(F.coalesce(F.col("error_category"), error).isNull(), path),
    }).drop("_configured")


def _copy_one(source: str, target: str, expected: str) -> tuple[str, int, str]:
    """Copy a file, then read the copy back; the caller's row says how it went.

    An existing copy with the same hash is left alone and one with another hash is
    never overwritten. A retried task finds its own finished work, and an unfinished
    one lies under a temporary name.
    """
    from pyarrow import fs

    source_fs, source_path = located(source)
    target_fs, target_path = located(target)

    def digest(path: str) -> tuple[str, int]:
        hashed, size = hashlib.sha256(), 0
        with target_fs.open_input_stream(path, compression=None) as stream:
            while chunk := stream.read(_CHUNK):
                hashed.update(chunk)
                size += len(chunk)
        return hashed.hexdigest(), size

    if target_fs.get_file_info(target_path).type != fs.FileType.NotFound:
        actual, size = digest(target_path)
        return actual, size, "verified" if actual == expected else "remote_integrity"
    parent = target_path.rsplit("/", 1)[0]
    target_fs.create_dir(parent, recursive=True)
    partial = f"{parent}/.{uuid.uuid4().hex}.partial"
    with source_fs.open_input_stream(source_path, compression=None) as reader, \
            target_fs.open_output_stream(partial, compression=None) as writer:
        while chunk := reader.read(_CHUNK):
            writer.write(chunk)
    actual, size = digest(partial)
    if actual != expected:
        target_fs.delete_file(partial)
        return actual, size, "local_integrity"
    target_fs.move(partial, target_path)
    return actual, size, "verified"


def _copy_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for source, target, expected in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
            try:
                outcome = _copy_one(source, target, expected)
            except FileNotFoundError:
                outcome = (None, None, "local_integrity")
            except PermissionError:
                outcome = (None, None, "permission")
            except OSError:
                outcome = (None, None, "network")
            rows.append((source, target, expected, *outcome))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = [pa.string()] * 4 + [pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["source", "target", "expected", "actual", "bytes", "status"])


def copy_files(files: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Copy (source, target, sha256) rows; each file is streamed once by one task.

    Files are spread by their target, whatever revision they belong to, over a fixed
    number of tasks: the rows are tiny, so adaptive execution would otherwise put all
    copies into one. The result must be written before it is used twice.
    """
    tasks = parallelism or 4 * files.sparkSession.sparkContext.defaultParallelism
    spread = files.select("source", "target", "sha256").repartition(tasks, "target")
    return spread.mapInArrow(_copy_batches, COPY_RESULT)


def published_files(work: DataFrame, files: DataFrame, name: Column) -> DataFrame:
    """Copy list of due publications. ``files``: revision, path and sha256 of each file;
    ``name`` is what it is called at the destination."""
    sources = files.select(*REVISION, F.col("path").alias("source"), name.alias("_name"), "sha256")
    due = work.filter(F.col("remote_path").isNotNull()).select("publication_id", *REVISION, "remote_path")
    return due.join(sources, list(REVISION)).select(
        "publication_id", "source", F.concat_ws("/", "remote_path", "_name").alias("target"), "sha256")


def copy_outcomes(wanted: DataFrame, copied: DataFrame) -> DataFrame:
    """Per publication: all files verified, or the category of a failed one."""
    joined = wanted.join(copied.select("target", "status"), "target", "left")
    failed = F.coalesce(F.col("status"), F.lit("network"))
    return joined.groupBy("publication_id").agg(
        F.min(F.when(failed != "verified", failed)).alias("failed_with"))


def attempt_outcomes(work: DataFrame, outcomes: DataFrame, now: Column, jitter: Column) -> DataFrame:
    """Publication change rows after one attempt: verified, retry or permanent failure."""
    joined = work.join(outcomes, "publication_id", "left")
    category = F.coalesce(F.col("error_category"), F.col("failed_with"))
    good = category.isNull()
    return joined.select(
        "publication_id", "compaction_id", "destination_id", "required",
        F.when(good, F.lit("verified")).otherwise(retry_status(category)).alias("status"),
        # an attempt counts once its path is known and the copy has begun
        (F.col("attempt_count") + F.col("remote_path").isNotNull().cast("int")).alias("attempt_count"),
        F.when(good, now).otherwise(next_attempt_at(category, F.col("attempt_count") + 1, now, jitter)).alias("next_attempt_at"),
        F.coalesce(category, F.lit("")).alias("last_error"),
        F.coalesce("remote_path", F.lit("")).alias("remote_path"),
        F.when(good, now).alias("completed_at"),
    )


def gate(publications: DataFrame) -> DataFrame:
    """Revisions with no required publication outside verified and retired."""
    open_required = F.col("required") & ~F.col("status").isin(*K.PUBLICATION_DONE)
    return publications.groupBy("compaction_id").agg((F.count_if(open_required) == 0).alias("released"))


def release(compactions: DataFrame, publications: DataFrame, verified: DataFrame, now: Column) -> DataFrame:
    """Revision change rows after ``verified`` publications (compaction_id): published
    and stamped now, also when only an optional publication was verified."""
    passed = gate(publications).filter("released").join(verified.select("compaction_id"), "compaction_id", "left_semi")
    return compactions.join(passed.select("compaction_id"), "compaction_id", "left_semi").withColumns({
        "status": F.lit("published"), "published_at": now})


def publication_id(destination: Column) -> Column:
    """A stable 63-bit id of a revision's (``compaction_id``) publication."""
    return F.shiftrightunsigned(F.xxhash64(F.col("compaction_id"), destination), 1)


def backfill(compactions: DataFrame, publications: DataFrame, destination: str, now: Column) -> DataFrame:
    """Queue a destination, as optional, for every revision that still has files."""
    queued = publications.filter(F.col("destination_id") == destination).select("compaction_id")
    missing = compactions.filter("manifest_path <> ''").join(queued, "compaction_id", "left_anti")
    return missing.select(
        publication_id(F.lit(destination)).alias("publication_id"),
        "compaction_id", F.lit(destination).alias("destination_id"), F.lit(False).alias("required"),
        F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), now.alias("next_attempt_at"),
        F.lit("").alias("last_error"), F.lit("").alias("remote_path"),
        F.lit(None).cast("timestamp").alias("completed_at"))


def retire_publications(publications: DataFrame, destination: str, reason: str, now: Column) -> DataFrame:
    """Change rows that retire what a destination still owes as required."""
    owed = publications.filter(
        (F.col("destination_id") == destination) & F.col("required") & ~F.col("status").isin(*K.PUBLICATION_DONE))
    return owed.withColumns({
        "status": F.lit("retired"), "last_error": F.lit(f"retired: {reason}"), "completed_at": now,
        "next_attempt_at": now})


def release_retired(compactions: DataFrame, publications: DataFrame, destination: str, now: Column) -> DataFrame:
    """Unpublished revisions that the retirement of a destination lets go.

    ``publications`` is the state after the retirement; a revision already published
    keeps its time.
    """
    retired = publications.filter((F.col("destination_id") == destination) & (F.col("status") == "retired"))
    blocked = publications.filter(F.col("required") & ~F.col("status").isin(*K.PUBLICATION_DONE))
    return (
        compactions.filter(F.col("published_at").isNull())
        .join(retired.select("compaction_id"), "compaction_id", "left_semi")
        .join(blocked.select("compaction_id"), "compaction_id", "left_anti")
        .withColumns({"status": F.lit("published"), "published_at": now})
    )


def retirement_audit(spark_now: DataFrame, destination: str, reason: str) -> DataFrame:
    """One audit row; ``spark_now`` is a one-row frame holding ``created_at``."""
    return spark_now.select(
        F.lit("retire_destination").alias("action"), F.lit(destination).alias("target"),
        F.lit(reason).alias("reason"), "created_at")


def apply_changes(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """State with changed rows in place of the old ones."""
    changed = changes.select(*state.columns)
    return state.join(changed.select(key), key, "left_anti").unionByName(changed)


def _refuse_unsound(spark: SparkSession, root: str, work: DataFrame, compactions: DataFrame,
                    manifests: DataFrame) -> DataFrame:
    """Due publications, those of revisions that do not verify marked local_integrity."""
    due = _in_hand(work)
    tables = (manifests, compactions, R.scan_inputs(spark, root, due), R.scan_files(spark, root, due),
              R.scan_parts(spark, root, due).drop("path"))
    unsound = verify_revisions(*[R.of_days(t, due) for t in tables]).select(*REVISION).distinct()
    marked = work.join(unsound.withColumn("_unsound", F.lit("local_integrity")), list(REVISION), "left")
    return marked.withColumns({
        "error_category": F.coalesce("error_category", "_unsound"),
        "remote_path": F.when(F.col("_unsound").isNull(), F.col("remote_path")),
    }).select(*work.columns)


def _in_hand(work: DataFrame) -> DataFrame:
    return work.filter(F.col("remote_path").isNotNull()).select(*REVISION).distinct()


def publish_due(spark: SparkSession, root: str, publications: DataFrame, compactions: DataFrame,
                manifests: DataFrame, destinations: DataFrame, streams: DataFrame, now: Column,
                jitter: Column, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """One round over the due publications; returns their change rows.

    A revision that no longer verifies is not copied at all. All artifacts are copied before any manifest, and a manifest follows only where
    every artifact of its publication is verified. Copies are recorded in a table
    before they are looked at, so nothing is copied twice. ``keep`` stores a step's table under its name, and
    gives back what an earlier attempt stored.
    """
    keep = keep or (lambda step, rows: R.materialize(rows, root, step))
    work = with_publish_path(
        L.publication_work(L.publication_queue(publications, now), destinations, compactions, manifests), streams)
    work = keep("publications", work)
    work = keep("sound", _refuse_unsound(spark, root, work, compactions, manifests))
    sound = _in_hand(work)
    parts = R.of_days(R.scan_parts(spark, root, sound), sound).select(*REVISION, "relative_path", "path")
    artifacts = R.of_days(R.scan_files(spark, root, sound), sound).join(parts, [*REVISION, "relative_path"])
    wanted = keep("artifacts", published_files(work, artifacts, F.col("relative_path")))
    copied = keep("copied", copy_files(wanted))
    first = copy_outcomes(wanted, copied)

    ready = work.join(first.filter(F.col("failed_with").isNotNull()), "publication_id", "left_anti")
    complete = _in_hand(ready)
    documents = R.of_days(R.scan_documents(spark, root, complete), complete)
    listed = keep("documents", published_files(ready, documents, F.lit("manifest.json")))
    confirmed = keep("confirmed", copy_files(listed))
    second = copy_outcomes(listed, confirmed)
    outcomes = first.filter(F.col("failed_with").isNotNull()).unionByName(second)
    unseen = work.filter(F.col("remote_path").isNotNull()).join(outcomes, "publication_id", "left_anti") \
        .select("publication_id", F.lit("local_integrity").alias("failed_with"))
    return keep("attempts", attempt_outcomes(work, outcomes.unionByName(unseen), now, jitter))
