"""Compaction: captures and bodies to immutable daily revisions.

Bodies meet their captures on the unique path, where no key is hot. The rows are
then rebalanced by stream-day before decoding: bodies are several times smaller
than what they decode to, adaptive execution cuts a large stream-day into files of
the advisory size and packs small ones together, and order inside a file is made by
one sort of the flattened rows that also serves the partitioned writer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.functions.bodies import body_sha256
from transitlake.functions.paths import revision_directory, schema_version
from transitlake.operators.decode import decode_bodies
from transitlake.operators.flatten import (
    flatten_trip_updates, projected_rows, stop_time_updates,
)
from transitlake.operators.ledger import REVISION
from transitlake.operators.project import nested_rows
from transitlake.operators.statistics import DAY
from transitlake.plans import manifest as M
from transitlake.schemas import FEED_MESSAGE, TRIP_UPDATE_MESSAGE
from transitlake.session import split_bytes
from transitlake.sources import revisions as R
from transitlake.sources.footers import provenance_of


# Bytes of decoded or flattened captures that one task reads: about a part. A stop takes few bytes there and many in
# memory, and the tasks that flatten sort their rows.
DECODED_SPLIT = 8 << 20


def day_captures(captures: DataFrame, days: DataFrame, flattened: bool) -> DataFrame:
    """Captures of the selected days of one layout, with their revision number."""
    version = schema_version(F.col("expected_kind"))
    layout = version == (2 if flattened else 1)
    return captures.filter(layout).join(days.select(*REVISION), list(DAY))


def with_bodies(captures: DataFrame, bodies: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Join on the body's path. ``bodies``: raw_path, body; see :func:`bodies_of_days`. A
    capture that recorded no byte has an empty body, which file scans do not show."""
    empty = F.when(F.col("decoded_length") == 0, F.lit(b""))
    joined = captures.join(bodies.select("raw_path", F.col("body").alias("_body")), "raw_path", "left") \
        .withColumn("body", F.coalesce("_body", empty)).drop("_body")
    return joined if keep_missing else joined.filter(F.col("body").isNotNull())


def bodies_of_days(bodies: DataFrame, days: DataFrame) -> DataFrame:
    """Bodies of the selected days. Bodies scanned from the landing area carry its partition
    columns: the join on these prunes directories at run time, so other days' bodies are
    neither opened nor shuffled. A frame without these columns is left whole."""
    columns = {"source": "source_id", "stream": "stream_id", "date": "archive_date"}
    if not set(columns) <= set(bodies.columns):
        return bodies
    # the comparison makes the list selective in the optimizer's eyes
    wanted = days.filter("archive_date > ''").select(*[F.col(c).alias(p) for p, c in columns.items()]).distinct()
    return bodies.join(wanted, list(columns), "left_semi")


def _by_day(df: DataFrame) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in REVISION])


def nested_plan(captures: DataFrame, bodies: DataFrame, days: DataFrame) -> DataFrame:
    """Nested rows of all selected days, before the write."""
    rows = _by_day(with_bodies(day_captures(captures, days, flattened=False), bodies))
    return nested_rows(decode_bodies(rows, wanted=FEED_MESSAGE), passthrough=("revision",))


def decoded_captures(captures: DataFrame, bodies: DataFrame, days: DataFrame) -> DataFrame:
    """Flattened captures of all selected days with their decoded messages, and whether a body has the
    recorded hash. A compaction stores this table: rows and counts both come from it, so a
    body is decoded once, and what flattens to no row is still counted."""
    rows = _by_day(with_bodies(day_captures(captures, days, flattened=True), bodies, keep_missing=True))
    rows = rows.withColumn("hash_matches", F.coalesce(body_sha256(F.col("body")) == F.col("body_sha256"), F.lit(False)))
    # in the order of the files, as long as it is bodies that are moved: sorting the flattened rows then finds them in order
    rows = rows.sortWithinPartitions(*REVISION, "scheduled_at", "capture_id")
    return decode_bodies(rows, wanted=TRIP_UPDATE_MESSAGE, keep_body=False)


def flattened_plan(captures: DataFrame, bodies: DataFrame, days: DataFrame) -> DataFrame:
    """Flattened rows of all selected days, before the write."""
    return flatten_trip_updates(decoded_captures(captures, bodies, days), passthrough=("revision",))


def expected_counts(captures: DataFrame, bodies: DataFrame, days: DataFrame) -> DataFrame:
    """What each flattened capture must contribute."""
    return counts_of(decoded_captures(captures, bodies, days))


def counts_of(decoded: DataFrame) -> DataFrame:
    """What each decoded capture must contribute; of a stored table only the lists' lengths are read."""
    return decoded.select(*REVISION, "capture_id", "entity_count", "hash_matches",
                          projected_rows().alias("expected_rows"),
                          stop_time_updates().alias("stop_time_updates"))


def check_flattened(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Content check of flattened revisions: one row per violation."""
    found = written.groupBy(*REVISION, "capture_id").agg(F.count(F.lit(1)).alias("found_rows"))
    return check_placed(found, expected)


def check_placed(found: DataFrame, expected: DataFrame) -> DataFrame:
    """The same check over rows already counted for each capture (``found_rows``)."""
    joined = expected.join(found.select(*REVISION, "capture_id", "found_rows"), [*REVISION, "capture_id"], "full_outer")
    problem = (
        F.when(F.col("expected_rows").isNull(), F.lit("extra_capture"))
        .when(~F.col("hash_matches"), F.lit("body_hash_mismatch"))
        .when(F.coalesce("found_rows", F.lit(0)) != F.col("expected_rows"), F.lit("row_count_mismatch"))
    )
    return joined.withColumn("violation", problem).filter(F.col("violation").isNotNull()) \
        .select(*REVISION, "capture_id", "violation")


def check_parts(placed: DataFrame) -> DataFrame:
    """A capture's rows lie in one part; one violation row for each that does not."""
    return placed.filter("found_parts > 1").select(*REVISION, "capture_id", F.lit("split_capture").alias("violation"))


def check_nested(written: DataFrame, captures: DataFrame) -> DataFrame:
    """Content check of nested revisions: ids, hashes, the stored body, entity counts."""
    rows = written.select(*REVISION, "capture_id", F.col("body_sha256").alias("_hash"),
                          body_sha256(F.col("feed_message_pb")).alias("_body_hash"),
                          F.col("entity_count").alias("_entities"), F.lit(True).alias("_found"))
    known = captures.select(*REVISION, "capture_id", "body_sha256", "entity_count", F.lit(True).alias("_known"))
    joined = known.join(rows, [*REVISION, "capture_id"], "full_outer")
    problem = (
        F.when(F.col("_known").isNull(), F.lit("extra_capture"))
        .when(F.col("_found").isNull(), F.lit("missing_capture"))
        .when(F.col("_hash") != F.col("body_sha256"), F.lit("provenance_mismatch"))
        .when(F.col("_body_hash") != F.col("body_sha256"), F.lit("body_hash_mismatch"))
        .when(~F.col("_entities").eqNullSafe(F.col("entity_count")), F.lit("entity_count_mismatch"))
    )
    return joined.withColumn("violation", problem).filter(F.col("violation").isNotNull()) \
        .select(*REVISION, "capture_id", "violation")


@dataclass(frozen=True)
class CompactionResult:
    """Tables of one run: what was written, its inputs and files, and what was refused."""

    manifests: DataFrame
    inputs: DataFrame
    files: DataFrame
    violations: DataFrame
    compactions: DataFrame


def compact_days(spark: SparkSession, root: str, captures: DataFrame, ticks: DataFrame, bodies: DataFrame,
                 streams: DataFrame, days: DataFrame, destinations: DataFrame, created_at: Column,
                 options: R.WriterOptions | None = None, local_only_cleanup: bool = False,
                 scratch: str | None = None, **versions: str) -> CompactionResult:
    """Write a revision of every selected stream-day; the manifest goes last.

    A day whose content check fails, or whose captures disagree on the URL, gets no
    manifest: readers never see its files, and other days are not held up. Tables between steps
    lie below ``scratch``, by default the root, and the result reads some of them.
    """
    options, scratch = options or R.WriterOptions(), scratch or root
    # the list of days decides everything below, so it is settled once
    days = R.materialize(days.select(*REVISION), scratch, "days")
    bodies = bodies_of_days(bodies, days)
    # statistics and inputs concern these days; their dates prune the ledger's directories
    dated = days.filter("archive_date > ''").select(*DAY)
    captures, ticks = (t.join(dated, list(DAY), "left_semi") for t in (captures, ticks))
    old = R.materialize(R.leftovers(spark, root, days), scratch, "leftovers")
    # the facts of this run and its streams go into every part's footer
    nested_facts, flat_facts = (provenance_of(streams, days, created_at, flattened, **versions) for flattened in (False, True))
    R.write_nested(nested_plan(captures, bodies, days), root, options, nested_facts)
    # Decoding is the dear step. Its table gives the rows and, for the check, the counts; a part of it is
    # read by one task, so the rows need no shuffle on their way to the files.
    decoded = R.materialize(decoded_captures(captures, bodies, days), scratch, "decoded")
    with split_bytes(spark, DECODED_SPLIT):
        R.write_flattened(flatten_trip_updates(decoded, passthrough=("revision",)), root, options, flat_facts)
    counts = R.materialize(counts_of(decoded), scratch, "counts")
    nested, flat = (
        R.of_days(R.scan_written(spark, root, flattened, days), days).join(old, "file_name", "left_anti")
        for flattened in (False, True)
    )
    selected = captures.join(days.select(*REVISION), list(DAY))
    with split_bytes(spark, DECODED_SPLIT):
        placed = R.materialize(R.place_captures(flat), scratch, "placed")
        nested_placed = R.materialize(R.place_captures(nested), scratch, "placed")
    content = check_nested(nested, day_captures(captures, days, flattened=False)) \
        .unionByName(check_placed(placed, counts)) \
        .unionByName(check_parts(placed)).unionByName(check_parts(nested_placed))

    totals = counts.groupBy(*DAY).agg(F.sum("stop_time_updates").alias("stop_time_updates"))
    manifests = R.materialize(M.build_manifests(captures, ticks, streams, days, destinations, created_at,
                                                stop_totals=totals, **versions), scratch, "built")
    # a day whose captures name different URLs is reported as a whole, without a capture
    mismatched = manifests.filter(~F.col("urls_agree")).select(
        *REVISION, F.lit(None).cast("string").alias("capture_id"), F.lit("url_mismatch").alias("violation"))
    violations = R.materialize(content.unionByName(mismatched), scratch, "violations")
    refused = violations.select(*REVISION).distinct()
    accepted = R.materialize(
        manifests.filter("urls_agree").drop("urls_agree").join(refused, list(REVISION), "left_anti"), scratch, "accepted")
    inputs = selected.select(*REVISION, "scheduled_at", F.col("capture_id").alias("id"),
                             F.col("body_sha256").alias("sha256"), F.col("decoded_length").alias("bytes"))
    R.write_inputs(R.of_days(inputs, accepted), root)
    files = R.list_files(spark, root, accepted, nested_placed, placed, selected, counts)
    R.write_files(R.of_days(files, accepted), root)
    listed_inputs, listed_files = (R.of_days(scan(spark, root, accepted), accepted) for scan in (R.scan_inputs, R.scan_files))
    R.write_manifests(M.manifest_documents(accepted, listed_inputs, listed_files), root)

    written = R.of_days(R.scan_manifests(spark, root, days), days)
    inputs, files = (R.of_days(scan(spark, root, days), days) for scan in (R.scan_inputs, R.scan_files))
    return CompactionResult(
        manifests=written, inputs=inputs, files=files, violations=violations,
        compactions=ledger_rows(written, files, local_only_cleanup),
    )


def ledger_id() -> Column:
    """A stable 63-bit id of a revision: the plan needs no counter shared by all tasks."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(c) for c in REVISION]), 1)


def ledger_rows(manifests: DataFrame, files: DataFrame, local_only_cleanup: bool = False) -> DataFrame:
    """Ledger rows of finished revisions.

    ``data_sha256`` of a revision with one part is the part's own hash; with more
    parts it stays empty, and each part's hash is in the files table.
    """
    sizes = files.groupBy(*REVISION).agg(
        F.sum("bytes").alias("data_bytes"), F.count(F.lit(1)).alias("_parts"),
        F.max("sha256").alias("_sha"), F.max("relative_path").alias("_name"),
    )
    directory = revision_directory(F.col("source_id"), F.col("stream_id"), F.col("archive_date"), F.col("revision"))
    published = F.lit(local_only_cleanup) & (F.size("required_destinations") == 0)
    return (
        manifests.join(sizes, list(REVISION), "left")
        .select(
            ledger_id().alias("compaction_id"),
            *REVISION[:3], "format_version", "revision",
            F.when(published, F.lit("published")).otherwise(F.lit("ready")).alias("status"),
            directory.alias("directory"),
            F.when(F.col("_parts") == 1, F.concat(directory, F.lit("/"), F.col("_name")))
            .otherwise(F.when(F.col("_parts") > 1, directory).otherwise(F.lit(""))).alias("data_path"),
            F.replace(directory, F.lit("parquet/"), F.lit("manifests/")).alias("manifest_path"),
            F.when(F.col("_parts") == 1, F.col("_sha")).otherwise(F.lit("")).alias("data_sha256"),
            F.coalesce("data_bytes", F.lit(0)).cast("bigint").alias("data_bytes"),
            F.col("captured_responses").alias("rows"), F.col("entity_total").alias("entities"),
            "required_destinations", "created_at",
            F.when(published, F.col("created_at")).alias("published_at"),
        )
    )


def queue_publications(compactions: DataFrame, destinations: DataFrame, now: Column) -> DataFrame:
    """One pending publication per new revision and destination."""
    entry = F.struct(F.col("id"), F.col("required"))
    wanted = destinations.agg(F.collect_list(entry)).scalar()
    return (
        compactions.select("compaction_id", F.explode(wanted).alias("_d"))
        .select(
            F.shiftrightunsigned(F.xxhash64("compaction_id", "_d.id"), 1).alias("publication_id"),
            "compaction_id", F.col("_d.id").alias("destination_id"), F.col("_d.required").alias("required"),
            F.lit("pending").alias("status"), F.lit(0).alias("attempt_count"), now.alias("next_attempt_at"),
            F.lit("").alias("last_error"), F.lit("").alias("remote_path"),
            F.lit(None).cast("timestamp").alias("completed_at"),
        )
    )
