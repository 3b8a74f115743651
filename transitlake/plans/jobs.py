"""One function per job: read the ledger, do the work, append what changed.

``seq`` is the job's change number, from :meth:`Ledger.claim` or of the caller's choice, higher than all
before. A job that failed is run again under its number and ends as if it had not failed; see
:mod:`transitlake.plans.journal`. A run that was given up loses nothing either: the next run of the job, under
a number of its own, finds what it left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.functions.bodies import body_sha256
from transitlake.operators.ledger import REVISION, publication_queue, revision_digests
from transitlake.operators.statistics import DAY, with_local_day
from transitlake.plans import backlog, compact, journal, publish, reconcile, retention, verify
from transitlake.plans.compact import CompactionResult
from transitlake.plans.journal import Job
from transitlake.plans.manifest import daily_summaries
from transitlake.schemas import DELETION
from transitlake.session import qualified
from transitlake.sources import bodies as B
from transitlake.sources import revisions as R
from transitlake.sources.ledger import Ledger


def record_revisions(target: Ledger | Job, compactions: DataFrame, inputs: DataFrame, publications: DataFrame,
                     seq: int | None = None) -> None:
    """Append finished revisions after their inputs (revision, id) and publications."""
    named = compactions.select("compaction_id", *REVISION).join(inputs, list(REVISION)).select(
        "compaction_id", F.col("id").alias("capture_id"))
    digests = revision_digests(compactions, named)
    for table, rows in (("compaction_inputs", named), ("revision_digests", digests), ("publications", publications),
                        ("compactions", compactions)):
        if isinstance(target, Job):
            target.append(table, rows)
        else:
            target.append(table, rows, seq)


def record_compaction(target: Ledger | Job, result: CompactionResult, destinations: DataFrame, now: Column,
                      seq: int | None = None) -> None:
    """Append what a compaction finished. A refused day gets no row, so it stays due."""
    queue = compact.queue_publications(result.compactions, destinations, now)
    record_revisions(target, result.compactions, R.of_days(result.inputs, result.compactions), queue, seq)


def compact_due(ledger: Ledger, root: str, bodies: DataFrame | None, streams: DataFrame, destinations: DataFrame, now: Column,
                seq: int, **settings) -> CompactionResult:
    """Compact every stream-day that is due. ``settings`` go to :func:`compact_days`. Without ``bodies``
    the landing area's are read, of the due days only.

    The days are settled in the first attempt. What a failed attempt wrote of them is
    overwritten, or left out as leftovers. The result's tables stay until the job runs next.
    """
    job = Job(ledger, "compact_due", seq)
    ticks = with_local_day(job.current("ticks"), streams)
    captures = job.current("captures")
    digests = all_digests(job)
    due = backlog.days_due(streams, ticks, captures, digests, job.current("daily_summaries"), now)
    days = job.table("due", due.filter(F.lit(not job.finished)))
    bodies = B.scan_bodies(ledger.spark, root, days) if bodies is None else bodies
    result = compact.compact_days(ledger.spark, root, captures, ticks, bodies, streams, days, destinations, now,
                                  scratch=job.scratch, **settings)
    if not job.finished:
        record_compaction(job, result, destinations, now)
        job.end(clear=False)
    return result


def all_digests(job: Job) -> DataFrame:
    """The digests of all revisions. Those of revisions recorded without one are made from their inputs, and kept."""
    compactions, known = job.current("compactions"), job.current("revision_digests")
    bare = compactions.join(known.select("compaction_id"), "compaction_id", "left_anti")
    if bare.isEmpty():
        return known
    made = job.table("digests", revision_digests(bare, job.current("compaction_inputs").join(
        bare.select("compaction_id"), "compaction_id", "left_semi")))
    if not job.finished:
        job.append("revision_digests", made, after=1)
    return known.unionByName(made)


def publish_round(ledger: Ledger, root: str, streams: DataFrame, destinations: DataFrame, now: Column, jitter: Column,
                  seq: int) -> DataFrame:
    """Try all due publications once and release revisions; returns the attempts.

    A revision whose publications an earlier round verified without releasing it is
    looked at again.
    """
    job = Job(ledger, "publish_round", seq)
    if not job.finished:
        compactions, before = job.current("compactions"), job.current("publications")
        queued = publication_queue(before, now).select("compaction_id")
        due = job.table("due", compactions.join(queued, "compaction_id", "left_semi").select(*REVISION))
        done = publish.publish_due(ledger.spark, root, before, compactions, R.scan_manifests(ledger.spark, root, due),
                                   destinations, streams, now, jitter, job.table)
        job.append("publications", done)
        after = publish.apply_changes(before, done, "publication_id")
        unreleased = compactions.filter("published_at IS NULL").select("compaction_id")
        verified = after.filter("status = 'verified'").select("compaction_id").join(unreleased, "compaction_id", "left_semi") \
            .unionByName(done.filter("status = 'verified'").select("compaction_id"))
        job.append("compactions", publish.release(compactions, after, verified.distinct(), now))
        job.end()
    return job.appended("publications")


def reconcile_lake(ledger: Ledger, root: str, now: Column, seq: int) -> DataFrame:
    """Register captures and adopt revisions that the ledger lacks; one row of counters.

    A job that has ended is not repeated; asked again, it counts nothing.
    """
    spark = ledger.spark
    job = Job(ledger, "reconcile_lake", seq)
    if job.finished:
        return spark.createDataFrame([(0, 0, 0)], "captures_registered bigint, revisions_adopted bigint, corrupt bigint")
    bodies, sidecars = B.scan_bodies(spark, root, in_tasks=True), B.scan_sidecars(spark, root, in_tasks=True)
    hashed = bodies.withColumn("found_sha256", body_sha256(F.col("body"))).drop("body")
    known = job.current("captures")
    checked = job.table("checked", reconcile.check_sidecars(sidecars, hashed, known))
    classified = job.table("classified", reconcile.classify_files(B.list_bodies(spark, root, in_tasks=True), sidecars, known))
    fresh = reconcile.new_captures(checked)
    job.append("ticks", reconcile.ticks_of(fresh))
    job.append("captures", fresh)

    manifests, inputs, files = R.scan_manifests(spark, root), R.scan_inputs(spark, root), R.scan_files(spark, root)
    compactions = job.current("compactions")
    violations = job.table("violations", verify.verify_revisions(manifests, compactions, inputs, files, R.scan_parts(spark, root)))
    broken = job.table("broken", R.misplaced_manifests(spark, root).unionByName(R.unreadable_manifests(spark, root)).distinct())
    captures = known.unionByName(fresh.select(*known.columns))
    adopted = job.table("adopted", reconcile.adoptable(manifests, compactions, inputs, captures, violations, broken))
    rows = job.table("adopted-rows", compact.ledger_rows(adopted, R.of_days(files, adopted)))
    queue = reconcile.adoption_queue(adopted, now).join(rows.select("compaction_id", *REVISION), list(REVISION))
    queue = queue.withColumns({
        "publication_id": publish.publication_id(F.col("destination_id")), "last_error": F.lit(""), "remote_path": F.lit(""),
        "completed_at": F.lit(None).cast("timestamp")})
    record_revisions(job, rows, R.of_days(inputs, rows), queue)
    counted = reconcile.reconcile_counters(checked, classified, adopted, violations, broken)
    counted = spark.createDataFrame([counted.first()], counted.schema)  # one row, kept when the scratch tables go
    job.end()
    return counted


def clean_up(ledger: Ledger, streams: DataFrame, destinations: DataFrame, now: Column, seq: int,
             policy: retention.RetentionPolicy | None = None, delete: bool = False) -> DataFrame:
    """Apply retention to the ledger; returns the paths it lists, with the outcome of each.

    The list goes to the ledger's ``deletions`` before anything is deleted or marked. Without ``delete``
    the paths are only listed, for the caller or :func:`delete_listed`, and their owners are marked as
    retained. With it they are deleted, together with those that a run given up left undone, and
    an owner is marked once all of its paths are gone; one with a failed path is tried again by the next run.
    A summarised day keeps one row: its captures, ticks and compaction inputs are
    removed, also those that a run given up has summarised without removing them.
    """
    policy, root = policy or retention.RetentionPolicy(), ledger.root
    job = Job(ledger, "clean_up", seq)
    if not job.finished:
        _clean_up(job, root, streams, destinations, now, policy, delete)
        job.end()
    return ledger.current("deletions").join(job.appended("deletions").select("path").distinct(), "path", "left_semi")


def _clean_up(job: Job, root: str, streams: DataFrame, destinations: DataFrame, now: Column,
              policy: retention.RetentionPolicy, delete: bool) -> None:
    ledger, spark = job.ledger, job.spark
    gate = retention.may_clean(destinations, policy)
    captures, compactions, inputs = (job.current(t) for t in ("captures", "compactions", "compaction_inputs"))
    raw = job.table("raw", retention.raw_candidates(captures, inputs, compactions, retention.cutoff(now, policy.raw_s)).filter(gate))
    data = job.table("data", retention.dataset_candidates(compactions, retention.cutoff(now, policy.parquet_s)).filter(gate))
    wanted = retention.files_to_remove(raw, data)
    state = F.lit("intended" if delete else "listed")
    job.append("deletions", wanted.select("*", state.alias("outcome"), F.lit(0).alias("bytes"), now.alias("at")))
    if delete:
        outcomes = _delete(job, root, wanted, now)
        gone = retention.fully_gone(outcomes)
        raw = raw.join(gone.filter("kind = 'capture'").select(F.col("owner").alias("capture_id")), "capture_id", "left_semi")
        ids = gone.filter("kind = 'dataset'").select(F.col("owner").cast("bigint").alias("compaction_id"))
        data = data.join(ids, "compaction_id", "left_semi")
    job.append("captures", retention.mark_captures_retained(raw))
    job.append("publications", retention.expire_optional(job.current("publications"), data))
    job.append("compactions", retention.mark_datasets_retained(data))

    # marked captures have no body any more; the others are as they were
    marked = retention.mark_captures_retained(raw).select(*captures.columns)
    kept = publish.apply_changes(captures, marked, "capture_id")
    summaries = job.current("daily_summaries")
    days = retention.summary_candidates(compactions, summaries, kept, streams, retention.cutoff(now, policy.metadata_s)).filter(gate)
    days = job.table("summarised", days)
    given_up = journal.unfinished(ledger, "clean_up", job.seq)
    left = ledger.changes("daily_summaries", before=job.seq).filter(F.col("change_seq").isin(given_up)).select(*DAY).distinct()
    empty_days = days.select(*DAY).unionByName(left)
    ticks = with_local_day(job.current("ticks"), streams)
    gone, gone_ticks = (job.table(name, t.join(empty_days, list(DAY), "left_semi"))
                        for name, t in (("gone", kept), ("gone-ticks", ticks)))
    job.append("daily_summaries", daily_summaries(gone, gone_ticks, days, now))
    job.append("compaction_inputs", inputs.join(gone.select("capture_id"), "capture_id", "left_semi"), removed=True, after=1)
    job.append("captures", gone, removed=True, after=1)
    job.append("ticks", gone_ticks, removed=True, after=1)

    count = F.count(F.lit(1))
    totals = raw.agg(count.alias("r"), F.coalesce(F.sum("decoded_length"), F.lit(0)).alias("b")) \
        .unionByName(data.agg(count.alias("d"), F.coalesce(F.sum("data_bytes"), F.lit(0)).alias("b")), allowMissingColumns=True) \
        .unionByName(days.agg(count.alias("s")), allowMissingColumns=True) \
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("r", "d", "s", "b")])
    target = F.format_string("captures=%d datasets=%d days=%d bytes=%d", "r", "d", "s", "b")
    job.append("audit", totals.filter("r + d + s > 0").select(
        F.lit("retention_cleanup").alias("action"), target.alias("target"), F.lit("age limits reached").alias("reason"),
        now.alias("created_at")))
    for number in given_up:
        journal.give_up(ledger, "clean_up", number)


def _delete(job: Job, root: str, wanted: DataFrame, now: Column) -> DataFrame:
    """Delete listed paths and those still open from earlier runs; the outcomes are recorded before any mark."""
    undone = job.current("deletions").filter(F.col("outcome").isin("intended", "failed")).select("path", "kind", "owner")
    paths = wanted.unionByName(undone).dropDuplicates(["path"])
    outcomes = job.table("outcomes", retention.delete_paths(paths, qualified(job.spark, root)))
    job.append("deletions", outcomes.withColumn("at", now), after=1)
    return outcomes


def delete_listed(ledger: Ledger, now: Column, seq: int) -> DataFrame:
    """Delete the paths that earlier runs of :func:`clean_up` only listed, or failed to delete; returns their outcomes."""
    job = Job(ledger, "delete_listed", seq)
    if not job.finished:
        listed = job.current("deletions").filter(F.col("outcome") == "listed").select("path", "kind", "owner")
        _delete(job, ledger.root, listed, now)
        job.end()
    return job.appended("deletions", after=1).select(*DELETION.names)


def retire_destination(ledger: Ledger, destination: str, reason: str, now: Column, seq: int) -> None:
    """Give up what a destination still owes, release what only waited for it, and record why."""
    job = Job(ledger, "retire_destination", seq)
    if job.finished:
        return
    before, compactions = job.current("publications"), job.current("compactions")
    retired = publish.retire_publications(before, destination, reason, now)
    job.append("publications", retired)
    after = publish.apply_changes(before, retired, "publication_id")
    job.append("compactions", publish.release_retired(compactions, after, destination, now))
    when = ledger.spark.range(1).select(now.alias("created_at"))
    job.append("audit", publish.retirement_audit(when, destination, reason))
    job.end()
