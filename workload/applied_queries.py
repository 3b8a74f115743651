"""Jobs applied to a ledger, and revisions of unusual days."""

from pyspark.sql import functions as F

from transitlake import scratch_dir
from transitlake.operators.ledger import REVISION
from transitlake.operators.statistics import DAY
from transitlake.plans import compact, jobs, reconcile, retention, verify
from transitlake.plans.journal import Job
from transitlake.schemas import CAPTURE, LEDGER
from transitlake.session import qualified
from transitlake.sources import bodies as B
from transitlake.sources import revisions as R
from transitlake.sources.ledger import Ledger
from transitlake.streaming import registration
from workload.bindings import Bindings, now
from workload.landing_files import write_landing
from workload.ledger_queries import DATA, RAW, RETIRED, partly_retained
from workload.registry import query


def _pages(b: Bindings, root: str, kind: str):
    """Pages as captures and bodies of streams of one kind, under one URL for each stream."""
    columns = {"expected_kind": F.lit(kind),
               "sanitized_url": F.concat(F.lit("https://example.test/"), "source_id", F.lit("/"), "stream_id")}
    pages = b.landing().withColumns(columns).select(*CAPTURE.names, "body", "page_id")
    bronze = R.materialize(pages, root, "bronze")
    streams = bronze.groupBy("source_id", "stream_id", "expected_kind", "timezone").agg(
        F.first("sanitized_url").alias("url")).withColumns({n: F.lit("") for n in ("registry_id", "license_url", "attribution")})
    return bronze, streams


def _ticks(captures):
    return reconcile.ticks_of(captures).join(captures.select("tick_id", "archive_date"), "tick_id")


@query("zero_row_days", """
SELECT source_id, strftime(local_ts, '%Y-%m-%d') AS archive_date, count(*) AS captured_responses, CAST(0 AS BIGINT) AS stop_time_update_total,
  CAST(0 AS BIGINT) AS parts, CAST(0 AS BIGINT) AS violations FROM landing_v GROUP BY ALL""")
def zero_row_days(b: Bindings):
    """Pages as bodies of trip-update streams flatten to nothing: their days are still sound revisions."""
    root = scratch_dir(b.spark, "zero")
    bronze, streams = _pages(b, root, "trip_update")
    captures = bronze.select(*CAPTURE.names)
    days = captures.select(*DAY).distinct().withColumn("revision", F.lit(1))
    result = compact.compact_days(b.spark, root, captures, _ticks(captures), bronze.select("raw_path", "body"), streams, days,
                                  b.destinations(), now())
    broken = verify.verify_revisions(result.manifests, result.compactions, result.inputs, result.files,
                                     R.scan_parts(b.spark, root)).groupBy(*REVISION).agg(F.count(F.lit(1)).alias("_broken"))
    parts = result.files.groupBy(*REVISION).agg(F.count(F.lit(1)).alias("_parts"))
    joined = result.manifests.join(broken, list(REVISION), "left").join(parts, list(REVISION), "left")
    return joined.select("source_id", "archive_date", "captured_responses", "stop_time_update_total",
                         F.coalesce("_parts", F.lit(0)).cast("bigint").alias("parts"),
                         F.coalesce("_broken", F.lit(0)).cast("bigint").alias("violations"))


DELIVERED = "(SELECT source_id, strftime(local_ts, '%Y-%m-%d') AS archive_date, page_id % 10 = 8 AS late FROM landing_v)"


@query("late_revisions_written", f"""
SELECT source_id, archive_date, 1 AS revision, count(*) AS n, TRUE AS described, CAST(1 AS BIGINT) AS queued
FROM {DELIVERED} WHERE NOT late GROUP BY ALL
UNION ALL
SELECT source_id, archive_date, CASE WHEN bool_and(late) THEN 1 ELSE 2 END, count(*), TRUE, CAST(1 AS BIGINT)
FROM {DELIVERED} GROUP BY source_id, archive_date HAVING bool_or(late)""")
def late_revisions_written(b: Bindings):
    """A tenth of the pages arrives late; every revision is written, read back and described by the ledger."""
    root = scratch_dir(b.spark, "late")
    bronze, streams = _pages(b, root, "mixed")
    target = b.destinations().filter("required")
    ledger = Ledger(b.spark, root).create()

    def write(days):
        captures = ledger.current("captures", days)
        return compact.compact_days(b.spark, root, captures, _ticks(captures), bronze.select("raw_path", "body"), streams, days,
                                    target, now())

    late = F.col("page_id") % 10 == 8
    handle = registration.revise_late_days(ledger, now(), write, target)
    for number, wanted in enumerate((~late, late), 1):
        bronze.filter(wanted).select(*CAPTURE.names).write.parquet(f"{root}/arrive/part={number}")
        arriving = b.spark.readStream.schema(CAPTURE).option("recursiveFileLookup", "true").parquet(f"{root}/arrive")
        registration.start(arriving, handle, f"{root}/checkpoint").awaitTermination()
    count = F.count(F.lit(1))
    rows = R.read_revisions(b.spark, root, flattened=False).groupBy(*REVISION).agg(count.alias("n"))
    queued = ledger.current("publications").groupBy("compaction_id").agg(count.alias("queued"))
    described = (F.col("data_path") != "") & (F.col("manifest_path") != "") & (F.col("data_bytes") > 0)
    return ledger.current("compactions").join(rows, list(REVISION)).join(queued, "compaction_id").select(
        "source_id", "archive_date", "revision", "n", described.alias("described"), "queued")


@query("retirement_audit", f"""
SELECT 'retire_destination' AS action, 'primary' AS target, 'gone' AS reason,
  (SELECT count(*) FROM {RETIRED} WHERE after_status <> status) AS retired,
  (SELECT count(*) FROM compactions_v c WHERE published_at IS NULL
    AND compaction_id IN (SELECT compaction_id FROM {RETIRED} WHERE destination_id = 'primary' AND after_status = 'retired')
    AND NOT EXISTS (SELECT 1 FROM {RETIRED} u WHERE u.compaction_id = c.compaction_id AND u.required
      AND u.after_status NOT IN ('verified', 'retired'))) AS released""")
def retirement_audit(b: Bindings):
    """Retire a destination in the ledger; what it changed is read from the ledger's changes."""
    ledger = Ledger(b.spark, scratch_dir(b.spark, "retire")).create()
    ledger.append("publications", b.publications(), 1)
    ledger.append("compactions", b.compactions(), 1)
    jobs.retire_destination(ledger, "primary", "gone", now(), 2)
    changed = [ledger.changes(t).filter("change_seq = 2").agg(F.count(F.lit(1)).alias(n))
               for t, n in (("publications", "retired"), ("compactions", "released"))]
    audit = ledger.current("audit").select("action", "target", "reason")
    return audit.withColumns({"retired": changed[0].scalar(), "released": changed[1].scalar()})


@query("retention_applied", f"""
SELECT (SELECT count(*) FROM {RAW}) AS captures, (SELECT count(*) FROM {DATA}) AS datasets,
  (SELECT count(*) FROM publications_v WHERE NOT required AND status <> 'verified'
    AND compaction_id IN (SELECT compaction_id FROM {DATA})) AS expired, 'retention_cleanup' AS action""")
def retention_applied(b: Bindings):
    """A week's retention applied to the ledger, with its audit row."""
    ledger = Ledger(b.spark, scratch_dir(b.spark, "cleanup")).create()
    tables = {"captures": partly_retained(b), "compactions": b.compactions(), "compaction_inputs": b.inputs(),
              "publications": b.publications(), "ticks": b.ticks(), "daily_summaries": b.summaries()}
    for name, rows in tables.items():
        have = set(rows.columns)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER[name].fields if f.name not in have}
        ledger.append(name, rows.withColumns(missing), 1)
    week = retention.RetentionPolicy(raw_s=7 * 86400, parquet_s=7 * 86400)
    jobs.clean_up(ledger, b.streams(), b.destinations(), now(), 2, week)
    expired = ledger.changes("publications").filter("change_seq = 2 AND last_error = 'local_retention_elapsed'")
    number = {n: F.regexp_extract("target", rf"{n}=([0-9]+)", 1).cast("bigint") for n in ("captures", "datasets")}
    return ledger.current("audit").withColumns({**number, "expired": expired.agg(F.count(F.lit(1))).scalar()}).select(
        "captures", "datasets", "expired", "action")


@query("retention_deleted", """
SELECT source_id, CASE WHEN source_id NOT IN ('s1', 's2') THEN 'left' WHEN page_id % 9 = 4 AND file = 'body' THEN 'gone' ELSE 'deleted' END AS outcome,
  count(*) AS files, count(*) FILTER (source_id IN ('s1', 's2') AND file = 'document') AS marked
FROM (SELECT source_id, page_id, unnest(['body', 'document']) AS file FROM landing_v) GROUP BY ALL""")
def retention_deleted(b: Bindings):
    """Two of four sources are published: their bodies and documents go, some bodies were gone already."""
    root = scratch_dir(b.spark, "deleted")
    pages = b.landing().withColumn("entity_count", F.lit(0))
    write_landing(pages, root)
    ledger = Ledger(b.spark, root).create()
    captures = R.materialize(pages.select(*CAPTURE.names, "page_id"), root, "captures")
    days = captures.select(*DAY).distinct().withColumn("revision", F.lit(1))
    published = F.when(F.col("source_id").isin("s1", "s2"), F.lit("2024-01-02 00:00:00").cast("timestamp"))
    facts = {"compaction_id": compact.ledger_id(), "published_at": published, "manifest_path": F.lit("")}
    rows = days.withColumns(facts)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER["compactions"].fields if f.name not in rows.columns}
    rows = R.materialize(rows.withColumns(missing), root, "revisions")
    inputs = captures.select(*DAY, F.col("capture_id").alias("id")).withColumn("revision", F.lit(1))
    first = ledger.claim("compact_due", "query")
    ledger.append("captures", captures, first)
    jobs.record_revisions(ledger, rows, inputs, b.spark.createDataFrame([], LEDGER["publications"]), first)
    early = captures.filter("page_id % 9 = 4 AND source_id IN ('s1', 's2')").select(
        F.col("raw_path").alias("path"), F.lit("capture").alias("kind"), F.col("capture_id").alias("owner"))
    retention.delete_paths(early, qualified(b.spark, root)).count()
    number = ledger.claim("clean_up", "query")
    week = retention.RetentionPolicy(raw_s=7 * 86400, parquet_s=7 * 86400, metadata_s=400 * 86400)
    done = jobs.clean_up(ledger, b.streams(), b.destinations(), now(), number, week, delete=True)
    owners = captures.select(F.col("capture_id").alias("owner"), "source_id")
    after = ledger.current("captures").select(F.col("capture_id").alias("owner"), F.col("raw_path").startswith("@retained/").alias("is_marked"))
    document = F.col("path").endswith(".json")
    gone = done.join(owners, "owner").join(after, "owner").groupBy("source_id", "outcome").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("is_marked") & document).alias("marked"))
    left = B.list_bodies(b.spark, root, in_tasks=True).select(F.regexp_extract("raw_path", "source=([^/]+)/", 1).alias("source_id")).unionByName(
        B.scan_sidecars(b.spark, root, in_tasks=True).select("source_id"))
    return gone.unionByName(left.groupBy("source_id").agg(
        F.lit("left").alias("outcome"), F.count(F.lit(1)).alias("files"), F.lit(0).cast("bigint").alias("marked")))


DELIVERIES = """(SELECT source_id, stream_id, archive_date, count(*) FILTER (event_id % 10 NOT IN (7, 8)) AS a,
  count(*) FILTER (event_id % 10 = 8) AS b, count(*) FILTER (event_id % 10 = 7) AS c FROM captures_v GROUP BY ALL)"""


@query("one_sequence", f"""
SELECT source_id, stream_id, archive_date, 1 AS revision, 'compact_due' AS owner, a AS n FROM {DELIVERIES} WHERE a > 0
UNION ALL SELECT source_id, stream_id, archive_date, 1 + CAST(a > 0 AS INTEGER), 'stream', a + b FROM {DELIVERIES} WHERE b > 0
UNION ALL SELECT source_id, stream_id, archive_date, 1 + CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER), 'stream', a + b + c FROM {DELIVERIES} WHERE c > 0""")
def one_sequence(b: Bindings):
    """A job compacts first, a stream revises later, and so does its successor with a new checkpoint, whose batches count from 0."""
    root = scratch_dir(b.spark, "sequence")
    ledger = Ledger(b.spark, root).create()
    captures = b.captures()
    in_time = R.materialize(captures.filter("event_id % 10 NOT IN (7, 8)").select(*CAPTURE.names), root, "in-time")
    job = Job(ledger, "compact_due", ledger.claim("compact_due", "first"))
    job.append("captures", in_time)
    rows = in_time.groupBy(*DAY).agg(F.count(F.lit(1)).alias("rows")).withColumn("revision", F.lit(1)) \
        .withColumn("compaction_id", compact.ledger_id())
    missing = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER["compactions"].fields if f.name not in rows.columns}
    job.append("compactions", rows.withColumns(missing))
    job.end()
    for number, digit in ((1, 8), (2, 7)):
        captures.filter(F.col("event_id") % 10 == digit).select(*CAPTURE.names).write.parquet(f"{root}/arrive/part={number}")
        arriving = b.spark.readStream.schema(CAPTURE).parquet(f"{root}/arrive/part={number}")
        registration.start(arriving, registration.revise_late_days(ledger, now()), f"{root}/checkpoint-{number}").awaitTermination()
    owner = F.when(F.col("change_seq") == job.seq, "compact_due").otherwise("stream").alias("owner")
    return ledger.changes("compactions").select(*REVISION, owner, F.col("rows").alias("n"))


@query("reconcile_corruption", """
SELECT count(*) FILTER (page_id % 6 NOT IN (1, 2)) AS captures_registered, CAST(0 AS BIGINT) AS revisions_adopted,
  count(*) FILTER (page_id % 6 IN (1, 2)) AS corrupt, count(*) FILTER (page_id % 6 NOT IN (1, 2)) AS captures, count(*) FILTER (page_id % 6 NOT IN (1, 2)) AS ticks
FROM landing_v""")
def reconcile_corruption(b: Bindings):
    """A lake whose ledger is empty: a sixth of the bodies was altered, another sixth has an unknown document format."""
    number = F.col("page_id") % 6
    broken = b.landing().withColumns({
        "body": F.when(number == 1, F.lit("altered").cast("binary")).otherwise(F.col("body")), "format_version": F.when(number == 2, 9).otherwise(1)})
    root = scratch_dir(b.spark, "corrupt")
    write_landing(broken, root)
    ledger = Ledger(b.spark, root).create()
    counted = jobs.reconcile_lake(ledger, root, now(), ledger.claim("reconcile_lake", "query"))
    count = F.count(F.lit(1))
    return counted.withColumns({t: ledger.current(t).agg(count).scalar() for t in ("captures", "ticks")})
