"""Ledger operators: latest state, joins, order, adoption, retention, publication."""

from pyspark.sql import functions as F

from transitlake.operators import ledger as L
from transitlake.operators.statistics import DAY
from transitlake.plans import backlog, publish, retention
from workload.bindings import NOW, Bindings, now, text
from workload.oracle_views import stamp
from workload.registry import query

KEY = "source_id, stream_id, archive_date"


@query("scan_day", f"""
SELECT capture_id, {stamp("scheduled_at")} AS scheduled_at, body_sha256
FROM captures_v WHERE source_id = 's1' AND stream_id = 'click' AND archive_date = '2024-01-08' ORDER BY scheduled_at, capture_id""")
def scan_day(b: Bindings):
    day = L.scan_day(b.captures(), "s1", "click", "2024-01-08")
    return day.select("capture_id", text(F.col("scheduled_at")).alias("scheduled_at"), "body_sha256")


@query("ledger_lookups", """
SELECT 'capture' AS lookup, capture_id AS id, 1 AS n FROM captures_v WHERE capture_id = 'c000000000027'
UNION ALL SELECT 'compaction', CAST(compaction_id AS VARCHAR), rows_ FROM compactions_v WHERE compaction_id =
  (SELECT compaction_id FROM compactions_v WHERE source_id = 's0' AND stream_id = 'view' AND archive_date = '2024-01-08' AND revision = 2)
UNION ALL SELECT 'revision', archive_date, rows_ FROM compactions_v
  WHERE source_id = 's0' AND stream_id = 'view' AND archive_date = '2024-01-08' AND revision = 2""")
def ledger_lookups(b: Bindings):
    compactions = b.compactions()
    revision = L.compaction_for_revision(compactions, "s0", "view", "2024-01-08", 2)
    by_id = L.compaction_by_id(compactions, _id_of("2024-01-08", 0, 4, 2))
    capture = b.captures().filter("capture_id = 'c000000000027'").limit(1)
    return (capture.select(F.lit("capture").alias("lookup"), F.col("capture_id").alias("id"), F.lit(1).cast("bigint").alias("n"))
            .unionByName(by_id.select(F.lit("compaction").alias("lookup"), F.col("compaction_id").cast("string").alias("id"), F.col("rows").alias("n")))
            .unionByName(revision.select(F.lit("revision").alias("lookup"), F.col("archive_date").alias("id"), F.col("rows").alias("n"))))


def _id_of(date: str, source: int, kind: int, revision: int) -> int:
    import datetime as dt

    days = (dt.date.fromisoformat(date) - dt.date(2023, 12, 30)).days
    return (days * 20 + source * 5 + kind) * 10 + revision


@query("latest_revision", f"""
SELECT {KEY}, revision, compaction_id, rows_ AS n FROM compactions_v
QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY revision DESC) = 1""")
def latest_revision(b: Bindings):
    return L.latest_revision(b.compactions()).select(*DAY, "revision", "compaction_id", F.col("rows").alias("n"))


@query("upsert_ticks", f"""
SELECT tick_id, source_id, {stamp("scheduled_at")} AS scheduled_at, 'f0' AS config_fingerprint, result, error_category
FROM ticks_v""")
def upsert_ticks(b: Bindings):
    """Every tick is first recorded as running, then finished, by another configuration."""
    ticks = b.ticks().drop("archive_date")
    started = ticks.withColumns({"result": F.lit("running"), "error_category": F.lit(""), "change_seq": F.lit(1),
                                 "config_fingerprint": F.lit("f0")})
    finished = ticks.withColumns({"change_seq": F.lit(2), "config_fingerprint": F.lit("f1"), "source_id": F.lit("moved")})
    return L.upsert_ticks(started.unionByName(finished)).select(
        "tick_id", "source_id", text(F.col("scheduled_at")).alias("scheduled_at"), "config_fingerprint", "result", "error_category")


@query("next_revision", f"""
SELECT {KEY}, CAST(coalesce(max(revision), 0) + 1 AS INTEGER) AS revision FROM days_v LEFT JOIN revisions_v USING ({KEY}) GROUP BY {KEY}""")
def next_revision(b: Bindings):
    return L.next_revision(b.ticks().select(*DAY).distinct(), b.compactions())


@query("predecessor_revision", f"""
SELECT {KEY}, revision, lag(revision) OVER (PARTITION BY {KEY} ORDER BY revision) AS predecessor_revision FROM compactions_v""")
def predecessor_revision(b: Bindings):
    return L.predecessor(b.compactions()).select(*DAY, "revision", "predecessor_revision")


@query("capture_revisions", f"""
SELECT i.capture_id, c.compaction_id, c.revision, {stamp("published_at")} AS published_at
FROM inputs_w i JOIN compactions_v c USING (compaction_id)""")
def capture_revisions(b: Bindings):
    rows = L.capture_revisions(b.captures(), b.inputs(), b.compactions())
    return rows.select("capture_id", "compaction_id", "revision", text(F.col("published_at")).alias("published_at"))


@query("missing_from_latest", f"""
SELECT capture_id FROM captures_v c JOIN (SELECT {KEY}, max(compaction_id) AS compaction_id FROM compactions_v GROUP BY {KEY}) r USING ({KEY})
WHERE NOT EXISTS (SELECT 1 FROM inputs_w i WHERE i.compaction_id = r.compaction_id AND i.capture_id = c.capture_id)""")
def missing_from_latest(b: Bindings):
    return L.missing_from_latest(b.captures(), b.inputs(), b.compactions()).select("capture_id")


@query("days_without_summary", f"""
SELECT {KEY} FROM days_v d WHERE NOT EXISTS (SELECT 1 FROM summaries_v s WHERE s.source_id = d.source_id
  AND s.stream_id = d.stream_id AND s.archive_date = d.archive_date)""")
def days_without_summary(b: Bindings):
    return L.without_summary(b.ticks().select(*DAY).distinct(), b.summaries())


@query("destination_backfill", """
SELECT compaction_id, 'secondary' AS destination_id, FALSE AS required, 'pending' AS status FROM compactions_v c
WHERE manifest_path <> '' AND NOT EXISTS (SELECT 1 FROM publications_v p
  WHERE p.compaction_id = c.compaction_id AND p.destination_id = 'secondary')""")
def destination_backfill(b: Bindings):
    return publish.backfill(b.compactions(), b.publications(), "secondary", now()).select(
        "compaction_id", "destination_id", "required", "status")


RETIRED = """(SELECT *, CASE WHEN destination_id = 'primary' AND required AND status NOT IN ('verified', 'retired')
  THEN 'retired' ELSE status END AS after_status FROM publications_v)"""


@query("retire_destination", f"""
SELECT publication_id, after_status AS status, 'retired: gone' AS last_error FROM {RETIRED} WHERE after_status <> status""")
def retire_destination(b: Bindings):
    return publish.retire_publications(b.publications(), "primary", "gone", now()).select("publication_id", "status", "last_error")


@query("released_by_retirement", f"""
SELECT compaction_id, 'published' AS status, '2024-01-25 12:00:00.000000' AS published_at FROM compactions_v c
WHERE published_at IS NULL AND compaction_id IN (SELECT compaction_id FROM {RETIRED} WHERE destination_id = 'primary' AND after_status = 'retired')
AND NOT EXISTS (SELECT 1 FROM {RETIRED} u WHERE u.compaction_id = c.compaction_id AND u.required AND u.after_status NOT IN ('verified', 'retired'))""")
def released_by_retirement(b: Bindings):
    before = b.publications()
    after = publish.apply_changes(before, publish.retire_publications(before, "primary", "gone", now()), "publication_id")
    return publish.release_retired(b.compactions(), after, "primary", now()).select(
        "compaction_id", "status", text(F.col("published_at")).alias("published_at"))


@query("split_adoption", f"""
SELECT {KEY}, revision, CASE WHEN c.compaction_id IS NULL THEN 'adopt' ELSE 'verify' END AS action
FROM manifests_v m LEFT JOIN (SELECT {KEY}, revision, compaction_id FROM compactions_v) c USING ({KEY}, revision)""")
def split_adoption(b: Bindings):
    return L.split_adoption(b.manifests(), b.compactions()).select(*DAY, "revision", "action")


@query("compare_inputs", f"""
SELECT m.source_id, m.stream_id, m.archive_date, revision, id,
  CASE WHEN c.capture_id IS NULL THEN 'input_missing' ELSE 'input_hash_mismatch' END AS violation
FROM manifest_inputs_v m LEFT JOIN captures_v c ON c.capture_id = m.id WHERE c.capture_id IS NULL OR c.body_sha256 <> m.sha256""")
def compare_inputs(b: Bindings):
    return L.compare_inputs(b.manifest_inputs(), b.captures()).drop("sha256", "bytes")


@query("select_streams", """
SELECT tick_id, timezone, max_start_lateness_ms FROM ticks_v JOIN streams_v USING (source_id, stream_id) WHERE stream_id <> 'view'""")
def select_streams(b: Bindings):
    chosen = b.streams().filter("stream_id <> 'view'")
    return L.select_streams(b.ticks(), chosen).select("tick_id", "timezone", "max_start_lateness_ms")


CANDIDATES = """(SELECT source_id, stream_id, strftime(day, '%Y-%m-%d') AS archive_date FROM (
  SELECT source_id, stream_id, timezone, CAST(unnest(generate_series(first_d, DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT source_id, stream_id, min(d) AS first_d FROM ticks_v GROUP BY ALL) JOIN streams_v USING (source_id, stream_id))
  WHERE TIMESTAMP '2024-01-25 12:00:00' >= timezone('UTC', timezone(timezone, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY)) + INTERVAL 15 MINUTE)"""


@query("candidate_days", f"SELECT * FROM {CANDIDATES}")
def candidate_days(b: Bindings):
    return backlog.candidate_days(b.streams(), b.ticks(), now())


DUE = f"""
SELECT {KEY}, CAST(coalesce(r.revision, 0) + 1 AS INTEGER) AS revision FROM {CANDIDATES} c
JOIN days_v d USING ({KEY})
LEFT JOIN (SELECT {KEY}, count(*) AS n FROM captures_v GROUP BY ALL) k USING ({KEY})
LEFT JOIN (SELECT {KEY}, revision, compaction_id, rows_ FROM compactions_v
  QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY revision DESC) = 1) r USING ({KEY})
WHERE NOT EXISTS (SELECT 1 FROM summaries_v s WHERE s.source_id = c.source_id AND s.stream_id = c.stream_id AND s.archive_date = c.archive_date)
AND (r.compaction_id IS NULL OR r.rows_ <> coalesce(k.n, 0) OR EXISTS (
  SELECT 1 FROM captures_v x WHERE x.source_id = c.source_id AND x.stream_id = c.stream_id AND x.archive_date = c.archive_date
  AND NOT EXISTS (SELECT 1 FROM inputs_w i WHERE i.compaction_id = r.compaction_id AND i.capture_id = x.capture_id)))"""


@query("days_to_compact", DUE)
def days_to_compact(b: Bindings):
    return backlog.days_to_compact(b.streams(), b.ticks(), b.captures(), b.compactions(), b.inputs(), b.summaries(), now())


@query("days_due_by_digest", DUE)
def days_due_by_digest(b: Bindings):
    """The same days from digests of captures and revisions; lists of inputs are read once, when a revision is recorded."""
    digests = L.revision_digests(b.compactions(), b.inputs())
    return backlog.days_due(b.streams(), b.ticks(), b.captures(), digests, b.summaries(), now())


@query("compaction_job_order", f"""
SELECT {KEY}, revision FROM compactions_v ORDER BY archive_date, source_id, stream_id""")
def compaction_job_order(b: Bindings):
    return L.jobs_in_order(b.compactions().select(*DAY, "revision"))


@query("publication_queue", f"""
SELECT publication_id, destination_id, {stamp("next_attempt_at")} AS next_attempt_at FROM publications_v
WHERE status IN ('pending', 'retry', 'uploading') AND next_attempt_at <= TIMESTAMP '{NOW}' ORDER BY next_attempt_at, publication_id""")
def publication_queue(b: Bindings):
    return L.publication_queue(b.publications(), now()).select(
        "publication_id", "destination_id", text(F.col("next_attempt_at")).alias("next_attempt_at"))


@query("publication_work", f"""
SELECT publication_id, CASE WHEN t.id IS NULL THEN 'destination_not_configured' WHEN m.expected_kind IS NULL THEN 'local_integrity' END AS error_category,
  t.remote, c.directory
FROM publications_v p LEFT JOIN (SELECT * FROM destinations_v WHERE id = 'primary') t ON t.id = p.destination_id
LEFT JOIN compactions_v c ON c.compaction_id = p.compaction_id
LEFT JOIN (SELECT * FROM manifests_v WHERE dom % 9 <> 8) m ON m.source_id = c.source_id AND m.stream_id = c.stream_id
  AND m.archive_date = c.archive_date AND m.revision = c.revision
WHERE p.status IN ('pending', 'retry', 'uploading') AND p.next_attempt_at <= TIMESTAMP '{NOW}'""")
def publication_work(b: Bindings):
    manifests = b.manifests().filter(F.dayofmonth(F.to_date("archive_date")) % 9 != 8)
    work = L.publication_work(L.publication_queue(b.publications(), now()), b.destinations().filter("id = 'primary'"),
                              b.compactions(), manifests)
    return work.select("publication_id", "error_category", "remote", "directory")


@query("adoption_union", """
SELECT capture_id, body_sha256 FROM captures_v UNION SELECT capture_id, body_sha256 FROM landing_v""")
def adoption_union(b: Bindings):
    ledger = b.captures().select("capture_id", "body_sha256").filter("event_id % 3 <> 0")
    found = b.captures().select("capture_id", "body_sha256").unionByName(b.landing().select("capture_id", "body_sha256"))
    return L.adopt_rows(ledger, found, "capture_id")


@query("required_set_equality", f"""
SELECT {KEY}, revision, dom % 4 <> 1 AS same_required FROM compactions_v""")
def required_set_equality(b: Bindings):
    dom = F.dayofmonth(F.to_date("archive_date"))
    entry = [F.struct(F.lit(i).alias("id"), F.lit(r).alias("required")) for i, r in (("b", True), ("x", False), ("a", True))]
    rows = b.compactions().withColumns({
        "destinations": F.array(*entry),
        "required_destinations": F.when(dom % 4 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))})
    return L.same_required(rows).select(*DAY, "revision", "same_required")


@query("destination_snapshot", """
SELECT string_agg(CASE WHEN required THEN id END, ',' ORDER BY id) AS required, string_agg(id || ':' || required, ',' ORDER BY id) AS destinations
FROM destinations_v""")
def destination_snapshot(b: Bindings):
    snapshot = L.destination_snapshot(b.destinations())
    return snapshot.select(
        F.array_join("required_destinations", ",").alias("required"),
        F.array_join(F.transform("destinations", lambda d: F.concat_ws(":", d["id"], d["required"].cast("string"))), ",").alias("destinations"))


@query("ledger_status", """
SELECT (SELECT count(*) FROM ticks_v) AS ticks, (SELECT count(*) FROM captures_v) AS captures,
  (SELECT count(*) FROM compactions_v) AS compactions,
  count(*) FILTER (WHERE status IN ('pending', 'uploading')) AS pending_publications,
  count(*) FILTER (WHERE status IN ('retry', 'permanent_failure')) AS failed_publications,
  count(*) FILTER (WHERE status = 'verified') AS verified_publications,
  count(*) FILTER (WHERE status = 'retired') AS retired_publications,
  (SELECT count(*) FROM summaries_v) AS summarized_days FROM publications_v""")
def ledger_status(b: Bindings):
    return L.ledger_status(b.ticks(), b.captures(), b.compactions(), b.publications(), b.summaries())


LIMIT = "TIMESTAMP '2024-01-18 12:00:00'"
RAW = f"""(SELECT c.capture_id, c.decoded_length FROM captures_v c JOIN inputs_w i USING (capture_id)
  JOIN compactions_v p ON p.compaction_id = i.compaction_id WHERE c.event_id % 31 <> 0 GROUP BY ALL
  HAVING count(*) FILTER (WHERE p.published_at IS NULL) = 0 AND max(p.published_at) <= {LIMIT})"""


def partly_retained(b: Bindings):
    """Captures some of whose bodies are gone already."""
    event = F.col("event_id")
    return b.captures().withColumn(
        "raw_path", F.when(event % 31 == 0, F.concat(F.lit("@retained/"), "capture_id")).otherwise(F.col("raw_path")))


@query("raw_retention_candidates", f"SELECT capture_id FROM {RAW}")
def raw_retention_candidates(b: Bindings):
    limit = retention.cutoff(now(), 7 * 86400)
    return retention.raw_candidates(partly_retained(b), b.inputs(), b.compactions(), limit).select("capture_id")


DATA = f"(SELECT compaction_id, data_bytes FROM compactions_v WHERE published_at <= {LIMIT} AND manifest_path <> '')"


@query("dataset_retention_candidates", f"SELECT compaction_id FROM {DATA}")
def dataset_retention_candidates(b: Bindings):
    return retention.dataset_candidates(b.compactions(), retention.cutoff(now(), 7 * 86400)).select("compaction_id")


SUMMARY = f"""(SELECT {KEY} FROM compactions_v c WHERE NOT EXISTS (SELECT 1 FROM summaries_v s WHERE s.source_id = c.source_id
    AND s.stream_id = c.stream_id AND s.archive_date = c.archive_date) AND stream_id <> 'view'
  GROUP BY {KEY} HAVING count(*) FILTER (WHERE published_at IS NULL) = 0 AND max(published_at) <= TIMESTAMP '2024-01-15 12:00:00')"""


@query("summary_candidates", f"""
SELECT {KEY} FROM {SUMMARY} x WHERE NOT EXISTS (SELECT 1 FROM captures_v c WHERE c.source_id = x.source_id
  AND c.stream_id = x.stream_id AND c.archive_date = x.archive_date AND c.event_id % 4 = 0)""")
def summary_candidates(b: Bindings):
    alive = b.captures().withColumn("raw_path", F.when(F.col("event_id") % 4 == 0, F.col("raw_path")).otherwise("@retained/x"))
    return retention.summary_candidates(b.compactions(), b.summaries(), alive, b.streams().filter("stream_id <> 'view'"),
                                        retention.cutoff(now(), 10 * 86400))


@query("summarise_and_drop", f"""
SELECT 'captures' AS kept, count(*) AS n FROM captures_v c WHERE NOT EXISTS (SELECT 1 FROM {SUMMARY} x WHERE c.source_id = x.source_id
  AND c.stream_id = x.stream_id AND c.archive_date = x.archive_date)
UNION ALL SELECT 'ticks', count(*) FROM ticks_v c WHERE NOT EXISTS (SELECT 1 FROM {SUMMARY} x WHERE c.source_id = x.source_id
  AND c.stream_id = x.stream_id AND c.archive_date = x.archive_date)""")
def summarise_and_drop(b: Bindings):
    gone = b.captures().withColumn("raw_path", F.lit("@retained/x"))
    days = retention.summary_candidates(b.compactions(), b.summaries(), gone, b.streams().filter("stream_id <> 'view'"),
                                        retention.cutoff(now(), 10 * 86400))
    count = F.count(F.lit(1)).alias("n")
    return (retention.drop_days(b.captures(), days).agg(count).withColumn("kept", F.lit("captures"))
            .unionByName(retention.drop_days(b.ticks(), days).agg(count).withColumn("kept", F.lit("ticks"))))


@query("mark_retained", f"""
SELECT 'capture' AS what, capture_id AS id, '@retained/' || capture_id || '.pb' AS path, '' AS status FROM {RAW}
UNION ALL SELECT 'dataset', CAST(compaction_id AS VARCHAR), '', '0' FROM {DATA}
UNION ALL SELECT 'publication', CAST(publication_id AS VARCHAR), 'local_retention_elapsed', 'expired' FROM publications_v
  WHERE NOT required AND status <> 'verified' AND compaction_id IN (SELECT compaction_id FROM {DATA})""")
def mark_retained(b: Bindings):
    limit = retention.cutoff(now(), 7 * 86400)
    raw = retention.mark_captures_retained(retention.raw_candidates(partly_retained(b), b.inputs(), b.compactions(), limit))
    data = retention.dataset_candidates(b.compactions(), limit)
    gone = retention.mark_datasets_retained(data)
    expired = retention.expire_optional(b.publications(), data)
    return (raw.select(F.lit("capture").alias("what"), F.col("capture_id").alias("id"), F.col("raw_path").alias("path"), F.lit("").alias("status"))
            .unionByName(gone.select(F.lit("dataset").alias("what"), F.col("compaction_id").cast("string").alias("id"),
                                     F.col("data_path").alias("path"), F.col("data_bytes").cast("string").alias("status")))
            .unionByName(expired.select(F.lit("publication").alias("what"), F.col("publication_id").cast("string").alias("id"),
                                        F.col("last_error").alias("path"), "status")))


@query("retention_report", f"""
SELECT (SELECT count(*) FROM {RAW}) AS raw_captures, (SELECT CAST(sum(decoded_length) AS BIGINT) FROM {RAW}) AS raw_bytes,
  (SELECT count(*) FROM {DATA}) AS datasets, (SELECT count(*) FROM {DATA}) AS data_files,
  (SELECT CAST(sum(data_bytes) AS BIGINT) FROM {DATA}) AS data_bytes,
  (SELECT count(*) FROM (SELECT {KEY} FROM compactions_v c WHERE NOT EXISTS (SELECT 1 FROM summaries_v s WHERE s.source_id = c.source_id
     AND s.stream_id = c.stream_id AND s.archive_date = c.archive_date)
   GROUP BY {KEY} HAVING count(*) FILTER (WHERE published_at IS NULL) = 0 AND max(published_at) <= {LIMIT}) x
   WHERE NOT EXISTS (SELECT 1 FROM captures_v c WHERE c.source_id = x.source_id AND c.stream_id = x.stream_id AND c.archive_date = x.archive_date
     AND c.event_id % 31 <> 0 AND c.capture_id NOT IN (SELECT capture_id FROM {RAW}))) AS summarized_days""")
def retention_report(b: Bindings):
    week = retention.RetentionPolicy(metadata_s=7 * 86400)
    return retention.retention_report(partly_retained(b), b.inputs(), b.compactions(), b.summaries(), b.streams(),
                                      b.destinations(), now(), week)


@query("publication_gate", f"""
SELECT c.compaction_id, 'published' AS status FROM compactions_v c
WHERE NOT EXISTS (SELECT 1 FROM publications_v p WHERE p.compaction_id = c.compaction_id AND p.required AND p.status NOT IN ('verified', 'retired'))
AND EXISTS (SELECT 1 FROM publications_v p WHERE p.compaction_id = c.compaction_id AND p.status = 'verified')""")
def publication_gate(b: Bindings):
    publications = b.publications()
    verified = publications.filter("status = 'verified'")
    return publish.release(b.compactions(), publications, verified, now()).select("compaction_id", "status")


@query("publication_transitions", f"""
SELECT publication_id, CASE WHEN category = '' THEN 'verified' WHEN category = 'remote_integrity' THEN 'permanent_failure' ELSE 'retry' END AS status,
  category AS last_error, attempt_count + 1 AS attempt_count
FROM (SELECT *, CASE WHEN publication_id % 3 = 0 THEN '' WHEN publication_id % 3 = 1 THEN 'network' ELSE 'remote_integrity' END AS category
  FROM publications_v WHERE status IN ('pending', 'retry', 'uploading') AND next_attempt_at <= TIMESTAMP '{NOW}')""")
def publication_transitions(b: Bindings):
    work = L.publication_queue(b.publications(), now()).withColumns({
        "error_category": F.lit(None).cast("string"), "remote_path": F.lit("lake/x")})
    number = F.col("publication_id") % 3
    outcomes = work.select("publication_id", F.when(number == 1, "network").when(number == 2, "remote_integrity").alias("failed_with"))
    return publish.attempt_outcomes(work, outcomes, now(), F.lit(0.0)).select("publication_id", "status", "last_error", "attempt_count")
