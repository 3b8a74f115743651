"""Jobs that write and read files: landing, revisions, checks, publication."""

from pyspark.sql import functions as F

from transitlake import scratch_dir
from transitlake.functions.bodies import body_sha256
from transitlake.operators.decode import decode_bodies
from transitlake.operators.ledger import REVISION
from transitlake.operators.statistics import DAY
from transitlake.plans import compact, publish, reconcile, verify
from transitlake.schemas import CAPTURE, ENTITY_KIND_MESSAGE
from transitlake.sources import bodies as B
from transitlake.sources import revisions as R
from transitlake.sources.footers import footer_violations, scan_footers
from transitlake.sources.ledger import Ledger
from workload.bindings import Bindings, now, text
from workload.feeds import feed_captures
from workload.landing_files import write_landing
from workload.oracle_views import stamp
from workload.registry import query


def landed(b: Bindings) -> str:
    root = scratch_dir(b.spark, "landing")
    write_landing(b.landing(), root)
    return root


@query("scan_bodies", """
SELECT source_id AS source, 'pages' AS stream, strftime(local_ts, '%Y-%m-%d') AS date, strftime(local_ts, '%H') AS hour,
  stem || '.pb' AS raw_path, body_bytes, body_sha256 FROM landing_v""")
def scan_bodies(b: Bindings):
    return B.scan_bodies(b.spark, landed(b), in_tasks=True).withColumn("body_sha256", body_sha256(F.col("body"))).drop("body")


@query("scan_sidecars", f"""
SELECT capture_id, source_id, {stamp("scheduled_at")} AS scheduled_at, sanitized_url, body_bytes AS decoded_length,
  body_sha256, stem || '.json' AS found_path, FALSE AS corrupt, 'text/html' AS content_type FROM landing_v""")
def scan_sidecars(b: Bindings):
    return B.scan_sidecars(b.spark, landed(b)).select(
        "capture_id", "source_id", text(F.col("scheduled_at")).alias("scheduled_at"), "sanitized_url", "decoded_length",
        "body_sha256", "found_path", "corrupt", F.element_at("response_headers", "Content-Type").alias("content_type"))


@query("ledger_tables", """
SELECT result, count(*) AS n FROM ticks_v GROUP BY result UNION ALL SELECT 'capture ' || parse_status, count(*) FROM captures_v GROUP BY ALL""")
def ledger_tables(b: Bindings):
    """Ticks are appended running, then finished; a tenth of the captures is removed and added again."""
    ledger = Ledger(b.spark, scratch_dir(b.spark, "ledger"))
    ticks, captures = b.ticks(), b.captures()
    ledger.append("ticks", ticks.withColumn("result", F.lit("running")), 1)
    ledger.append("ticks", ticks, 2)
    ledger.append("captures", captures, 1)
    some = captures.filter("event_id % 10 = 7")
    ledger.append("captures", some, 2, removed=True)
    ledger.append("captures", some, 3)
    count = F.count(F.lit(1)).alias("n")
    return ledger.current("ticks").groupBy("result").agg(count).unionByName(
        ledger.current("captures").groupBy(F.concat(F.lit("capture "), "parse_status").alias("result")).agg(count))


@query("classify_files", """
SELECT stem, CASE WHEN page_id % 5 = 0 AND page_id % 4 <> 1 THEN 'missing' WHEN page_id % 5 = 0 THEN 'sidecar_without_body'
  WHEN page_id % 7 = 0 AND page_id % 4 <> 1 THEN 'missing' WHEN page_id % 7 = 0 THEN 'body_without_sidecar'
  WHEN page_id % 4 = 1 THEN 'unregistered' ELSE 'present' END AS status FROM landing_v WHERE page_id % 35 <> 0 OR page_id % 4 <> 1""")
def classify_files(b: Bindings):
    """Some bodies and some sidecars never arrived, and a quarter is unknown to the ledger."""
    pages = b.landing()
    root = scratch_dir(b.spark, "landing")
    write_landing(pages, root)
    number = F.regexp_extract("raw_path", r"/p([0-9]+)_", 1).cast("bigint")
    listing = B.list_bodies(b.spark, root, in_tasks=True).filter(number % 5 != 0)
    sidecars = B.scan_sidecars(b.spark, root, in_tasks=True).filter(
        F.regexp_extract("found_path", r"/p([0-9]+)_", 1).cast("bigint") % 7 != 0)
    return reconcile.classify_files(listing, sidecars, pages.filter("page_id % 4 <> 1")).select("stem", "status")


def _days_of(captures, compactions=None):
    return captures.select(*DAY).distinct().withColumn("revision", F.lit(1))


def _hashed(bodies):
    return bodies.withColumn("found_sha256", body_sha256(F.col("body"))).drop("body")


@query("reconcile_landing", """
SELECT capture_id, CASE WHEN page_id % 6 = 1 THEN 'corrupt_body' WHEN page_id % 6 = 2 THEN 'corrupt_document'
  WHEN page_id % 4 = 1 THEN 'new' ELSE 'known' END AS status, CASE WHEN page_id % 4 = 1 AND page_id % 6 NOT IN (1, 2) THEN 'captured' END AS tick
FROM landing_v""")
def reconcile_landing(b: Bindings):
    pages = b.landing()
    number = F.col("page_id")
    broken = pages.withColumns({
        "body": F.when(number % 6 == 1, F.lit("changed").cast("binary")).otherwise(F.col("body")),
        "format_version": F.when(number % 6 == 2, 9).otherwise(1)})
    root = scratch_dir(b.spark, "landing")
    write_landing(broken, root)
    bodies = _hashed(B.scan_bodies(b.spark, root, in_tasks=True))
    checked = reconcile.check_sidecars(B.scan_sidecars(b.spark, root, in_tasks=True), bodies, pages.filter("page_id % 4 <> 1"))
    ticks = reconcile.ticks_of(reconcile.new_captures(checked)).select("tick_id", F.col("result").alias("tick"))
    return checked.join(ticks, "tick_id", "left").select("capture_id", "status", "tick")


def _compacted(b: Bindings):
    """Orders as a trip-update stream and pages as a nested one, compacted in one job."""
    root = scratch_dir(b.spark, "lake")
    trips = feed_captures(b).withColumns({
        "parse_status": F.lit("valid"), "parse_error": F.lit(""), "feed_version": F.lit("2.0"),
        "incrementality": F.lit(None).cast("int"), "feed_timestamp": (F.lit(1704067200) + F.col("feed")).cast("decimal(20,0)"),
        "validation_flags": F.array().cast("array<string>")})
    # the entity count is part of a capture; take it from the decoded body, once
    counted = decode_bodies(trips, wanted=ENTITY_KIND_MESSAGE).withColumn("entity_count", F.size("message.entity"))
    wide = [*CAPTURE.names, "body"]
    bronze = R.materialize(counted.select(*wide).unionByName(b.landing().select(*wide)), root, "bronze")
    captures, bodies = bronze.drop("body"), bronze.select("raw_path", "body")
    days = R.materialize(_days_of(captures), root, "days")
    ticks = reconcile.ticks_of(captures).withColumn("archive_date", F.substring("scheduled_at", 1, 10)) \
        .drop("archive_date").join(captures.select("tick_id", "archive_date"), "tick_id")
    streams = captures.groupBy("source_id", "stream_id", "expected_kind", "timezone").agg(
        F.concat(F.lit("https://example.test/"), F.first("source_id"), F.lit("/"), F.first("stream_id")).alias("url")).withColumns({
            "registry_id": F.lit(""), "license_url": F.lit(""), "attribution": F.lit("")})
    # pages of one day have different URLs: publish them under their stream's
    same = captures.withColumn("sanitized_url", F.concat(F.lit("https://example.test/"), "source_id", F.lit("/"), "stream_id"))
    result = compact.compact_days(b.spark, root, same, ticks, bodies, streams, days, b.destinations(), now())
    return root, same, bodies, days, streams, result


@query("compact_flattened_rows", """
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(l_linenumber AS BIGINT) AS stop_sequence, CAST(l_partkey AS VARCHAR) AS stop_id,
  CAST(l_quantity AS INTEGER) AS arrival_delay,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date FROM stops_v""")
def compact_flattened_rows(b: Bindings):
    captured = feed_captures(b).withColumns({"parse_status": F.lit("valid"), "validation_flags": F.array(F.lit("ok"))})
    bodies = captured.select("raw_path", "body")
    rows = compact.flattened_plan(captured.drop("body"), bodies, _days_of(captured))
    return rows.select("trip_id", "stop_sequence", "stop_id", "arrival_delay", "archive_date")


@query("compact_nested_rows", """
SELECT capture_id, source_id, strftime(local_ts, '%Y-%m-%d') AS archive_date, 1 AS revision, body_sha256, body_bytes, 0 AS entities FROM landing_v""")
def compact_nested_rows(b: Bindings):
    pages = b.landing()
    rows = compact.nested_plan(pages.drop("body"), pages.select("raw_path", "body"), _days_of(pages))
    return rows.select("capture_id", "source_id", "archive_date", "revision", body_sha256(F.col("feed_message_pb")).alias("body_sha256"),
                       F.octet_length("feed_message_pb").cast("bigint").alias("body_bytes"), F.size("entities").alias("entities"))


@query("written_revisions", """
SELECT 'flat' AS layout, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date,
  'tpch' AS source_id, count(*) AS n, CAST(count(l_orderkey) AS BIGINT) AS stops FROM stops_v GROUP BY 1, 2, 3
UNION ALL SELECT 'nested', strftime(local_ts, '%Y-%m-%d'), source_id, count(*), NULL FROM landing_v GROUP BY 1, 2, 3""")
def written_revisions(b: Bindings):
    """Write both layouts, then read them back through their manifests."""
    root, _, _, _, _, result = _compacted(b)
    totals = result.manifests.select(*REVISION, F.col("stop_time_update_total").alias("stops"))
    count = F.count(F.lit(1)).alias("n")
    rows = [R.read_revisions(b.spark, root, flattened=flat).groupBy(*REVISION).agg(count).withColumn("layout", F.lit(name))
            for flat, name in ((True, "flat"), (False, "nested"))]
    return rows[0].unionByName(rows[1]).join(totals, list(REVISION)).select("layout", "archive_date", "source_id", "n", "stops")


@query("written_manifests", """
SELECT archive_date, source_id, captured_responses, entity_total, CAST(stops AS BIGINT) AS stop_time_update_total, files > 0 AS has_files,
  captured_responses AS inputs, CASE WHEN stops IS NULL THEN captured_responses ELSE stops END AS artifact_rows FROM (
SELECT strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date, 'tpch' AS source_id,
  count(DISTINCT feed) AS captured_responses, count(DISTINCT o_orderkey) AS entity_total, count(l_orderkey) AS stops, 1 AS files FROM stops_v GROUP BY 1, 2
UNION ALL SELECT strftime(local_ts, '%Y-%m-%d'), source_id, count(*), 0, NULL, 1 FROM landing_v GROUP BY 1, 2)""")
def written_manifests(b: Bindings):
    _, _, _, _, _, result = _compacted(b)
    rows = F.aggregate("files", F.lit(0).cast("bigint"), lambda acc, f: acc + f["rows"])
    return result.manifests.select(
        "archive_date", "source_id", "captured_responses", "entity_total", "stop_time_update_total",
        (F.size("files") > 0).alias("has_files"), F.size("input_captures").cast("bigint").alias("inputs"), rows.alias("artifact_rows"))


@query("written_footers", """
SELECT 'flat' AS layout, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date, 'tpch' AS source_id,
  count(*) AS n, 'ZSTD' AS codec, TRUE AS bounded FROM stops_v GROUP BY 1, 2, 3
UNION ALL SELECT 'nested', strftime(local_ts, '%Y-%m-%d'), source_id, count(*), 'ZSTD', TRUE FROM landing_v GROUP BY 1, 2, 3""")
def written_footers(b: Bindings):
    """Rows, codec and row groups of every revision, from the footers of its parts alone."""
    root, _, _, _, _, _ = _compacted(b)
    footers = scan_footers(b.spark, root)
    nested = F.col("provenance")["schema_version"] == "1"
    return footers.groupBy(F.when(nested, "nested").otherwise("flat").alias("layout"), "archive_date", "source_id").agg(
        F.sum("rows").alias("n"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("codecs")))), ",").alias("codec"),
        ((F.max("largest_row_group") <= 100000) & (F.min("row_groups") >= 1)).alias("bounded"))


def _provenance_sql() -> str:
    values = {"format_version": "'1'", "schema_version": "CASE WHEN source_id = 'tpch' THEN '2' ELSE '1' END", "application_version": "'1.0'",
              "protobuf_revision": "'r1'", "config_fingerprint": "'f'", "source_id": "source_id", "stream_id": "CASE WHEN source_id = 'tpch' THEN 'orders' ELSE 'pages' END",
              "archive_date": "archive_date", "timezone": "timezone", "license_url": "'https://example.test/license/' || source_id",
              "attribution": "'by ' || source_id"}
    pairs = ", ".join(f"struct_pack(k := '{k}', v := {v})" for k, v in values.items())
    return f"""
SELECT source_id, archive_date, e.k AS key, e.v AS value, TRUE AS sound FROM (SELECT *, unnest([{pairs}]) AS e FROM (
  SELECT DISTINCT 'tpch' AS source_id, 'UTC' AS timezone, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date FROM stops_v
  UNION SELECT DISTINCT source_id, tz, strftime(local_ts, '%Y-%m-%d') FROM landing_v))"""


@query("footer_provenance", _provenance_sql())
def footer_provenance(b: Bindings):
    """What each part says of its origin, held against the documents; the time of the run is left out."""
    root, captures, bodies, days, streams, _ = _compacted(b)
    described = streams.withColumns({"license_url": F.concat(F.lit("https://example.test/license/"), "source_id"),
                                     "attribution": F.concat(F.lit(" by "), "source_id", F.lit(" "))})
    again = days.withColumn("revision", F.lit(2))
    ticks = reconcile.ticks_of(captures).join(captures.select("tick_id", "archive_date"), "tick_id")
    result = compact.compact_days(b.spark, root, captures, ticks, bodies, described, again, b.destinations(), now(), config_fingerprint="f",
                                  application_version="1.0", protobuf_revision="r1")
    footers = R.materialize(scan_footers(b.spark, root, R.materialize(again, root, "again")), root, "footers")
    broken = footer_violations(result.manifests, result.files, footers).select(*REVISION).distinct().withColumn("_broken", F.lit(True))
    told = footers.select(*REVISION, F.explode("provenance").alias("key", "value")).filter("key <> 'generated_at'").distinct()
    return told.join(broken, list(REVISION), "left").select("source_id", "archive_date", "key", "value", F.col("_broken").isNull().alias("sound"))


@query("verify_manifest_rules", """
SELECT source_id, stream_id, archive_date, revision, violation FROM (
  SELECT m.*, unnest(list_filter([
    CASE WHEN dom % 11 = 1 THEN 'format_version' END, CASE WHEN dom % 11 = 2 THEN 'schema_version' END,
    CASE WHEN l.compaction_id IS NULL THEN 'identity' END,
    CASE WHEN coalesce(i.n, 0) <> captured_responses OR captured_responses <> l.rows_ OR entity_total + CASE WHEN dom % 11 = 3 THEN 1 ELSE 0 END <> l.entities THEN 'aggregate_counts' END,
    CASE WHEN dom % 11 NOT IN (4, 5) AND (captured_responses <= 0 OR dom % 10 = 0) THEN 'ready_shape' END,
    CASE WHEN dom % 11 = 4 AND (captured_responses <> 0 OR dom % 10 <> 0) THEN 'empty_shape' END,
    CASE WHEN dom % 11 = 5 THEN 'dataset_status' END,
    CASE WHEN dom % 11 = 6 THEN 'destination_ids' END, CASE WHEN dom % 11 = 7 THEN 'destination_snapshot' END,
    CASE WHEN dom % 11 = 8 AND m.expected_kind <> 'trip_update' THEN 'flattened_kind' END,
    CASE WHEN dom % 11 = 8 AND m.expected_kind = 'trip_update' THEN 'flattened_total' END
  ], lambda x: x IS NOT NULL)) AS violation
  FROM manifests_v m LEFT JOIN (SELECT source_id, stream_id, archive_date, revision, compaction_id, rows_, entities FROM compactions_v) l
    USING (source_id, stream_id, archive_date, revision)
  LEFT JOIN (SELECT source_id, stream_id, archive_date, revision, count(*) AS n FROM manifest_inputs_v GROUP BY ALL) i
    USING (source_id, stream_id, archive_date, revision))""")
def verify_manifest_rules(b: Bindings):
    """Documents with one fault each, chosen by the day of month."""
    fault = F.dayofmonth(F.to_date("archive_date")) % 11
    entry = [F.struct(F.lit(i).alias("id"), F.lit(r).alias("required")) for i, r in (("a", True), ("b", False))]
    twice = [entry[0], entry[0]]
    documents = b.manifests().withColumns({
        "manifest_version": F.lit(1), "format_version": F.when(fault == 1, 2).otherwise(1),
        "schema_version": F.when(fault == 2, 3).when(fault == 8, 2).otherwise(1),
        "entity_total": F.col("entity_total") + F.when(fault == 3, 1).otherwise(0),
        "dataset_status": F.when(fault == 4, "no_captured_responses").when(fault == 5, "odd").otherwise("ready"),
        "destinations": F.when(fault == 6, F.array(*twice)).otherwise(F.array(*entry)),
        "required_destinations": F.when(fault == 6, F.array(F.lit("a"), F.lit("a"))).when(fault == 7, F.array(F.lit("b"))).otherwise(F.array(F.lit("a"))),
        "stop_time_update_total": F.lit(None).cast("bigint")})
    files = b.compactions().filter("manifest_path <> ''").select(*REVISION)
    # unseen revisions have no files; give each its own listing, as their directories would
    unseen = b.manifests().filter(F.dayofmonth(F.to_date("archive_date")) % 10 != 0).select(*REVISION).distinct()
    return verify.manifest_violations(documents, b.compactions(), b.manifest_inputs(), files.unionByName(unseen).distinct())


@query("verify_null_fields", """
SELECT source_id, stream_id, archive_date, revision, violation FROM (SELECT *, CASE CAST(substr(archive_date, 9, 2) AS INTEGER) % 6
  WHEN 1 THEN 'format_version' WHEN 2 THEN 'schema_version' WHEN 3 THEN 'aggregate_counts' WHEN 4 THEN 'dataset_status' WHEN 5 THEN 'aggregate_counts' END AS violation
  FROM compactions_v WHERE rows_ > 0) WHERE violation IS NOT NULL""")
def verify_null_fields(b: Bindings):
    """Documents that lack one required field, chosen by the day of month; nothing else is wrong with them."""
    known = b.compactions().filter("rows > 0")
    fault = F.dayofmonth(F.to_date("archive_date")) % 6
    lacking = lambda at, value: F.when(fault != at, value)
    documents = b.manifests().join(known.select(*REVISION), list(REVISION), "left_semi").withColumns({
        "manifest_version": lacking(1, F.lit(1)), "format_version": F.lit(1), "schema_version": lacking(2, F.lit(1)),
        "captured_responses": lacking(3, F.col("captured_responses")), "dataset_status": lacking(4, F.lit("ready")),
        "entity_total": lacking(5, F.col("entity_total")), "destinations": F.array(F.struct(F.lit("a").alias("id"), F.lit(True).alias("required"))),
        "required_destinations": F.array(F.lit("a")), "stop_time_update_total": F.lit(None).cast("bigint")})
    inputs = b.inputs().join(known.select("compaction_id", *REVISION), "compaction_id")
    return verify.manifest_violations(documents, known, inputs, known.select(*REVISION))


@query("verify_revisions", """
SELECT 'artifact_integrity' AS violation, source_id, strftime(local_ts, '%Y-%m-%d') AS archive_date FROM landing_v WHERE page_id % 4 = 2 GROUP BY ALL""")
def verify_revisions(b: Bindings):
    """Fresh revisions are sound; one source's recorded hashes are then altered."""
    root, _, _, _, _, result = _compacted(b)
    files = R.scan_files(b.spark, root)
    altered = files.withColumn("sha256", F.when(F.col("source_id") == "s2", F.lit("0" * 64)).otherwise(F.col("sha256")))
    matching = compact.ledger_rows(result.manifests, altered)
    found = verify.verify_revisions(result.manifests, matching, result.inputs, altered, R.scan_parts(b.spark, root))
    return found.select("violation", "source_id", "archive_date").distinct()


@query("content_checks", """
SELECT 'row_count_mismatch' AS violation, CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT feed FROM stops_v WHERE feed % 10 = 3)
UNION ALL SELECT 'entity_count_mismatch', count(*) FROM landing_v WHERE page_id % 10 = 3
UNION ALL SELECT 'missing_capture', count(*) FROM landing_v WHERE page_id % 10 = 4
UNION ALL SELECT 'body_hash_mismatch', count(*) FROM landing_v WHERE page_id % 10 = 5""")
def content_checks(b: Bindings):
    """Rows that lost or changed something, found again by the content checks."""
    captured = feed_captures(b).withColumns({
        "parse_status": F.lit("valid"), "validation_flags": F.array(F.lit("ok")), "entity_count": F.lit(1)})
    bodies, metadata, days = captured.select("raw_path", "body"), captured.drop("body"), _days_of(captured)
    number = F.regexp_extract("capture_id", r"^[a-z]([0-9]+)", 1).cast("bigint")
    flat = compact.flattened_plan(metadata, bodies, days)
    # one more row for every tenth feed: its counts can no longer agree
    doubled = flat.unionByName(flat.filter(number % 10 == 3))
    flat_found = compact.check_flattened(doubled, compact.expected_counts(metadata, bodies, days))
    pages = b.landing()
    page_days = _days_of(pages)
    nested = compact.nested_plan(pages.drop("body"), pages.select("raw_path", "body"), page_days).filter(number % 10 != 4) \
        .withColumns({"entity_count": F.when(number % 10 == 3, 7).otherwise(F.col("entity_count")),
                      "feed_message_pb": F.when(number % 10 == 5, F.lit("x").cast("binary")).otherwise(F.col("feed_message_pb"))})
    nested_found = compact.check_nested(nested, compact.day_captures(pages, page_days, flattened=False))
    both = flat_found.select("violation", "capture_id").unionByName(nested_found.select("violation", "capture_id"))
    return both.select("violation", F.split_part("capture_id", F.lit("-"), F.lit(1)).alias("c")).distinct() \
        .groupBy("violation").agg(F.count(F.lit(1)).alias("n"))


@query("publish_and_checksum", """
SELECT archive_date, source_id, 'verified' AS status, 'published' AS revision_status FROM (
SELECT strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date, 'tpch' AS source_id FROM stops_v GROUP BY 1, 2
UNION SELECT strftime(local_ts, '%Y-%m-%d'), source_id FROM landing_v)""")
def publish_and_checksum(b: Bindings):
    """Copy every revision to a destination, artifacts before manifests, and read it back."""
    root, _, _, _, streams, result = _compacted(b)
    target = scratch_dir(b.spark, "destination")
    destinations = b.destinations().filter("required").withColumn("remote", F.lit(target))
    queue = compact.queue_publications(result.compactions, destinations, now())
    state = R.materialize(queue, root, "queue")
    done = publish.publish_due(b.spark, root, state, result.compactions, result.manifests, destinations, streams, now(), F.lit(0.5))
    after = publish.apply_changes(state, done, "publication_id")
    released = publish.release(result.compactions, after, done.filter("status = 'verified'"), now())
    return after.join(released.select("compaction_id", *REVISION[:3], F.col("status").alias("revision_status")), "compaction_id", "left") \
        .select("archive_date", "source_id", "status", "revision_status")


@query("reconcile_counters", """
SELECT (SELECT count(*) FROM landing_v WHERE page_id % 4 = 1) AS captures_registered,
  (SELECT count(*) FROM (SELECT 'tpch' AS s, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS d FROM stops_v
    UNION SELECT source_id, strftime(local_ts, '%Y-%m-%d') FROM landing_v)) AS revisions_adopted, CAST(0 AS BIGINT) AS corrupt""")
def reconcile_counters(b: Bindings):
    """A ledger that lost a quarter of its captures and all of its revisions."""
    root, captures, _, _, _, result = _compacted(b)
    pages = b.landing()
    write_landing(pages, root)
    kept = pages.filter("page_id % 4 <> 1")
    bodies = B.scan_bodies(b.spark, root, in_tasks=True)
    sidecars = B.scan_sidecars(b.spark, root, in_tasks=True)
    checked = reconcile.check_sidecars(sidecars, _hashed(bodies), kept)
    classified = reconcile.classify_files(B.list_bodies(b.spark, root, in_tasks=True), sidecars, kept)
    nothing = result.compactions.filter("false")
    found = verify.verify_revisions(result.manifests, nothing, result.inputs, result.files, R.scan_parts(b.spark, root))
    adopted = reconcile.adoptable(result.manifests, nothing, result.inputs, captures, found)
    return reconcile.reconcile_counters(checked, classified, adopted, found)
