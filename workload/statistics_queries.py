"""Daily statistics, manifests, summaries and health tables."""

from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.operators import metrics as M
from transitlake.operators import statistics as S
from transitlake.operators.ledger import next_revision
from transitlake.plans.manifest import build_manifests, daily_summaries
from workload.bindings import Bindings, now, text
from workload.oracle_views import stamp
from workload.registry import query

DAY = "source_id, stream_id, archive_date"
FAILED = """CAST(count(*) FILTER (WHERE error_category = 'http_status') AS BIGINT) AS http_failures,
  CAST(count(*) FILTER (WHERE error_category IN ('dns','connect','tls','timeout','network')) AS BIGINT) AS network_failures"""


@query("day_stats", f"""
SELECT {DAY}, count(*) AS scheduled_ticks, count(*) FILTER (WHERE result = 'skipped') AS skipped_ticks, {FAILED}
FROM ticks_v GROUP BY {DAY}""")
def day_stats(b: Bindings):
    return S.day_stats(b.ticks())


@query("failure_category_counts", f"""
SELECT {DAY}, error_category, count(*) AS n FROM ticks_v WHERE error_category <> '' GROUP BY ALL""")
def failure_category_counts(b: Bindings):
    return S.failure_category_counts(b.ticks())


@query("parse_status_counts", f"""
SELECT {DAY}, parse_status, count(*) AS n FROM captures_v GROUP BY ALL""")
def parse_status_counts(b: Bindings):
    return S.parse_status_counts(b.captures())


@query("validation_flag_counts", f"""
SELECT {DAY}, flag, count(*) AS n FROM (SELECT *, unnest(flags) AS flag FROM captures_v) GROUP BY {DAY}, flag""")
def validation_flag_counts(b: Bindings):
    return S.validation_flag_counts(b.captures())


@query("valid_invalid_counts", f"""
SELECT {DAY}, count(*) FILTER (WHERE is_valid) AS valid_snapshots, count(*) FILTER (WHERE NOT is_valid) AS invalid_payloads,
  count(*) AS captured_responses, CAST(coalesce(sum(entity_count), 0) AS BIGINT) AS entity_total
FROM captures_v GROUP BY {DAY}""")
def valid_invalid_counts(b: Bindings):
    return S.capture_stats(b.captures()).select(
        *S.DAY, "valid_snapshots", "invalid_payloads", "captured_responses", "entity_total")


@query("feed_timestamp_range", f"""
SELECT {DAY}, min(feed_timestamp) FILTER (WHERE is_valid) AS earliest_feed_timestamp,
  max(feed_timestamp) FILTER (WHERE is_valid) AS latest_feed_timestamp
FROM captures_v GROUP BY {DAY}""")
def feed_timestamp_range(b: Bindings):
    return S.capture_stats(b.captures()).select(
        *S.DAY, F.col("earliest_feed_timestamp").cast("bigint").alias("earliest_feed_timestamp"),
        F.col("latest_feed_timestamp").cast("bigint").alias("latest_feed_timestamp"))


@query("first_last_capture", f"""
SELECT DISTINCT {DAY}, {stamp("first_value(completed_at) OVER w")} AS earliest_capture,
  {stamp("last_value(completed_at) OVER w")} AS latest_capture
FROM captures_v WINDOW w AS (PARTITION BY {DAY} ORDER BY scheduled_at, capture_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def first_last_capture(b: Bindings):
    return S.capture_stats(b.captures()).select(
        *S.DAY, text(F.col("earliest_capture")).alias("earliest_capture"),
        text(F.col("latest_capture")).alias("latest_capture"))


GAPS = f"""(SELECT {DAY}, CAST(greatest(coalesce(max(gap), 0), 0) AS BIGINT) AS largest_fetch_gap_ms FROM (
  SELECT {DAY}, trunc((epoch_us(completed_at) - epoch_us(lag(completed_at)
    OVER (PARTITION BY {DAY} ORDER BY scheduled_at, capture_id))) / 1000) AS gap FROM captures_v) GROUP BY {DAY})"""


@query("largest_fetch_gap", f"SELECT * FROM {GAPS}")
def largest_fetch_gap(b: Bindings):
    return S.largest_fetch_gap(b.captures())


@query("input_capture_list", f"""
SELECT {DAY}, capture_id AS id, body_sha256 AS sha256, decoded_length AS bytes FROM captures_v""")
def input_capture_list(b: Bindings):
    return S.input_captures(b.captures()).drop("scheduled_at")


@query("url_agreement", f"""
SELECT {DAY}, min(u) AS captured_url, min(u) = max(u) AS urls_agree FROM (
  SELECT {DAY}, CASE WHEN event_id % 200 = 7 THEN sanitized_url || '/moved' ELSE sanitized_url END AS u FROM captures_v)
GROUP BY {DAY}""")
def url_agreement(b: Bindings):
    moved = F.when(F.col("event_id") % 200 == 7, F.concat("sanitized_url", F.lit("/moved"))).otherwise(F.col("sanitized_url"))
    return S.url_agreement(b.captures().withColumn("sanitized_url", moved))


@query("build_manifest", f"""
SELECT t.source_id, t.stream_id, t.archive_date, t.scheduled_ticks, t.skipped_ticks, t.http_failures, t.network_failures,
  coalesce(c.n, 0) AS captured_responses, coalesce(c.valid, 0) AS valid_snapshots, coalesce(c.n - c.valid, 0) AS invalid_payloads,
  coalesce(c.entities, 0) AS entity_total, c.lo AS earliest_feed_timestamp, c.hi AS latest_feed_timestamp,
  coalesce(g.largest_fetch_gap_ms, 0) AS largest_fetch_gap_ms, c.first_capture AS earliest_capture,
  CASE WHEN c.n IS NULL THEN 'no_captured_responses' ELSE 'ready' END AS dataset_status,
  'https://' || t.source_id || '.example.test:8443/' || t.stream_id AS sanitized_url,
  coalesce(r.top, 0) + 1 AS revision, CASE WHEN r.top > 0 THEN r.top END AS predecessor_revision,
  CASE WHEN t.stream_id = 'purchase' THEN 2 ELSE 1 END AS schema_version,
  CASE WHEN t.stream_id = 'purchase' THEN 0 END AS stop_time_update_total,
  {stamp("timezone('UTC', timezone(s.timezone, CAST(t.d AS TIMESTAMP)))")} AS day_start_utc,
  {stamp("timezone('UTC', timezone(s.timezone, CAST(t.d AS TIMESTAMP) + INTERVAL 1 DAY))")} AS day_end_utc,
  'data of ' || t.source_id AS attribution, 'primary' AS required, 'primary,secondary' AS destinations,
  coalesce(c.decode_failures, 0) AS decode_failures, coalesce(t.timeouts, 0) AS timeouts, coalesce(c.incomplete, 0) AS incomplete
FROM (SELECT {DAY}, d, count(*) AS scheduled_ticks, count(*) FILTER (WHERE result = 'skipped') AS skipped_ticks, {FAILED},
        count(*) FILTER (WHERE error_category = 'timeout') AS timeouts
      FROM ticks_v GROUP BY {DAY}, d) t
JOIN streams_v s USING (source_id, stream_id)
LEFT JOIN (SELECT {DAY}, count(*) AS n, count(*) FILTER (WHERE is_valid) AS valid,
        CAST(coalesce(sum(entity_count), 0) AS BIGINT) AS entities,
        min(feed_timestamp) FILTER (WHERE is_valid) AS lo, max(feed_timestamp) FILTER (WHERE is_valid) AS hi,
        count(*) FILTER (WHERE parse_status = 'protobuf_decode') AS decode_failures,
        count(*) FILTER (WHERE NOT transport_complete) AS incomplete,
        {stamp("arg_min(completed_at, epoch_us(scheduled_at)::HUGEINT * 1000000 + event_id)")} AS first_capture
      FROM captures_v GROUP BY {DAY}) c USING (source_id, stream_id, archive_date)
LEFT JOIN {GAPS} g USING (source_id, stream_id, archive_date)
LEFT JOIN (SELECT {DAY}, max(revision) AS top FROM compactions_v GROUP BY {DAY}) r USING (source_id, stream_id, archive_date)""")
def build_manifest(b: Bindings):
    ticks, captures = b.ticks(), b.captures()
    days = next_revision(ticks.select(*S.DAY).distinct(), b.compactions())
    rows = build_manifests(captures, ticks, b.streams(), days, b.destinations(), now())
    zero = F.lit(0).cast("bigint")
    return rows.select(
        *S.DAY, "scheduled_ticks", "skipped_ticks", "http_failures", "network_failures", "captured_responses",
        "valid_snapshots", "invalid_payloads", "entity_total",
        F.col("earliest_feed_timestamp").cast("bigint").alias("earliest_feed_timestamp"),
        F.col("latest_feed_timestamp").cast("bigint").alias("latest_feed_timestamp"),
        "largest_fetch_gap_ms", text(F.col("earliest_capture")).alias("earliest_capture"), "dataset_status",
        "sanitized_url", "revision", "predecessor_revision", "schema_version", "stop_time_update_total",
        text(F.col("day_start_utc")).alias("day_start_utc"), text(F.col("day_end_utc")).alias("day_end_utc"),
        "attribution", F.array_join("required_destinations", ",").alias("required"),
        F.array_join(F.transform("destinations", lambda d: d["id"]), ",").alias("destinations"),
        F.coalesce(F.try_element_at("parse_status_counts", F.lit("protobuf_decode")), zero).alias("decode_failures"),
        F.coalesce(F.try_element_at("failure_category_counts", F.lit("timeout")), zero).alias("timeouts"),
        F.coalesce(F.try_element_at("validation_flag_counts", F.lit("transport_incomplete")), zero).alias("incomplete"))


@query("daily_summary", f"""
SELECT {DAY}, t.n AS scheduled_ticks, t.skipped AS skipped_ticks, t.http_failures, t.network_failures,
  coalesce(c.n, 0) AS captured_responses, coalesce(c.valid, 0) AS valid_snapshots,
  coalesce(c.n - c.valid, 0) AS invalid_payloads, coalesce(c.bad, 0) AS decode_failures
FROM (SELECT {DAY}, count(*) AS n, count(*) FILTER (WHERE result = 'skipped') AS skipped, {FAILED} FROM ticks_v GROUP BY {DAY}) t
LEFT JOIN (SELECT {DAY}, count(*) AS n, count(*) FILTER (WHERE is_valid) AS valid,
  count(*) FILTER (WHERE parse_status = 'protobuf_decode') AS bad FROM captures_v GROUP BY {DAY}) c USING ({DAY})""")
def daily_summary(b: Bindings):
    ticks = b.ticks()
    rows = daily_summaries(b.captures(), ticks, ticks.select(*S.DAY).distinct(), now())
    bad = F.try_element_at("parse_status_counts", F.lit("protobuf_decode"))
    return rows.withColumn("decode_failures", F.coalesce(bad, F.lit(0).cast("bigint"))) \
        .drop("parse_status_counts", "summarized_at")


@query("earliest_tick", f"""
SELECT source_id, stream_id, {stamp("min(scheduled_at)")} AS earliest_tick FROM ticks_v GROUP BY source_id, stream_id""")
def earliest_tick(b: Bindings):
    return S.earliest_tick(b.ticks()).withColumn("earliest_tick", text(F.col("earliest_tick")))


@query("outcome_counters", """
SELECT 'fetch' AS metric, source_id AS a, stream_id AS b, result AS label, count(*) AS n FROM ticks_v GROUP BY ALL
UNION ALL SELECT 'flag', source_id, stream_id, flag, count(*) FROM (SELECT *, unnest(flags) AS flag FROM captures_v) GROUP BY ALL
UNION ALL SELECT 'skip', source_id, stream_id, skip_reason, count(*) FROM ticks_v WHERE result = 'skipped' GROUP BY ALL
UNION ALL SELECT 'publication', destination_id, '', status, count(*) FROM publications_v
  WHERE status IN ('verified', 'retry', 'permanent_failure') GROUP BY ALL""")
def outcome_counters(b: Bindings):
    def shape(df, metric, a, second, label):
        return df.select(F.lit(metric).alias("metric"), F.col(a).alias("a"), second.alias("b"),
                         F.col(label).alias("label"), "n")

    stream = F.col("stream_id")
    return (shape(M.fetch_attempts(b.ticks()), "fetch", "source_id", stream, "result")
            .unionByName(shape(M.validation_totals(b.captures()), "flag", "source_id", stream, "flag"))
            .unionByName(shape(M.skipped_totals(b.ticks()), "skip", "source_id", stream, "skip_reason"))
            .unionByName(shape(M.publication_totals(b.publications()), "publication", "destination_id", F.lit(""), "result")))


def histogram_sql(value: str, bounds: str, view: str = "captures_v") -> str:
    return f"""SELECT source_id, stream_id, le, count(*) FILTER (WHERE v <= le) AS n
FROM (SELECT source_id, stream_id, {value} AS v FROM {view}) CROSS JOIN (
  SELECT unnest({bounds}) AS le UNION ALL SELECT 'infinity'::DOUBLE) GROUP BY ALL"""


@query("fetch_seconds_histogram", histogram_sql(
    "duration_ms / 1000.0", "[0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]::DOUBLE[]"))
def fetch_seconds_histogram(b: Bindings):
    return M.histogram(b.captures(), F.col("duration_ms") / 1000, K.FETCH_SECONDS_BUCKETS)


@query("body_bytes_histogram", """
SELECT source_id, le, count(*) FILTER (WHERE body_bytes <= le) AS n FROM landing_v CROSS JOIN (
  SELECT unnest([256, 1024, 4096, 16384, 65536, 262144, 1048576, 4194304, 16777216, 67108864]::DOUBLE[]) AS le
  UNION ALL SELECT 'infinity'::DOUBLE) GROUP BY ALL""")
def body_bytes_histogram(b: Bindings):
    return M.histogram(b.landing(), F.col("decoded_length").cast("double"), K.BODY_BYTES_BUCKETS, ["source_id"])


@query("publication_seconds_histogram", """
SELECT destination_id, le, count(*) FILTER (WHERE attempt_count * 60.0 <= le) AS n FROM publications_v CROSS JOIN (
  SELECT unnest([0.25, 1, 4, 16, 64, 256, 1024, 4096, 16384, 65536]::DOUBLE[]) AS le
  UNION ALL SELECT 'infinity'::DOUBLE) GROUP BY ALL""")
def publication_seconds_histogram(b: Bindings):
    return M.histogram(b.publications(), F.col("attempt_count") * 60.0, K.PUBLICATION_SECONDS_BUCKETS, ["destination_id"])


@query("compaction_seconds_histogram", """
SELECT source_id, stream_id, le, count(*) FILTER (WHERE rows_ / 4.0 <= le) AS n FROM compactions_v CROSS JOIN (
  SELECT unnest([0.1, 0.4, 1.6, 6.4, 25.6, 102.4, 409.6, 1638.4, 6553.6]::DOUBLE[]) AS le
  UNION ALL SELECT 'infinity'::DOUBLE) GROUP BY ALL""")
def compaction_seconds_histogram(b: Bindings):
    rounded = [round(x, 1) for x in K.COMPACTION_SECONDS_BUCKETS]
    return M.histogram(b.compactions(), F.col("rows") / 4.0, rounded)


@query("last_seen_gauges", """
SELECT source_id, stream_id, CAST(floor(max(epoch(completed_at))) AS BIGINT) AS last_capture,
  CAST(floor(max(epoch(completed_at)) FILTER (WHERE is_valid)) AS BIGINT) AS last_valid_capture,
  arg_max(feed_timestamp, epoch_us(completed_at)::HUGEINT * 1000000 + event_id)
    FILTER (WHERE is_valid AND feed_timestamp IS NOT NULL) AS last_feed_timestamp
FROM captures_v GROUP BY source_id, stream_id""")
def last_seen_gauges(b: Bindings):
    return M.last_seen(b.captures()).withColumn("last_feed_timestamp", F.col("last_feed_timestamp").cast("bigint"))
