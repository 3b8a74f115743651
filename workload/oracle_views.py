"""The same bindings as DuckDB SQL, written on their own."""

VIEWS = """
events_v AS (
  SELECT *, 's' || (user_id % 4) AS source_id, event_type AS stream_id, ts AS scheduled_at, event_id % 20 AS m,
    CASE user_id % 4 WHEN 0 THEN 'America/Vancouver' WHEN 1 THEN 'America/Toronto'
                     WHEN 2 THEN 'America/Halifax' ELSE 'UTC' END AS tz,
    CASE event_type WHEN 'click' THEN 'vehicle_position' WHEN 'purchase' THEN 'trip_update'
                    WHEN 'signup' THEN 'alert' WHEN 'view' THEN 'mixed' WHEN 'error' THEN 'auto' END AS expected_kind,
    CASE WHEN event_id % 20 = 5 THEN 'protobuf_decode'
         WHEN event_id % 20 = 6 AND event_id % 3 = 0 THEN 'protobuf_required_field' ELSE 'valid' END AS parse_status
  FROM events),
local_v AS (
  SELECT *, timezone(tz, timezone('UTC', ts)) AS local_ts, CAST(timezone(tz, timezone('UTC', ts)) AS DATE) AS d
  FROM events_v),
streams_v AS (
  SELECT DISTINCT source_id, stream_id, expected_kind, tz AS timezone,
    'https://user:pw@' || source_id || '.example.test:8443/' || stream_id || '?key=1#top' AS url,
    30000 AS interval_ms,
    CASE source_id WHEN 's0' THEN 0 WHEN 's1' THEN 5000 WHEN 's2' THEN 60000 ELSE 20000 END AS max_start_lateness_ms
  FROM events_v),
ticks_v AS (
  SELECT 't' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS tick_id, source_id, stream_id, scheduled_at,
    ts + to_seconds(event_id % 23) AS started_at, d, strftime(d, '%Y-%m-%d') AS archive_date, event_id,
    CASE WHEN m = 0 THEN 'skipped' WHEN m <= 4 THEN 'failed'
         WHEN parse_status = 'valid' AND event_id % 33 <> 0 THEN 'captured' ELSE 'captured_invalid' END AS result,
    CASE WHEN m = 0 AND event_id % 40 = 0 THEN 'disk_pressure' WHEN m = 0 THEN 'late' ELSE '' END AS skip_reason,
    CASE m WHEN 1 THEN 'http_status' WHEN 2 THEN 'timeout' WHEN 3 THEN 'dns' WHEN 4 THEN 'body_too_large'
           ELSE '' END AS error_category
  FROM local_v),
caps_0 AS (
  SELECT *, 'c' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS capture_id,
    't' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS tick_id,
    ts + to_seconds(event_id % 7) AS completed_at, strftime(d, '%Y-%m-%d') AS archive_date,
    event_id % 33 <> 0 AS transport_complete,
    CASE WHEN parse_status = 'valid' AND event_id % 13 <> 0
         THEN CAST(floor(epoch(ts)) AS BIGINT) - event_id % 11
              + CASE WHEN event_id % 101 = 0 THEN -100000 WHEN event_id % 103 = 0 THEN 1000 ELSE 0 END
         END AS feed_timestamp,
    CASE WHEN parse_status = 'valid' THEN CASE WHEN event_id % 19 = 0 THEN 1 ELSE 0 END END AS incrementality,
    CASE WHEN parse_status <> 'protobuf_decode' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS entity_count,
    CAST(octet_length(encode(props)) AS BIGINT) AS decoded_length, sha256(props) AS body_sha256,
    'https://' || source_id || '.example.test:8443/' || stream_id AS sanitized_url,
    event_id % 5000 AS duration_ms
  FROM local_v WHERE m >= 5),
captures_v AS (
  SELECT *,
    'raw/source=' || source_id || '/stream=' || stream_id || '/date=' || archive_date || '/hour='
      || strftime(local_ts, '%H') || '/' || capture_id || '_' || substr(body_sha256, 1, 12) AS stem,
    list_concat(
      list_sort(list_filter([
        CASE WHEN incrementality = 1 THEN 'differential_incrementality' END,
        CASE WHEN make_timestamp(feed_timestamp * 1000000) > completed_at + INTERVAL 5 MINUTE THEN 'feed_timestamp_future' END,
        CASE WHEN make_timestamp(feed_timestamp * 1000000) < completed_at - INTERVAL 24 HOUR THEN 'feed_timestamp_stale' END,
        CASE WHEN parse_status = 'valid' AND feed_timestamp IS NULL THEN 'missing_feed_timestamp' END
      ], lambda x: x IS NOT NULL)),
      list_filter([
        CASE WHEN event_id % 17 = 0 THEN 'unexpected_content_type' END,
        CASE WHEN NOT transport_complete THEN 'transport_incomplete' END
      ], lambda x: x IS NOT NULL)) AS flags,
    parse_status = 'valid' AND transport_complete AS is_valid
  FROM caps_0),
days_v AS (SELECT DISTINCT source_id, stream_id, d, archive_date, day(d) AS dom FROM ticks_v),
revisions_v AS (
  SELECT days_v.*, r.revision, CAST((date_diff('day', DATE '2023-12-30', d) * 20 + CAST(substr(source_id, 2, 1) AS INTEGER) * 5
    + CASE stream_id WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END) * 10
    + r.revision AS BIGINT) AS compaction_id
  FROM days_v JOIN (VALUES (1), (2)) r(revision) ON r.revision = 1 OR dom % 4 = 0
  WHERE dom % 5 <> 4),
inputs_w AS (
  SELECT c.*, r.revision, r.dom, r.compaction_id
  FROM captures_v c JOIN revisions_v r USING (source_id, stream_id, archive_date)
  WHERE event_id % 10 <> 9 OR (r.revision = 2 AND r.dom % 8 = 0)),
compactions_v AS (
  SELECT r.*, coalesce(n, 0) AS rows_, coalesce(e, 0) AS entities,
    'parquet/format=v1/source=' || r.source_id || '/stream=' || r.stream_id || '/date=' || r.archive_date
      || '/revision=' || r.revision AS directory,
    CASE WHEN dom % 10 = 0 THEN '' ELSE 'parquet/format=v1/source=' || r.source_id || '/stream=' || r.stream_id
      || '/date=' || r.archive_date || '/revision=' || r.revision || '/manifest.json' END AS manifest_path,
    CASE WHEN dom % 10 = 0 THEN 0 ELSE r.compaction_id * 10 END AS data_bytes,
    CASE WHEN dom % 3 = 0 THEN 'ready' ELSE 'published' END AS status,
    CASE WHEN dom % 3 <> 0 THEN CAST(d AS TIMESTAMP) + INTERVAL 2 DAY END AS published_at
  FROM revisions_v r LEFT JOIN (SELECT compaction_id, count(*) AS n, sum(entity_count) AS e FROM inputs_w GROUP BY 1) t
    USING (compaction_id)),
publications_v AS (
  SELECT compaction_id * 2 + CASE WHEN n > 0 THEN 1 ELSE 0 END AS publication_id, compaction_id, id AS destination_id,
    n = 0 AS required, source_id, stream_id, archive_date, revision,
    ['pending', 'retry', 'uploading', 'verified', 'permanent_failure', 'retired', 'expired']
      [CAST((compaction_id + n) % 7 AS INTEGER) + 1] AS status,
    compaction_id % 9 AS attempt_count,
    CAST(d AS TIMESTAMP) + INTERVAL 1 DAY + to_minutes(compaction_id % 100) AS next_attempt_at
  FROM revisions_v JOIN (VALUES ('primary', 0), ('secondary', 3)) t(id, n) ON n = 0 OR dom % 6 <> 0),
destinations_v AS (
  SELECT DISTINCT destination_id AS id, required, 'lake/' || destination_id || '/' AS remote FROM publications_v),
summaries_v AS (SELECT source_id, stream_id, archive_date FROM days_v WHERE dom <= 2),
manifests_v AS (
  SELECT source_id, stream_id, archive_date, d, dom, rev AS revision, rows_ AS captured_responses, c.entities AS entity_total,
    CASE WHEN source_id = 's3' THEN '' ELSE 'https://' || source_id || '.example.test:8443/' || stream_id END AS sanitized_url,
    CASE WHEN source_id = 's2' AND stream_id = 'error' THEN 'unknown' ELSE
      CASE stream_id WHEN 'click' THEN 'vehicle_position' WHEN 'purchase' THEN 'trip_update'
                     WHEN 'signup' THEN 'alert' WHEN 'view' THEN 'mixed' WHEN 'error' THEN 'auto' END END AS expected_kind
  FROM (SELECT *, revision AS rev FROM compactions_v
        UNION ALL SELECT *, revision + 2 AS rev FROM compactions_v WHERE dom % 7 = 0) c),
manifest_inputs_v AS (
  SELECT source_id, stream_id, archive_date, revision,
    CASE WHEN event_id % 89 = 0 THEN 'x' || capture_id ELSE capture_id END AS id,
    CASE WHEN event_id % 97 = 0 THEN repeat('0', 64) ELSE body_sha256 END AS sha256
  FROM inputs_w),
landing_0 AS (
  SELECT *, 's' || (page_id % 4) AS source_id, 'p' || lpad(CAST(page_id AS VARCHAR), 12, '0') AS capture_id,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 600) AS scheduled_at, sha256(html) AS body_sha256,
    CASE page_id % 4 WHEN 0 THEN 'America/Vancouver' WHEN 1 THEN 'America/Toronto'
                     WHEN 2 THEN 'America/Halifax' ELSE 'UTC' END AS tz,
    regexp_replace(regexp_replace(url, '[?#].*$', ''), '//[^/]*@', '//') AS sanitized_url
  FROM pages),
landing_v AS (
  SELECT *, timezone(tz, timezone('UTC', scheduled_at)) AS local_ts,
    'raw/source=' || source_id || '/stream=pages/date=' || strftime(timezone(tz, timezone('UTC', scheduled_at)), '%Y-%m-%d')
      || '/hour=' || strftime(timezone(tz, timezone('UTC', scheduled_at)), '%H') || '/' || capture_id || '_'
      || substr(body_sha256, 1, 12) AS stem,
    CAST(octet_length(encode(html)) AS BIGINT) AS body_bytes
  FROM landing_0),
stops_v AS (
  SELECT o.*, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_shipdate, o_orderkey // 100 AS feed
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey)
"""


def over_views(select: str) -> str:
    return f"WITH {VIEWS.strip()}\n{select}"


def stamp(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
