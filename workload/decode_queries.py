"""Decoding, projection and flattening."""

from pyspark.sql import functions as F

from transitlake.functions import bodies as B
from transitlake.operators import decode as D
from transitlake.operators.flatten import flatten_trip_updates, projected_rows, stop_time_updates
from transitlake.operators.project import nested_rows
from transitlake.schemas import ENTITY_KIND_MESSAGE, FEED_MESSAGE, TRIP_UPDATE_MESSAGE
from workload.bindings import Bindings, text
from workload.feeds import encoded_feeds, encoded_mixed, feed_captures
from workload.oracle_views import stamp
from workload.registry import query


def decoded_trips(b: Bindings):
    captured = feed_captures(b).withColumns({"parse_status": F.lit("valid"), "validation_flags": F.array(F.lit("ok"))})
    return D.decode_bodies(captured, wanted=TRIP_UPDATE_MESSAGE, keep_body=False)


@query("decode_flatten_trip_updates", """
SELECT 'o' || o_orderkey AS entity_id, CAST(o_orderkey AS VARCHAR) AS trip_id, o_orderpriority AS route_id,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 END AS direction_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'bus ' || (o_orderkey % 7) ELSE '' END AS vehicle_label,
  '' AS vehicle_id, '' AS start_time, 0 AS schedule_relationship,
  o_orderkey % 10 = 0 AS is_deleted,
  CAST(1704067200 + feed AS BIGINT) AS feed_timestamp, CAST(feed % 2 AS INTEGER) AS incrementality, '2.0' AS feed_version,
  CAST(l_linenumber AS BIGINT) AS stop_sequence, CAST(l_partkey AS VARCHAR) AS stop_id,
  CAST(l_quantity AS INTEGER) AS arrival_delay, CAST(epoch(l_shipdate) AS BIGINT) AS departure_time,
  CAST(NULL AS BIGINT) AS arrival_time, CAST(NULL AS VARCHAR) AS license_plate
FROM stops_v""")
def decode_flatten(b: Bindings):
    return flatten_trip_updates(decoded_trips(b)).select(
        "entity_id", "trip_id", "route_id", "direction_id", "vehicle_label", "vehicle_id", "start_time",
        "schedule_relationship", "is_deleted", F.col("feed_timestamp").cast("bigint").alias("feed_timestamp"),
        "incrementality", "feed_version", "stop_sequence", "stop_id", "arrival_delay", "departure_time",
        "arrival_time", "license_plate")


@query("flat_provenance", f"""
SELECT CAST(count(*) AS BIGINT) AS n, 'https://example.test/orders' AS feed_url,
  strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30), '%Y-%m-%d') AS archive_date,
  {stamp("TIMESTAMP '2024-01-01 00:00:02' + to_seconds(feed * 30)")} AS fetch_timestamp,
  {stamp("TIMESTAMP '2024-01-01 00:00:00' + to_seconds(feed * 30)")} AS scheduled_at,
  'valid' AS parse_status, 'ok' AS flag, 'tpch/orders/UTC' AS stream
FROM stops_v GROUP BY feed""")
def flat_provenance(b: Bindings):
    flat = flatten_trip_updates(decoded_trips(b))
    return flat.groupBy(
        "feed_url", "archive_date", text(F.col("fetch_timestamp")).alias("fetch_timestamp"),
        text(F.col("scheduled_at")).alias("scheduled_at"), "parse_status",
        F.element_at("validation_flags", 1).alias("flag"),
        F.concat_ws("/", "source_id", "stream_id", "archive_timezone").alias("stream"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("projected_row_counts", """
SELECT feed, CAST(count(*) AS BIGINT) AS projected_rows, CAST(count(l_orderkey) AS BIGINT) AS stop_time_updates
FROM stops_v GROUP BY feed""")
def projected_row_counts(b: Bindings):
    return decoded_trips(b).groupBy("feed").agg(
        F.sum(projected_rows()).alias("projected_rows"), F.sum(stop_time_updates()).alias("stop_time_updates"))


@query("header_metadata", """
SELECT feed, '2.0' AS feed_version, CAST(feed % 2 AS INTEGER) AS incrementality,
  CAST(1704067200 + feed AS BIGINT) AS feed_timestamp, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS entity_count,
  'valid' AS parse_status
FROM stops_v GROUP BY feed""")
def header_metadata(b: Bindings):
    decoded = D.header_metadata(D.decode_bodies(encoded_feeds(b), wanted=ENTITY_KIND_MESSAGE, keep_body=False))
    # one row per feed: the bodies of a split feed are added up
    return decoded.groupBy("feed", "feed_version", "incrementality", "parse_status",
                           F.col("feed_timestamp").cast("bigint").alias("feed_timestamp")) \
        .agg(F.sum("entity_count").alias("entity_count"))


@query("decoded_validation_flags", """
SELECT feed, unnest(list_sort(list_filter([
    CASE WHEN feed % 2 = 1 THEN 'differential_incrementality' END,
    CASE WHEN feed % 7 > 2 THEN 'feed_timestamp_stale' END,
    CASE WHEN feed % 7 = 2 THEN 'feed_timestamp_future' END,
    CASE WHEN feed % 3 = 0 THEN 'unexpected_entity_kind' END], lambda x: x IS NOT NULL))) AS flag
FROM (SELECT DISTINCT feed FROM stops_v)""")
def decoded_validation_flags(b: Bindings):
    feed = F.col("feed")
    shift = F.when(feed % 7 > 2, 86401).when(feed % 7 == 2, -301).otherwise(0)
    observed = encoded_feeds(b).withColumns({
        "completed_at": F.timestamp_seconds(F.lit(1704067200) + feed + shift),
        "expected_kind": F.when(feed % 3 == 0, "alert").when(feed % 3 == 1, "trip_update").otherwise("mixed"),
    })
    decoded = D.header_metadata(D.decode_bodies(observed, wanted=ENTITY_KIND_MESSAGE, keep_body=False))
    return D.validation_flags(decoded).select("feed", F.explode("validation_flags").alias("flag")).distinct()


@query("nested_projection", """
SELECT 'v' || c_custkey AS entity_id, CAST(c_custkey AS VARCHAR) AS vehicle_id, c_name AS label,
  CAST(c_nationkey AS DOUBLE) AS latitude, -c_nationkey - 0.5::DOUBLE AS longitude, c_acctbal AS odometer,
  90 + c_nationkey AS occupancy_status, CAST(c_nationkey % 3 AS INTEGER) AS carriages,
  CAST(NULL AS INTEGER) AS cause, CAST(NULL AS VARCHAR) AS header_text, CAST(NULL AS VARCHAR) AS route_id,
  CAST(NULL AS VARCHAR) AS active_start, FALSE AS is_alert
FROM customer
UNION ALL
SELECT 'a' || s_suppkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, s_nationkey, s_name, 'r' || s_suppkey,
  CAST(18446744073709551615::UBIGINT - s_suppkey::UBIGINT AS VARCHAR), TRUE
FROM supplier""")
def nested_projection(b: Bindings):
    decoded = D.decode_bodies(encoded_mixed(b), wanted=FEED_MESSAGE, keep_body=False)
    e = decoded.select(F.explode("message.entity").alias("e"))
    vehicle, alert = F.col("e.vehicle"), F.col("e.alert")
    return e.select(
        F.col("e.id").alias("entity_id"), vehicle["vehicle"]["id"].alias("vehicle_id"),
        vehicle["vehicle"]["label"].alias("label"), vehicle["position"]["latitude"].cast("double").alias("latitude"),
        vehicle["position"]["longitude"].cast("double").alias("longitude"), vehicle["position"]["odometer"].alias("odometer"),
        vehicle["occupancy_status"].alias("occupancy_status"),
        F.when(vehicle.isNotNull(), F.size(vehicle["multi_carriage_details"])).alias("carriages"),
        alert["cause"].alias("cause"), alert["header_text"]["translation"][0]["text"].alias("header_text"),
        alert["informed_entity"][0]["route_id"].alias("route_id"),
        alert["active_period"][0]["start"].cast("string").alias("active_start"), alert.isNotNull().alias("is_alert"))


@query("nested_provenance", """
SELECT capture_id, source_id, stream_id, expected_kind, archive_date, tz AS archive_timezone, sanitized_url,
  stem || '.pb' AS raw_path, 200 AS http_status, duration_ms, CAST(1 + event_id % 2 AS INTEGER) AS attempt_count,
  decoded_length, transport_complete, parse_status,
  CASE WHEN parse_status <> 'valid' THEN 'DecodeError' END AS parse_error, body_sha256, entity_count,
  array_to_string(flags, ',') AS flags,
  '{"Content-Type":"' || CASE WHEN event_id % 17 = 0 THEN 'text/plain' WHEN event_id % 5 = 0
     THEN 'Application/X-Protobuf; charset=utf-8' ELSE 'application/x-protobuf' END
  || '","ETag":"' || CASE WHEN event_id % 3 = 0 THEN '' ELSE '\\u003c' || event_id || '\\u003e' END
  || '","Server":"x"}' AS response_headers_json,
  CAST(0 AS INTEGER) AS entities
FROM captures_v""")
def nested_provenance(b: Bindings):
    captured = b.captures().withColumn("body", F.col("props").cast("binary"))
    rows = nested_rows(D.decode_bodies(captured, wanted=FEED_MESSAGE))
    return rows.select(
        "capture_id", "source_id", "stream_id", "expected_kind", "archive_date", "archive_timezone", "sanitized_url",
        "raw_path", "http_status", "duration_ms", "attempt_count", "decoded_length", "transport_complete",
        "parse_status", "parse_error", "body_sha256", "entity_count",
        F.array_join("validation_flags", ",").alias("flags"), "response_headers_json",
        F.size("entities").alias("entities"))


@query("decode_malformed_bodies", """
SELECT capture_id, 'protobuf_decode' AS parse_status, 'DecodeError' AS parse_error, body_bytes, '' AS feed_version
FROM landing_v""")
def decode_malformed(b: Bindings):
    pages = b.landing().select("capture_id", "body", F.octet_length("body").cast("bigint").alias("body_bytes"))
    return D.header_metadata(D.decode_bodies(pages, wanted=ENTITY_KIND_MESSAGE, keep_body=False)).select(
        "capture_id", "parse_status", "parse_error", "body_bytes", "feed_version")


@query("ingest_flags", """
SELECT capture_id, unnest(flags) AS flag, unnest(generate_series(1, len(flags))) AS position FROM captures_v""")
def ingest_flags(b: Bindings):
    return b.captures().select("capture_id", F.posexplode("validation_flags").alias("p", "flag")).select(
        "capture_id", "flag", (F.col("p") + 1).cast("bigint").alias("position"))


@query("transport_completeness", """
SELECT capture_id, transport_complete, CASE WHEN is_valid THEN 'captured' ELSE 'captured_invalid' END AS result
FROM captures_v""")
def transport_completeness(b: Bindings):
    complete = B.transport_complete(F.lit(False), F.col("encoded_length"), F.col("advertised_length"))
    return b.captures().select("capture_id", complete.alias("transport_complete"),
                               B.capture_result(F.col("parse_status"), complete).alias("result"))


@query("body_hash_and_length", """
SELECT doc_id, sha256(text) AS sha256, CAST(octet_length(encode(text)) AS BIGINT) AS bytes FROM documents""")
def body_hash_and_length(b: Bindings):
    body = F.col("text").cast("binary")
    return b.table("documents").select("doc_id", B.body_sha256(body).alias("sha256"), B.body_bytes(body).alias("bytes"))


@query("safe_headers_json", """
SELECT capture_id, '{"Content-Type":"' || CASE WHEN event_id % 17 = 0 THEN 'text/plain' WHEN event_id % 5 = 0
     THEN 'Application/X-Protobuf; charset=utf-8' ELSE 'application/x-protobuf' END
  || CASE WHEN event_id % 3 = 0 THEN '"}' ELSE '","ETag":"\\u003c' || event_id || '\\u003e"}' END AS headers
FROM captures_v""")
def safe_headers_json(b: Bindings):
    return b.captures().select(
        "capture_id", B.stable_json(B.safe_headers(F.col("response_headers"))).alias("headers"))
