"""Constant schemas. Nothing in the lake infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

UINT64 = T.DecimalType(20, 0)

# --- fixed values: the public GTFS-Realtime messages ---------------------------
# (field, number, type, label); label is one of req / opt / rep. Types starting with
# an upper-case letter are messages. Enums are listed as int32 so that numbers newer
# than this list are kept. Column order is the order written here.
MESSAGES: dict[str, tuple[tuple[str, int, str, str], ...]] = {
    "Alert": (
        ("active_period", 1, "TimeRange", "rep"),
        ("informed_entity", 5, "EntitySelector", "rep"),
        ("cause", 6, "int32", "opt"),
        ("effect", 7, "int32", "opt"),
        ("url", 8, "TranslatedString", "opt"),
        ("header_text", 10, "TranslatedString", "opt"),
        ("description_text", 11, "TranslatedString", "opt"),
        ("tts_header_text", 12, "TranslatedString", "opt"),
        ("tts_description_text", 13, "TranslatedString", "opt"),
        ("severity_level", 14, "int32", "opt"),
    ),
    "EntitySelector": (
        ("agency_id", 1, "string", "opt"),
        ("route_id", 2, "string", "opt"),
        ("route_type", 3, "int32", "opt"),
        ("trip", 4, "TripDescriptor", "opt"),
        ("stop_id", 5, "string", "opt"),
        ("direction_id", 6, "uint32", "opt"),
    ),
    "FeedEntity": (
        ("id", 1, "string", "req"),
        ("is_deleted", 2, "bool", "opt"),
        ("trip_update", 3, "TripUpdate", "opt"),
        ("vehicle", 4, "VehiclePosition", "opt"),
        ("alert", 5, "Alert", "opt"),
    ),
    "FeedHeader": (
        ("gtfs_realtime_version", 1, "string", "req"),
        ("incrementality", 2, "int32", "opt"),
        ("timestamp", 3, "uint64", "opt"),
    ),
    "FeedMessage": (
        ("header", 1, "FeedHeader", "req"),
        ("entity", 2, "FeedEntity", "rep"),
    ),
    "Position": (
        ("latitude", 1, "float", "req"),
        ("longitude", 2, "float", "req"),
        ("bearing", 3, "float", "opt"),
        ("odometer", 4, "double", "opt"),
        ("speed", 5, "float", "opt"),
    ),
    "TimeRange": (
        ("start", 1, "uint64", "opt"),
        ("end", 2, "uint64", "opt"),
    ),
    "TranslatedString": (("translation", 1, "Translation", "rep"),),
    "Translation": (
        ("text", 1, "string", "req"),
        ("language", 2, "string", "opt"),
    ),
    "TripDescriptor": (
        ("trip_id", 1, "string", "opt"),
        ("route_id", 5, "string", "opt"),
        ("direction_id", 6, "uint32", "opt"),
        ("start_time", 2, "string", "opt"),
        ("start_date", 3, "string", "opt"),
        ("schedule_relationship", 4, "int32", "opt"),
    ),
    "TripUpdate": (
        ("trip", 1, "TripDescriptor", "req"),
        ("vehicle", 3, "VehicleDescriptor", "opt"),
        ("stop_time_update", 2, "StopTimeUpdate", "rep"),
        ("timestamp", 4, "uint64", "opt"),
        ("delay", 5, "int32", "opt"),
        ("trip_properties", 6, "TripProperties", "opt"),
    ),
    "StopTimeEvent": (
        ("delay", 1, "int32", "opt"),
        ("time", 2, "int64", "opt"),
        ("uncertainty", 3, "int32", "opt"),
    ),
    "StopTimeUpdate": (
        ("stop_sequence", 1, "uint32", "opt"),
        ("stop_id", 4, "string", "opt"),
        ("arrival", 2, "StopTimeEvent", "opt"),
        ("departure", 3, "StopTimeEvent", "opt"),
        ("schedule_relationship", 5, "int32", "opt"),
        ("stop_time_properties", 6, "StopTimeProperties", "opt"),
    ),
    "StopTimeProperties": (("assigned_stop_id", 1, "string", "opt"),),
    "TripProperties": (
        ("trip_id", 1, "string", "opt"),
        ("start_date", 2, "string", "opt"),
        ("start_time", 3, "string", "opt"),
    ),
    "VehicleDescriptor": (
        ("id", 1, "string", "opt"),
        ("label", 2, "string", "opt"),
        ("license_plate", 3, "string", "opt"),
    ),
    "VehiclePosition": (
        ("trip", 1, "TripDescriptor", "opt"),
        ("vehicle", 8, "VehicleDescriptor", "opt"),
        ("position", 2, "Position", "opt"),
        ("current_stop_sequence", 3, "uint32", "opt"),
        ("stop_id", 7, "string", "opt"),
        ("current_status", 4, "int32", "opt"),
        ("timestamp", 5, "uint64", "opt"),
        ("congestion_level", 6, "int32", "opt"),
        ("occupancy_status", 9, "int32", "opt"),
        ("occupancy_percentage", 10, "uint32", "opt"),
        ("multi_carriage_details", 11, "CarriageDetails", "rep"),
    ),
    "CarriageDetails": (
        ("id", 1, "string", "opt"),
        ("label", 2, "string", "opt"),
        ("occupancy_status", 3, "int32", "opt"),
        ("occupancy_percentage", 4, "int32", "opt"),
        ("carriage_sequence", 5, "uint32", "opt"),
    ),
}

SCALAR_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bool": T.BooleanType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint32": T.LongType(),
    "uint64": UINT64,
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def message_struct(name: str) -> T.StructType:
    """The full nested StructType of one message."""
    fields = []
    for field, _, kind, label in MESSAGES[name]:
        dtype = SCALAR_TYPES[kind] if kind in SCALAR_TYPES else message_struct(kind)
        if label == "rep":
            dtype = T.ArrayType(dtype)
        fields.append(T.StructField(field, dtype))
    return T.StructType(fields)


def _only(struct: T.StructType, *names: str) -> T.StructType:
    return T.StructType([f for f in struct.fields if f.name in names])


# The whole tree, and two narrower readings of it. The decoder builds exactly the
# fields of the schema it is given, the way a columnar scan reads a narrow schema.
FEED_MESSAGE = message_struct("FeedMessage")
TRIP_UPDATE_MESSAGE = T.StructType(
    [
        T.StructField("header", message_struct("FeedHeader")),
        T.StructField(
            "entity",
            T.ArrayType(_only(message_struct("FeedEntity"), "id", "is_deleted", "trip_update")),
        ),
    ]
)
ENTITY_KIND_MESSAGE = T.StructType(
    [
        T.StructField("header", message_struct("FeedHeader")),
        T.StructField(
            "entity",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("is_deleted", T.BooleanType()),
                        T.StructField("trip_update", _only(message_struct("TripUpdate"), "delay")),
                        T.StructField("vehicle", _only(message_struct("VehiclePosition"), "timestamp")),
                        T.StructField("alert", _only(message_struct("Alert"), "cause")),
                    ]
                )
            ),
        ),
    ]
)


_S, _L, _I, _B, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _columns(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in pairs])


TICK = _columns(
    ("tick_id", _S), ("source_id", _S), ("stream_id", _S), ("scheduled_at", _TS),
    ("started_at", _TS), ("finished_at", _TS), ("result", _S), ("skip_reason", _S),
    ("error_category", _S), ("error_detail", _S), ("http_status", _I), ("attempts", _I),
    ("config_fingerprint", _S),
)

CAPTURE = _columns(
    ("format_version", _I), ("capture_id", _S), ("tick_id", _S), ("source_id", _S),
    ("stream_id", _S), ("expected_kind", _S), ("scheduled_at", _TS), ("started_at", _TS),
    ("completed_at", _TS), ("archive_date", _S), ("timezone", _S), ("sanitized_url", _S),
    ("http_status", _I), ("response_headers", T.MapType(_S, _S)), ("duration_ms", _L),
    ("attempt_count", _I), ("advertised_length", _L), ("encoded_length", _L),
    ("decoded_length", _L), ("content_encoding", _S), ("body_sha256", _S), ("raw_path", _S),
    ("sidecar_path", _S), ("transport_complete", _B), ("parse_status", _S), ("parse_error", _S),
    ("feed_version", _S), ("incrementality", _I), ("feed_timestamp", UINT64),
    ("entity_count", _I), ("validation_flags", T.ArrayType(_S)), ("config_fingerprint", _S),
    ("application_version", _S), ("protobuf_revision", _S),
)

NESTED_ROW = _columns(
    ("source_id", _S), ("stream_id", _S), ("expected_kind", _S), ("capture_id", _S),
    ("archive_date", _S), ("archive_timezone", _S), ("sanitized_url", _S), ("raw_path", _S),
    ("config_fingerprint", _S), ("application_version", _S), ("protobuf_revision", _S),
    ("scheduled_at", _TS), ("started_at", _TS), ("observed_at", _TS), ("http_status", _I),
    ("response_headers_json", _S), ("duration_ms", _L), ("attempt_count", _I),
    ("advertised_length", _L), ("encoded_length", _L), ("decoded_length", _L),
    ("content_encoding", _S), ("transport_complete", _B), ("parse_status", _S),
    ("parse_error", _S), ("body_sha256", _S), ("entity_count", _I),
    ("validation_flags", T.ArrayType(_S)), ("header", message_struct("FeedHeader")),
    ("entities", T.ArrayType(message_struct("FeedEntity"))), ("feed_message_pb", T.BinaryType()),
)

FLAT_ROW = _columns(
    ("source_file", _S), ("feed_url", _S), ("feed_timestamp", UINT64), ("fetch_timestamp", _TS),
    ("entity_id", _S), ("trip_id", _S), ("route_id", _S), ("direction_id", _L),
    ("start_time", _S), ("start_date", _S), ("schedule_relationship", _I), ("vehicle_id", _S),
    ("vehicle_label", _S), ("trip_timestamp", UINT64), ("trip_delay", _I),
    ("stop_sequence", _L), ("stop_id", _S), ("arrival_delay", _I), ("arrival_time", _L),
    ("arrival_uncertainty", _I), ("departure_delay", _I), ("departure_time", _L),
    ("departure_uncertainty", _I), ("stop_schedule_relationship", _I), ("license_plate", _S),
    ("arrival_scheduled_time", _L), ("departure_scheduled_time", _L),
    ("departure_occupancy_status", _I), ("assigned_stop_id", _S), ("stop_headsign", _S),
    ("pickup_type", _I), ("drop_off_type", _I), ("trip_properties_trip_id", _S),
    ("trip_properties_start_date", _S), ("trip_properties_start_time", _S),
    ("trip_properties_shape_id", _S), ("trip_properties_trip_headsign", _S),
    ("trip_properties_trip_short_name", _S), ("modified_trip_modifications_id", _S),
    ("modified_trip_affected_trip_id", _S), ("modified_trip_start_date", _S),
    ("modified_trip_start_time", _S), ("wheelchair_accessible", _I), ("feed_version", _S),
    ("incrementality", _I), ("is_deleted", _B), ("source_id", _S), ("stream_id", _S),
    ("capture_id", _S), ("archive_date", _S), ("archive_timezone", _S), ("scheduled_at", _TS),
    ("parse_status", _S), ("validation_flags", T.ArrayType(_S)),
)

ARTIFACT = _columns(
    ("relative_path", _S), ("part", _I), ("bytes", _L), ("sha256", _S), ("rows", _L), ("entities", _L),
)
INPUT_CAPTURE = _columns(("id", _S), ("sha256", _S), ("bytes", _L))
DESTINATION = _columns(("id", _S), ("required", _B))
_COUNTS = T.MapType(_S, _L)

MANIFEST = _columns(
    ("manifest_version", _I), ("dataset_status", _S), ("source_id", _S), ("stream_id", _S),
    ("registry_id", _S), ("expected_kind", _S), ("archive_date", _S), ("timezone", _S),
    ("sanitized_url", _S), ("day_start_utc", _TS), ("day_end_utc", _TS), ("format_version", _I),
    ("schema_version", _I), ("revision", _I), ("predecessor_revision", _I),
    ("application_version", _S), ("protobuf_revision", _S), ("config_fingerprint", _S),
    ("created_at", _TS), ("scheduled_ticks", _L), ("skipped_ticks", _L),
    ("captured_responses", _L), ("valid_snapshots", _L), ("invalid_payloads", _L),
    ("http_failures", _L), ("network_failures", _L), ("failure_category_counts", _COUNTS),
    ("entity_total", _L), ("stop_time_update_total", _L), ("earliest_capture", _TS),
    ("latest_capture", _TS), ("earliest_feed_timestamp", UINT64),
    ("latest_feed_timestamp", UINT64), ("largest_fetch_gap_ms", _L),
    ("parse_status_counts", _COUNTS), ("validation_flag_counts", _COUNTS),
    ("files", T.ArrayType(ARTIFACT)), ("input_captures", T.ArrayType(INPUT_CAPTURE)),
    ("license_url", _S), ("attribution", _S), ("required_destinations", T.ArrayType(_S)),
    ("destinations", T.ArrayType(DESTINATION)),
)

COMPACTION = _columns(
    ("compaction_id", _L), ("source_id", _S), ("stream_id", _S), ("archive_date", _S),
    ("format_version", _I), ("revision", _I), ("status", _S), ("directory", _S),
    ("data_path", _S), ("manifest_path", _S), ("data_sha256", _S), ("data_bytes", _L),
    ("rows", _L), ("entities", _L), ("required_destinations", T.ArrayType(_S)),
    ("created_at", _TS), ("published_at", _TS),
)
REVISION_DIGEST = _columns(
    ("compaction_id", _L), ("source_id", _S), ("stream_id", _S), ("archive_date", _S), ("revision", _I), ("inputs_digest", _S))
COMPACTION_INPUT = _columns(("compaction_id", _L), ("capture_id", _S))
PUBLICATION = _columns(
    ("publication_id", _L), ("compaction_id", _L), ("destination_id", _S), ("required", _B),
    ("status", _S), ("attempt_count", _I), ("next_attempt_at", _TS), ("last_error", _S),
    ("remote_path", _S), ("completed_at", _TS),
)
AUDIT = _columns(("action", _S), ("target", _S), ("reason", _S), ("created_at", _TS))
DAILY_SUMMARY = _columns(
    ("source_id", _S), ("stream_id", _S), ("archive_date", _S), ("scheduled_ticks", _L),
    ("skipped_ticks", _L), ("captured_responses", _L), ("valid_snapshots", _L),
    ("invalid_payloads", _L), ("http_failures", _L), ("network_failures", _L),
    ("parse_status_counts", _COUNTS), ("summarized_at", _TS),
)
# One row for each path that retention lists: what asked for it, and how its deletion went.
DELETION = _columns(("path", _S), ("kind", _S), ("owner", _S), ("outcome", _S), ("bytes", _L), ("at", _TS))
STREAM = _columns(
    ("source_id", _S), ("stream_id", _S), ("expected_kind", _S), ("url", _S), ("timezone", _S),
    ("interval_ms", _L), ("max_start_lateness_ms", _L), ("registry_id", _S), ("license_url", _S),
    ("attribution", _S),
)

LEDGER: dict[str, T.StructType] = {
    "ticks": TICK,
    "captures": CAPTURE,
    "compactions": COMPACTION,
    "compaction_inputs": COMPACTION_INPUT,
    "revision_digests": REVISION_DIGEST,
    "publications": PUBLICATION,
    "audit": AUDIT,
    "daily_summaries": DAILY_SUMMARY,
    "deletions": DELETION,
}
