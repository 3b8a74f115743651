"""A small lake on disk: captures with bodies, ticks, streams, destinations."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from transitlake.functions.paths import capture_stem
from transitlake.operators.decode import decode_bodies, header_metadata
from transitlake.plans.reconcile import ticks_of
from transitlake.schemas import CAPTURE, ENTITY_KIND_MESSAGE, STREAM

START = dt.datetime(2026, 8, 12, 12, 0, 0)


def captures_with_bodies(spark, bodies, kind="trip_update", stream="trips", source="demo", incomplete=(),
                         tz="UTC", url="https://example.test/trips"):
    """One capture per body, half a minute apart, with the facts its decoding gives."""
    rows = []
    for i, body in enumerate(bodies):
        at = START + dt.timedelta(seconds=30 * i)
        rows.append((f"{source}-{stream}-{i + 1}", source, stream, kind, at, tz, url, bytes(body),
                     hashlib.sha256(body).hexdigest(), i not in incomplete))
    raw = spark.createDataFrame(
        rows, "capture_id string, source_id string, stream_id string, expected_kind string, scheduled_at timestamp,"
        " timezone string, sanitized_url string, body binary, body_sha256 string, transport_complete boolean")
    c = F.col
    facts = header_metadata(decode_bodies(raw, wanted=ENTITY_KIND_MESSAGE)).drop("message", "decode_status", "decode_error")
    stem = capture_stem(c("source_id"), c("stream_id"), c("scheduled_at"), c("timezone"), c("capture_id"), c("body_sha256"))
    size = F.octet_length("body").cast("bigint")
    full = facts.withColumns({
        "format_version": F.lit(1), "tick_id": F.concat(F.lit("t-"), "capture_id"), "started_at": c("scheduled_at"),
        "completed_at": c("scheduled_at") + F.expr("INTERVAL 1 SECOND"),
        "archive_date": F.date_format(F.from_utc_timestamp("scheduled_at", c("timezone")), "yyyy-MM-dd"),
        "http_status": F.lit(200), "response_headers": F.expr("map('Content-Type', 'application/x-protobuf')"),
        "duration_ms": F.lit(1000), "attempt_count": F.lit(1), "advertised_length": size, "encoded_length": size,
        "decoded_length": size, "content_encoding": F.lit(""), "raw_path": F.concat(stem, F.lit(".pb")),
        "sidecar_path": F.concat(stem, F.lit(".json")), "validation_flags": F.array().cast("array<string>"),
        "config_fingerprint": F.lit("f"), "application_version": F.lit("1"), "protobuf_revision": F.lit("r"),
    })
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CAPTURE.fields]
    return full.select(*columns, "body")


def ticks(captures):
    return ticks_of(captures).join(captures.select("tick_id", "archive_date"), "tick_id")


def streams(spark, *rows):
    wide = [(s, n, k, f"https://u:p@example.test/{n}?key=1", tz, 30000, 5000, "reg", "lic", " text ") for s, n, k, tz in rows]
    return spark.createDataFrame(wide, STREAM)


def destinations(spark, *pairs):
    return spark.createDataFrame([(i, r, remote) for i, r, remote in pairs], "id string, required boolean, remote string")


def days(spark, *rows):
    return spark.createDataFrame(list(rows), "source_id string, stream_id string, archive_date string, revision int")
