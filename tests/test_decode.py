"""Decoding, flags, and both projections, over messages made by rule."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.feeds import MALFORMED, SOME_TIME, Shape, body, feed, feed_of, flattened, shapes, trip
from transitlake import schemas
from transitlake.operators import wire
from transitlake.operators.decode import decode_bodies, header_metadata, validation_flags
from transitlake.operators.flatten import ALWAYS_NULL, flatten_trip_updates, projected_rows, stop_time_updates
from transitlake.operators.project import nested_rows

SEEN = dt.datetime.fromtimestamp(SOME_TIME, dt.timezone.utc).replace(tzinfo=None)
EVERY = list(shapes())


def received(spark, bodies, kind="trip_update"):
    """Bodies as captures, named by their place."""
    rows = [(f"{k:03d}", kind, bytes(b), SEEN) for k, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "capture_id string, expected_kind string, body binary, completed_at timestamp")


def facts(spark, bodies, kind="trip_update"):
    df = decode_bodies(received(spark, bodies, kind), wanted=schemas.ENTITY_KIND_MESSAGE)
    return validation_flags(header_metadata(df)).drop("body").orderBy("capture_id").collect()


def with_origin(df):
    """What a capture's row says of itself beside its body."""
    values = {"raw_path": "raw/source=north/one.pb", "sanitized_url": "https://feeds.example/north", "source_id": "north", "stream_id": "buses",
              "archive_date": "2023-11-14", "timezone": "Europe/Oslo", "parse_status": "valid"}
    return df.withColumns({k: F.lit(v) for k, v in values.items()}).withColumns(
        {"scheduled_at": F.col("completed_at"), "validation_flags": F.array(F.lit("seen"))})


def flat(spark, *bodies):
    df = decode_bodies(with_origin(received(spark, bodies)), wanted=schemas.TRIP_UPDATE_MESSAGE, keep_body=False)
    rows = flatten_trip_updates(df).orderBy("capture_id", "entity_pos", "stop_pos").collect()
    return [r.asDict() for r in rows], tuple(df.agg(F.sum(projected_rows()), F.sum(stop_time_updates())).first())


STATUSES = [
    ("no body", b"", "empty_body"),
    ("no version", body(feed(version=None)), "protobuf_required_field"),
    ("cut off", MALFORMED, "protobuf_decode"),
    ("a varint without end", b"\x80" * 11, "protobuf_decode"),
    ("a field of a later version", body(feed()) + bytes([0xA2, 0x06, 2, 7, 7]), "valid"),
    ("every shape", body(feed_of(EVERY)), "valid"),
]


def test_statuses(spark):
    found = facts(spark, [b for _, b, _ in STATUSES])
    assert {name: r["parse_status"] for (name, _, _), r in zip(STATUSES, found)} == {name: s for name, _, s in STATUSES}
    by_name = dict(zip([name for name, _, _ in STATUSES], found))
    # what cannot be read has no facts, what lacks a field keeps the others
    assert by_name["cut off"]["message"] is None and by_name["cut off"]["entity_count"] is None
    assert by_name["no version"]["feed_version"] == "" and by_name["no version"]["entity_count"] == 0
    nothing = by_name["no body"]
    assert (nothing["entity_count"], nothing["validation_flags"], nothing["message"]["header"], nothing["message"]["entity"]) == (None, [], None, [])
    assert by_name["every shape"]["entity_count"] == len(EVERY)


def test_an_entity_without_id_leaves_the_header_readable(spark):
    message = feed()
    message.entity.add(is_deleted=True)
    [row] = facts(spark, [body(message)])
    assert (row["parse_status"], row["feed_version"], row["entity_count"]) == ("protobuf_required_field", "2.0", 1)


@pytest.mark.parametrize("kind, extra", [("trip_update", ["unexpected_entity_kind"]), ("mixed", [])])
def test_flags_of_entities_and_header(spark, kind, extra):
    two, none = feed(incrementality=1), feed()
    both = two.entity.add(id=b"both")
    trip(both)
    both.vehicle.timestamp = 5
    none.entity.add(id=b"none")
    flags = [sorted(r["validation_flags"]) for r in facts(spark, [body(two), body(none), body(feed())], kind)]
    assert flags == [sorted(["differential_incrementality", "multiple_entity_payloads", *extra]), ["entity_without_payload"], []]


def test_flags_of_timestamps_over_all_unsigned_values(spark):
    cases = {SOME_TIME: [], SOME_TIME + 300: [], SOME_TIME - 86400: [], SOME_TIME + 301: ["feed_timestamp_future"],
             1 << 62: ["feed_timestamp_future"], SOME_TIME - 86401: ["feed_timestamp_stale"], 0: ["feed_timestamp_stale"],
             (1 << 64) - 1: ["feed_timestamp_stale"], None: ["missing_feed_timestamp"]}
    found = facts(spark, [body(feed(timestamp=t)) for t in cases])
    assert [r["validation_flags"] for r in found] == list(cases.values())
    assert [r["feed_timestamp"] for r in found] == [None if t is None else Decimal(t) for t in cases]


def test_every_shape_flattens_by_the_rules(spark):
    wanted = flattened(EVERY)
    rows, counts = flat(spark, body(feed_of(EVERY, incrementality=0)))
    assert [{name: r[name] for name in wanted[0]} for r in rows] == wanted
    assert counts == (len(wanted), sum(s.stops for s in EVERY))
    for row in rows:
        assert (row["feed_timestamp"], row["feed_version"], row["incrementality"]) == (SOME_TIME, "2.0", 0)
        assert (row["feed_url"], row["capture_id"], row["archive_timezone"]) == ("https://feeds.example/north", "000", "Europe/Oslo")
        assert all(row[name] is None for name in ALWAYS_NULL)


def test_unset_header_fields_are_told_from_zero(spark):
    one = [Shape("trip", 1, False, False)]
    rows, _ = flat(spark, body(feed_of(one, timestamp=0)), body(feed_of(one, timestamp=None, incrementality=1)))
    assert [(r["feed_timestamp"], r["incrementality"]) for r in rows] == [(0, None), (None, 1)]


def test_unreadable_bodies_flatten_to_nothing(spark):
    some = [s for s in EVERY if s.stops > 1]
    rows, counts = flat(spark, MALFORMED, body(feed_of(some)), b"", body(feed()))
    assert {r["capture_id"] for r in rows} == {"001"}
    assert counts == (len(flattened(some)), sum(s.stops for s in some))


def test_values_outside_the_registry_are_kept(spark):
    message = feed()
    entity = message.entity.add(id=b"\xc3\x28")  # no UTF-8
    trip(entity, relationship=77)
    df = decode_bodies(received(spark, [body(message)]), wanted=schemas.TRIP_UPDATE_MESSAGE)
    row = df.select(F.hex(F.col("message.entity")[0]["id"]).alias("id"), F.col("message.entity")[0]["trip_update"]["trip"]["schedule_relationship"].alias("r")).first()
    assert (row["id"], row["r"]) == ("C328", 77)


def test_nested_message_keeps_what_is_set(spark):
    message = feed()
    alert = message.entity.add(id=b"w").alert
    for language in (b"nb", b"en"):
        alert.description_text.translation.add(text=b"snow (%s)" % language, language=language)
    alert.active_period.add(end=(1 << 64) - 1)
    moving = message.entity.add(id=b"x").vehicle
    moving.position.latitude, moving.position.longitude = -0.5, 60.25
    moving.multi_carriage_details.add(occupancy_percentage=-1, carriage_sequence=2)
    first, second = decode_bodies(received(spark, [body(message)])).first()["message"]["entity"]
    texts = [(t["text"], t["language"]) for t in first["alert"]["description_text"]["translation"]]
    assert texts == [("snow (nb)", "nb"), ("snow (en)", "en")]
    assert first["alert"]["active_period"][0].asDict() == {"start": None, "end": Decimal((1 << 64) - 1)}
    assert [first[name] for name in ("trip_update", "vehicle")] == [None, None] and first["alert"]["effect"] is None and first["alert"]["header_text"] is None
    assert second["vehicle"]["position"]["longitude"] == 60.25 and second["alert"] is None
    assert second["vehicle"]["multi_carriage_details"][0]["occupancy_percentage"] == -1


def test_nested_rows_are_the_documented_columns(spark):
    bodies = [body(feed_of(EVERY)), MALFORMED]
    df = with_origin(decode_bodies(received(spark, bodies)))
    texts = ("config_fingerprint", "application_version", "protobuf_revision", "content_encoding", "parse_error", "body_sha256")
    numbers = {"http_status": 304, "duration_ms": 7, "attempt_count": 2, "advertised_length": -1, "encoded_length": 3, "decoded_length": 4,
               "entity_count": 9}
    df = df.withColumns({**{t: F.lit("") for t in texts}, **{n: F.lit(v) for n, v in numbers.items()}, "started_at": F.col("completed_at"),
                         "response_headers": F.expr("map('Via', 'a & b', 'Age', '3')"), "transport_complete": F.lit(False)})
    rows = nested_rows(df)
    assert rows.columns == schemas.NESTED_ROW.names
    kept, broken = rows.orderBy("capture_id").collect()
    assert len(kept["entities"]) == len(EVERY) and bytes(kept["feed_message_pb"]) == bodies[0] and kept["parse_error"] is None
    assert kept["response_headers_json"] == '{"Age":"3","Via":"a \\u0026 b"}' and kept["http_status"] == 304
    assert (broken["header"], broken["entities"], bytes(broken["feed_message_pb"])) == (None, [], MALFORMED)


def test_layouts_have_their_published_width():
    assert [len(schemas.FLAT_ROW), len(schemas.NESTED_ROW), len(schemas.MESSAGES)] == [54, 31, 18]
    assert schemas.FLAT_ROW.names[0] == "source_file" and schemas.FLAT_ROW.names[-1] == "validation_flags"
    assert isinstance(schemas.FLAT_ROW["feed_timestamp"].dataType, T.DecimalType)


@pytest.mark.parametrize("limit", [1, 6, 1000])
def test_batches_are_cut_by_bytes_and_lose_nothing(monkeypatch, limit):
    monkeypatch.setattr(wire, "BATCH_BODY_BYTES", limit)
    bodies = [b"123", None, b"", b"4567890", b"x", b"yz"]
    pieces = list(wire._slices(pa.array(bodies)))
    assert len(pieces) == 1 if limit == 1000 else len(pieces) >= 2
