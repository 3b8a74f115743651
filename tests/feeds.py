"""Feed messages made by rule from a list of entity shapes, and what they must flatten to."""

import itertools
from typing import NamedTuple

from transitlake.operators.wire import message_class

# a header field that announces more bytes than follow
MALFORMED = bytes([0x0A, 0x7F, 0x12, 0x01])
SOME_TIME = 1_700_000_000


class Shape(NamedTuple):
    """An entity: its payload, how many stops a trip update has, and whether optional fields are set."""

    payload: str
    stops: int
    deleted: bool
    full: bool


def shapes():
    """All combinations; only trip updates have stops."""
    for payload, deleted, full in itertools.product(("trip", "vehicle", "alert", "nothing"), (False, True), (False, True)):
        for stops in (0, 1, 4) if payload == "trip" else (0,):
            yield Shape(payload, stops, deleted, full)


def feed(version="2.0", timestamp=SOME_TIME, incrementality=None):
    message = message_class()()
    for name, value in (("gtfs_realtime_version", version and version.encode()), ("timestamp", timestamp), ("incrementality", incrementality)):
        if value is not None:
            setattr(message.header, name, value)
    return message


def trip(entity, relationship=0):
    """The least that makes an entity a trip update with a name."""
    target = entity.trip_update.trip
    target.trip_id = b"walk-" + entity.id
    target.schedule_relationship = relationship


def feed_of(listed, **header):
    """One entity for each shape; every value follows from the entity's place k and the stop's place j."""
    message = feed(**header)
    for k, shape in enumerate(listed):
        entity = message.entity.add(id=b"n%d" % k)
        if shape.deleted:
            entity.is_deleted = True
        if shape.payload == "vehicle":
            entity.vehicle.timestamp = SOME_TIME - k
        elif shape.payload == "alert":
            entity.alert.informed_entity.add(route_id=b"line %d" % k)
        elif shape.payload == "trip":
            _fill(entity.trip_update, shape, k)
    return message


def _fill(update, shape, k):
    update.trip.trip_id = b"journey %d" % k
    if shape.full:
        update.trip.route_id, update.trip.direction_id, update.trip.schedule_relationship = b"line %d" % k, k % 2, k % 4
        update.trip.start_time, update.trip.start_date = b"%02d:15:00" % (k % 24), b"202402%02d" % (k % 28 + 1)
        update.vehicle.id, update.vehicle.label, update.vehicle.license_plate = b"bus %d" % k, b"Bus no. %d" % k, b"PL-%d" % k
        update.timestamp, update.delay = SOME_TIME + k, 30 - k
    for j in range(shape.stops):
        stop = update.stop_time_update.add(stop_sequence=10 * j + k)
        if shape.full:
            stop.stop_id, stop.schedule_relationship = b"platform %d.%d" % (k, j), j % 3
            stop.arrival.delay, stop.arrival.time, stop.arrival.uncertainty = j - k, SOME_TIME + 60 * j, k
            stop.departure.delay, stop.departure.time, stop.departure.uncertainty = j + k, SOME_TIME + 60 * j + 20, j
            stop.stop_time_properties.assigned_stop_id = b"bay %d" % j


def flattened(listed):
    """The rows these shapes flatten to, by the rules: one a stop, one for a trip without stops."""
    rows = []
    for k, shape in enumerate(listed):
        if shape.payload != "trip":
            continue
        trip_facts = {"entity_id": f"n{k}", "is_deleted": shape.deleted, "trip_id": f"journey {k}"}
        if shape.full:
            trip_facts |= {
                "route_id": f"line {k}", "direction_id": k % 2, "schedule_relationship": k % 4, "start_time": f"{k % 24:02d}:15:00",
                "start_date": f"202402{k % 28 + 1:02d}", "vehicle_id": f"bus {k}", "vehicle_label": f"Bus no. {k}", "license_plate": f"PL-{k}",
                "trip_timestamp": SOME_TIME + k, "trip_delay": 30 - k}
        else:  # text and the relationship have a value when unset, the others have none
            trip_facts |= {"route_id": "", "direction_id": None, "schedule_relationship": 0, "start_time": "", "start_date": "", "vehicle_id": "",
                           "vehicle_label": "", "license_plate": None, "trip_timestamp": None, "trip_delay": None}
        for j in range(shape.stops) or [None]:
            stop_facts = dict.fromkeys(("stop_sequence", "stop_id", "stop_schedule_relationship", "arrival_delay", "arrival_time", "arrival_uncertainty",
                                        "departure_delay", "departure_time", "departure_uncertainty", "assigned_stop_id"))
            if j is not None:
                stop_facts["stop_sequence"] = 10 * j + k
                if shape.full:
                    stop_facts |= {
                        "stop_id": f"platform {k}.{j}", "stop_schedule_relationship": j % 3, "arrival_delay": j - k, "arrival_time": SOME_TIME + 60 * j,
                        "arrival_uncertainty": k, "departure_delay": j + k, "departure_time": SOME_TIME + 60 * j + 20, "departure_uncertainty": j,
                        "assigned_stop_id": f"bay {j}"}
            rows.append(trip_facts | stop_facts)
    return rows


def body(message) -> bytes:
    return message.SerializePartialToString()
