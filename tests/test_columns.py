"""The column scan against message objects: sound, odd and random bodies."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.feeds import MALFORMED, SOME_TIME, body, feed, feed_of, shapes
from transitlake import schemas
from transitlake.operators import columns, wire

LAYOUTS = {"whole": schemas.FEED_MESSAGE, "trips": schemas.TRIP_UPDATE_MESSAGE, "kinds": schemas.ENTITY_KIND_MESSAGE}
EDGES = {"bool": [True, False], "int32": [0, -1, 1, 2**31 - 1, -2**31], "int64": [0, -1, 5, 2**63 - 1, -2**63], "uint32": [0, 1, 2**32 - 1],
         "uint64": [0, 1, 2**64 - 1], "float": [0.0, -1.5, 3.25e30], "double": [0.0, -2.5e300], "string": [b"", b"x", b"\xff\xfe", "日本".encode() * 9]}


def filled(rng, message, kind, depth=0):
    """A random message with all of its required fields."""
    for name, _, type_, label in schemas.MESSAGES[kind]:
        if label != "req" and rng.random() < (0.4 if depth < 3 else 0.75):
            continue
        times = rng.randint(1, 4) if label == "rep" else 1
        for _ in range(times):
            if type_ in schemas.SCALAR_TYPES:
                value = rng.choice(EDGES[type_])
                getattr(message, name).append(value) if label == "rep" else setattr(message, name, value)
            else:
                target = getattr(message, name).add() if label == "rep" else getattr(message, name)
                target.SetInParent()
                filled(rng, target, type_, depth + 1)
    return message


def by_objects(bodies, wanted):
    parsed = [wire._parse(b) for b in bodies]
    return [p[0] for p in parsed], [p[1] for p in parsed], wire.message_array(wanted, [p[2] for p in parsed])


@pytest.fixture(autouse=True, params=[1, 64])
def few(request, monkeypatch):
    """All in step, or few bodies one by one; and the scan for narrow layouts as well."""
    monkeypatch.setattr(columns, "FEW", request.param)
    monkeypatch.setattr(wire, "FEW_FIELDS", 0)


def same(bodies, wanted):
    column = pa.array(bodies, pa.binary())
    statuses, errors, messages = wire.decoded_bodies(column, wanted)
    plain = by_objects(bodies, wanted)
    assert (statuses.to_pylist(), errors.to_pylist()) == plain[:2]
    assert messages.type == plain[2].type
    raw = lambda array: repr(_bytes(array))
    assert raw(messages) == raw(plain[2])
    messages.validate(full=False)


def _bytes(array):
    """Nested values, with texts as bytes: they may be no UTF-8."""
    if pa.types.is_struct(array.type):
        parts = {array.type.field(i).name: _bytes(array.field(i)) for i in range(array.type.num_fields)}
        return [None if not ok else {n: p[i] for n, p in parts.items()} for i, ok in enumerate(array.is_valid().to_pylist())]
    if pa.types.is_list(array.type):
        inner, at = _bytes(array.values), array.offsets.to_pylist()
        return [None if not ok else inner[at[i]:at[i + 1]] for i, ok in enumerate(array.is_valid().to_pylist())]
    return (array.view(pa.binary()) if pa.types.is_string(array.type) else array).to_pylist()


@pytest.mark.parametrize("layout", LAYOUTS)
def test_random_messages(layout):
    rng = random.Random(layout)
    bodies = [body(filled(rng, wire.message_class()(), "FeedMessage")) for _ in range(120)]
    same(bodies, LAYOUTS[layout])
    _, rows = columns.scanned(pa.array(bodies, pa.binary()), LAYOUTS[layout])
    assert len(rows) == len(bodies)  # none of them needs the library


@pytest.mark.parametrize("layout", LAYOUTS)
def test_damaged_bytes(layout):
    """Every damage gives what the library says of it."""
    rng = random.Random(layout)
    whole = [body(filled(rng, wire.message_class()(), "FeedMessage")) for _ in range(30)] + [body(feed_of(list(shapes())))]
    bodies = []
    for _ in range(400):
        one = bytearray(rng.choice(whole))
        at = rng.randrange(len(one) + 1)
        kind = rng.randrange(5)
        if kind == 0 and at < len(one):
            one[at] ^= 1 << rng.randrange(8)
        elif kind == 1:
            del one[at:]
        elif kind == 2:
            one[at:at] = rng.randbytes(rng.randint(1, 4))
        elif kind == 3:
            del one[at:at + rng.randint(1, 5)]
        else:
            one += rng.choice(whole)  # two messages one after the other merge
        bodies.append(bytes(one))
    same([*bodies, b"", None, MALFORMED, *[rng.randbytes(rng.randint(0, 40)) for _ in range(200)]], LAYOUTS[layout])


ODD = {
    "nothing": [], "nulls": [None, None], "empty": [b"", b""], "no header": [body(wire.message_class()())],
    "unknown fields": [body(feed()) + bytes([0xA2, 0x06, 3, 1, 2, 3, 0xA8, 0x06, 5, 0xAD, 0x06, 1, 2, 3, 4, 0xA9, 0x06, 1, 2, 3, 4, 5, 6, 7, 8])],
    "a group": [body(feed()) + bytes([0xA3, 0x06, 0xA4, 0x06])], "field zero": [body(feed()) + bytes([0x02, 0x00])],
    "another wire type": [body(feed()) + bytes([0x10, 0x05])], "two headers": [body(feed(timestamp=1)) + body(feed(timestamp=2, incrementality=1))],
    "a longer zero": [bytes([0x0A, 0x0D, 0x0A, 0x03]) + b"2.0" + bytes([0x18, 0x80, 0x80, 0x80, 0x80, 0x80, 0x00])],
    "ten bytes": [bytes([0x0A, 0x10, 0x0A, 0x03]) + b"2.0" + bytes([0x18] + [0xFF] * 9 + [0x01])],
    "eleven bytes": [bytes([0x0A, 0x11, 0x0A, 0x03]) + b"2.0" + bytes([0x18] + [0xFF] * 10 + [0x01])],
    "more than 64 bits": [bytes([0x0A, 0x10, 0x0A, 0x03]) + b"2.0" + bytes([0x18] + [0xFF] * 9 + [0x7F])],
    "a field twice": [bytes([0x0A, 0x09, 0x0A, 0x03]) + b"1.0" + bytes([0x18, 0x01, 0x18, 0x02])],
    "a length beyond the end": [bytes([0x0A, 0xFF, 0xFF, 0xFF, 0xFF, 0xFF, 0x0F, 0x0A])],
}


@pytest.mark.parametrize("case", ODD)
@pytest.mark.parametrize("layout", LAYOUTS)
def test_odd_bodies_between_sound_ones(case, layout):
    sound = [body(feed_of(list(shapes()), timestamp=SOME_TIME + k)) for k in range(2)]
    same([sound[0], *ODD[case], sound[1]], LAYOUTS[layout])
    same(ODD[case], LAYOUTS[layout])


def test_slices_of_a_column():
    bodies = pa.array([body(feed(timestamp=k)) for k in range(9)], pa.binary())
    scan, rows = columns.scanned(bodies.slice(3, 4), schemas.ENTITY_KIND_MESSAGE)
    assert np.array_equal(rows, np.arange(4)) and [int(m["header"]["timestamp"]) for m in scan.to_pylist()] == [3, 4, 5, 6]


def test_narrow_layouts_go_by_objects(monkeypatch):
    monkeypatch.setattr(wire, "FEW_FIELDS", 16)
    monkeypatch.setattr(wire, "scanned", lambda *_: pytest.fail("scanned"))
    statuses, errors, found = wire.decoded_bodies(pa.array([body(feed()), b""], pa.binary()), schemas.ENTITY_KIND_MESSAGE)
    assert statuses.to_pylist() == ["valid", "empty_body"] and found.type == by_objects([b""], schemas.ENTITY_KIND_MESSAGE)[2].type
