"""Protobuf bytes to Arrow structs, one Arrow batch at a time, inside Spark tasks.

Sound bodies are scanned as columns (:mod:`transitlake.operators.columns`); the others go
through message classes of the protobuf library. Enum fields are declared as
int32, so numbers newer than the schema survive, and string fields as bytes, so a
feed with broken UTF-8 still decodes; both keep what was published.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, compress
from operator import attrgetter, methodcaller

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from transitlake.operators.columns import scanned
from transitlake.schemas import MESSAGES, SCALAR_TYPES

# Bodies decoded into one output batch: the decoded tree is several times larger.
BATCH_BODY_BYTES = 1 << 20
FEW_FIELDS = 16

_NUMBERS = {
    "bool": np.bool_, "int32": np.int32, "int64": np.int64, "uint32": np.int64, "uint64": np.uint64,
    "float": np.float32, "double": np.float64,
}


@lru_cache(maxsize=None)
def message_class(name: str = "FeedMessage"):
    """The dynamic message class; built once per Python worker."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    proto = descriptor_pb2.FieldDescriptorProto
    labels = {"req": proto.LABEL_REQUIRED, "opt": proto.LABEL_OPTIONAL, "rep": proto.LABEL_REPEATED}
    types = {
        "string": proto.TYPE_BYTES, "bool": proto.TYPE_BOOL, "int32": proto.TYPE_INT32,
        "int64": proto.TYPE_INT64, "uint32": proto.TYPE_UINT32, "uint64": proto.TYPE_UINT64,
        "float": proto.TYPE_FLOAT, "double": proto.TYPE_DOUBLE,
    }
    file = descriptor_pb2.FileDescriptorProto(name="feed.proto", package="feed", syntax="proto2")
    for message, fields in MESSAGES.items():
        entry = file.message_type.add(name=message)
        for field, number, kind, label in fields:
            added = entry.field.add(name=field, number=number, label=labels[label])
            if kind in types:
                added.type = types[kind]
            else:
                added.type, added.type_name = proto.TYPE_MESSAGE, f".feed.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"feed.{name}"))


def _scalar_array(name: str, kind: str, messages: list) -> pa.Array:
    """One scalar field of all messages, NULL where it was not published.

    A value other than zero was published for certain, so presence is asked for only
    where zero or an empty text was read.
    """
    values = list(map(attrgetter(name), messages))
    if kind == "string":
        present = np.fromiter(map(len, values), np.int64, len(values)) > 0
    else:
        numbers = np.fromiter(values, _NUMBERS[kind], len(values))
        present = numbers != 0
    if not present.all():
        unsure = np.flatnonzero(~present)
        asked = map(methodcaller("HasField", name), map(messages.__getitem__, unsure.tolist()))
        present[unsure] = np.fromiter(asked, np.bool_, len(unsure))
    if kind == "string":
        # the published bytes, not re-encoded
        return pa.array(values, pa.binary(), mask=~present).view(pa.string())
    array = pa.array(numbers, mask=~present)
    return array.cast(pa.decimal128(20, 0)) if kind == "uint64" else array


def _spread(dense: pa.Array, present: np.ndarray) -> pa.Array:
    """Put the rows of ``dense`` where ``present`` is set, and NULL elsewhere."""
    if present.all():
        return dense
    places = np.cumsum(present) - 1
    return dense.take(pa.array(places, pa.int64(), mask=~present))


def struct_array(message: str, wanted: T.StructType, values: list) -> pa.StructArray:
    """Column by column projection of messages onto ``wanted``; one field of all
    messages is read by one mapped call."""
    kinds = {field: (kind, label) for field, _, kind, label in MESSAGES[message]}
    children, names = [], []
    for field in wanted.fields:
        name = field.name
        kind, label = kinds[name]
        if label == "rep":
            lists = list(map(attrgetter(name), values))
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum(np.fromiter(map(len, lists), np.int32, len(lists)), out=offsets[1:])
            items = struct_array(kind, field.dataType.elementType, list(chain.from_iterable(lists)))
            child = pa.ListArray.from_arrays(pa.array(offsets), items)
        elif kind in SCALAR_TYPES:
            child = _scalar_array(name, kind, values)
        else:
            present = np.fromiter(map(methodcaller("HasField", name), values), np.bool_, len(values))
            held = map(attrgetter(name), compress(values, present))
            child = _spread(struct_array(kind, field.dataType, list(held)), present)
        children.append(child)
        names.append(name)
    return pa.StructArray.from_arrays(children, names=names)


def message_array(wanted: T.StructType, messages: list) -> pa.StructArray:
    """Feed messages as structs, NULL where a body could not be read."""
    present = np.fromiter((m is not None for m in messages), np.bool_, len(messages))
    return _spread(struct_array("FeedMessage", wanted, list(compress(messages, present))), present)


def _parse(body: bytes | None):
    """(status, error, message) of one body."""
    from google.protobuf.message import DecodeError

    message = message_class()()
    if not body:
        return "empty_body", "no bytes to decode", message
    try:
        message.MergeFromString(body)
    except DecodeError:
        return "protobuf_decode", "DecodeError", None
    if not message.IsInitialized():
        return "protobuf_required_field", "RequiredFieldError", message
    return "valid", None, message


def _slices(bodies: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose bodies together stay near BATCH_BODY_BYTES."""
    sizes = pc.fill_null(pc.binary_length(bodies), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // BATCH_BODY_BYTES
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    for start, stop in zip(starts, [*starts[1:], len(sizes)], strict=True):
        yield int(start), int(stop)


def _leaves(wanted: T.DataType) -> int:
    if isinstance(wanted, T.ArrayType):
        return _leaves(wanted.elementType)
    return sum(_leaves(f.dataType) for f in wanted.fields) if isinstance(wanted, T.StructType) else 1


def decoded_bodies(bodies: pa.Array, wanted: T.StructType) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(status, error, message) columns. Sound bodies are scanned as columns, the others parsed one by one.

    A layout of few fields asks little of message objects, which are then the cheaper way for all bodies.
    """
    if _leaves(wanted) < FEW_FIELDS:
        parsed = [_parse(body) for body in bodies.to_pylist()]
        return (pa.array([p[0] for p in parsed], pa.string()), pa.array([p[1] for p in parsed], pa.string()),
                message_array(wanted, [p[2] for p in parsed]))
    scan, rows = scanned(bodies, wanted)
    if len(rows) == len(bodies):
        return pa.array(["valid"] * len(rows), pa.string()), pa.nulls(len(rows), pa.string()), scan
    rest = np.setdiff1d(np.arange(len(bodies)), rows)
    parsed = [_parse(body) for body in bodies.take(pa.array(rest)).to_pylist()]
    statuses, errors = np.full(len(bodies), "valid", dtype=object), np.full(len(bodies), None, dtype=object)
    statuses[rest], errors[rest] = [p[0] for p in parsed], [p[1] for p in parsed]
    places = np.argsort(np.concatenate([rows, rest]), kind="stable")
    both = pa.concat_arrays([scan, message_array(wanted, [p[2] for p in parsed])])
    return pa.array(statuses, pa.string()), pa.array(errors, pa.string()), both.take(pa.array(places))


def decoder(body_column: str, wanted: T.StructType, keep_body: bool):
    """The function given to mapInArrow: input columns, then status, error and message."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for start, stop in _slices(batch.column(body_column)):
                part = batch.slice(start, stop - start)
                statuses, errors, messages = decoded_bodies(part.column(body_column), wanted)
                columns = {
                    name: part.column(name) for name in part.schema.names
                    if keep_body or name != body_column
                }
                columns["decode_status"], columns["decode_error"], columns["message"] = statuses, errors, messages
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run
