"""Expressions over one captured body and its response."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake import constants as K

_TOKEN = r"[!#$%&'*+\-.^_`|~0-9A-Za-z]+"
_MEDIA_TYPE = (
    rf"^\s*{_TOKEN}/{_TOKEN}\s*"
    rf"(;\s*{_TOKEN}\s*=\s*({_TOKEN}|\"([^\"\\]|\\.)*\")\s*)*;?\s*$"
)


def words(*candidates: Column) -> Column:
    """The candidates that are not NULL, as an array in the order given. Set difference
    compiles to code, which filtering by a lambda does not."""
    return F.array_except(F.array(*candidates), F.array(F.lit(None).cast("string")))


def body_sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def body_bytes(body: Column) -> Column:
    return F.octet_length(body).cast("bigint")


def safe_headers(headers: Column) -> Column:
    """Keep the response headers that are safe to archive, dropping empty ones."""
    return F.map_filter(headers, lambda k, v: k.isin(*K.SAFE_HEADERS) & (v != ""))


def stable_json(headers: Column) -> Column:
    """One JSON text per map content, whatever order the entries came in."""
    text = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(headers))))
    for char, escape in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    return F.coalesce(text, F.lit("null"))


def is_protobuf_content_type(content_type: Column) -> Column:
    media_type = F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))
    # a bare known type needs no look at parameters
    known = content_type.isin(*K.PROTOBUF_MEDIA_TYPES) | (
        media_type.isin(*K.PROTOBUF_MEDIA_TYPES) & content_type.rlike(_MEDIA_TYPE))
    return F.coalesce(known, F.lit(False))


def transport_complete(read_failed: Column, encoded: Column, advertised: Column) -> Column:
    """The body arrived whole: no read error, and the advertised length if one was given."""
    return ~read_failed & ((advertised < 0) | (encoded == advertised))


def ingest_flags(flags: Column, content_type: Column, complete: Column) -> Column:
    """Decode flags, then the two ingest flags in their own order, each at most once."""
    extra = words(
        F.when(~is_protobuf_content_type(content_type), F.lit("unexpected_content_type")),
        F.when(~complete, F.lit("transport_incomplete")),
    )
    return F.concat(flags, F.array_except(extra, flags))


def is_valid_snapshot(parse_status: Column, complete: Column) -> Column:
    return F.coalesce((parse_status == "valid") & complete, F.lit(False))


def capture_result(parse_status: Column, complete: Column) -> Column:
    return F.when(is_valid_snapshot(parse_status, complete), F.lit("captured")).otherwise(
        F.lit("captured_invalid")
    )
