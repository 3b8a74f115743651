"""Paths and shapes: where a body, a revision or a publication belongs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.calendar import local_date_text, local_hour_text
from transitlake.functions.urls import base64url


def feed_type(kind: Column) -> Column:
    """Published directory of a stream kind, NULL for an unknown kind."""
    chain = reduce(lambda acc, item: acc.when(kind == item[0], F.lit(item[1])), K.FEED_TYPE_BY_KIND.items(), F)
    return chain.otherwise(F.lit(None).cast("string"))


def schema_version(kind: Column) -> Column:
    return F.when(kind == "trip_update", F.lit(K.SCHEMA_FLATTENED)).otherwise(F.lit(K.SCHEMA_NESTED))


def is_valid_id(value: Column) -> Column:
    return value.rlike(K.ID_PATTERN)


def is_date_text(value: Column) -> Column:
    return value.rlike(K.DATE_PATTERN)


def is_safe_path(path: Column) -> Column:
    """Every segment of a path uses only characters all object stores accept."""
    return F.forall(F.split(path, "/"), lambda segment: segment.rlike(K.SEGMENT_PATTERN))


def is_sha256(value: Column) -> Column:
    return value.rlike(K.SHA256_PATTERN)


def capture_stem(source: Column, stream: Column, scheduled_at: Column, tz: Column,
                 capture_id: Column, sha256: Column) -> Column:
    """Path of a body without its extension, from the capture's own facts."""
    return F.concat(
        F.lit("raw/source="), source,
        F.lit("/stream="), stream,
        F.lit("/date="), local_date_text(scheduled_at, tz),
        F.lit("/hour="), local_hour_text(scheduled_at, tz),
        F.lit("/"), capture_id, F.lit("_"), F.substring(sha256, 1, 12),
    )


def path_is_consistent() -> Column:
    """Do version, ids, hash, local date and both paths of a capture agree?"""
    c = F.col
    stem = capture_stem(c("source_id"), c("stream_id"), c("scheduled_at"), c("timezone"),
                        c("capture_id"), c("body_sha256"))
    ids = F.concat_ws("", c("capture_id"), c("source_id"), c("stream_id"))
    agrees = (
        (c("format_version") == K.SIDECAR_FORMAT_VERSION)
        & (c("capture_id") != "") & (c("source_id") != "") & (c("stream_id") != "")
        & ~ids.rlike(r"[/\\\x00]")
        & is_sha256(c("body_sha256"))
        & (local_date_text(c("scheduled_at"), c("timezone")) == c("archive_date"))
        & (c("raw_path") == F.concat(stem, F.lit(".pb")))
        & (c("sidecar_path") == F.concat(stem, F.lit(".json")))
    )
    return F.coalesce(agrees, F.lit(False))


def revision_directory(source: Column, stream: Column, date: Column, revision: Column) -> Column:
    return F.concat(
        F.lit(f"parquet/format=v{K.PARQUET_FORMAT_VERSION}/source="), source,
        F.lit("/stream="), stream,
        F.lit("/date="), date,
        F.lit("/revision="), revision.cast("string"),
    )


def publish_path(kind: Column, date: Column, revision: Column, url: Column,
                 base: Column | None = None) -> Column:
    """Directory of a published revision: feed type, date, URL key, revision.

    NULL when the manifest can never map to a path.
    """
    path = F.concat_ws(
        "/",
        feed_type(kind),
        F.concat(F.lit("date="), date),
        F.concat(F.lit("base64url="), base64url(url)),
        F.concat(F.lit("revision="), revision.cast("string")),
    )
    usable = (feed_type(kind).isNotNull() & is_date_text(date) & (revision >= 1)
              & url.isNotNull() & is_safe_path(path))
    full = path if base is None else F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), path)
    return F.when(usable, full)


def publish_error(kind: Column, date: Column, revision: Column, url: Column,
                  configured: Column) -> Column:
    """Why a manifest has no publish path: permanent or, for an unknown stream, retriable."""
    mapped = feed_type(kind).isNotNull() & is_date_text(date) & (revision >= 1)
    return (
        F.when(~F.coalesce(mapped, F.lit(False)), F.lit("dataset_invalid"))
        .when(url.isNull() & ~F.coalesce(configured, F.lit(False)), F.lit("stream_not_configured"))
        .when(publish_path(kind, date, revision, url).isNull(), F.lit("dataset_invalid"))
    )
