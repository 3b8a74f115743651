"""Decode captured bodies, and what the decoded header and entities say about them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake import constants as K
from transitlake.functions.bodies import words
from transitlake.operators.wire import decoder
from transitlake.schemas import FEED_MESSAGE


def decode_bodies(df: DataFrame, body: str = "body", wanted: T.StructType = FEED_MESSAGE,
                  keep_body: bool = True) -> DataFrame:
    """Add ``decode_status``, ``decode_error`` and ``message`` to rows holding a body.

    ``wanted`` names the part of the message tree to build: Catalyst cannot prune
    columns inside a Python stage, so the caller does. A body that cannot be read
    keeps its row with a NULL message; an empty body has an empty message.
    """
    kept = [f for f in df.schema.fields if keep_body or f.name != body]
    schema = T.StructType(
        kept
        + [
            T.StructField("decode_status", T.StringType()),
            T.StructField("decode_error", T.StringType()),
            T.StructField("message", wanted),
        ]
    )
    return df.mapInArrow(decoder(body, wanted, keep_body), schema)


def _version() -> Column:
    return F.col("message.header.gtfs_realtime_version")


def _readable() -> Column:
    return F.col("decode_status").isin("valid", "protobuf_required_field")


def _has_header() -> Column:
    return _readable() & F.coalesce(_version() != "", F.lit(False))


def header_metadata(decoded: DataFrame) -> DataFrame:
    """Final parse status and the header facts of every decoded body."""
    no_header = _readable() & ~_has_header()
    return (
        decoded
        .withColumn("parse_status", F.when(no_header, F.lit("protobuf_required_field"))
                    .otherwise(F.col("decode_status")))
        .withColumn("parse_error", F.when(no_header, F.lit("no header, or one without a version"))
                    .otherwise(F.coalesce(F.col("decode_error"), F.lit(""))))
        .withColumn("feed_version", F.when(_has_header(), _version()).otherwise(F.lit("")))
        .withColumn("incrementality", F.when(_has_header(), F.col("message.header.incrementality")))
        .withColumn("feed_timestamp", F.when(_has_header(), F.col("message.header.timestamp")))
        .withColumn("entity_count", F.when(_readable(), F.size("message.entity")))
    )


def timestamp_flags(feed_timestamp: Column, observed_at: Column) -> list[Column]:
    """Future and stale flags of an unsigned header timestamp.

    Seconds whose microseconds fit a long are compared as longs. Larger ones cannot be
    cast to a timestamp: they lie in the future, up to where the seconds of a signed
    clock wrap around to the distant past.
    """
    fits = feed_timestamp < F.lit(9_000_000_000_000).cast("decimal(20,0)")
    wraps = feed_timestamp >= F.lit(str(2**63 - K.UNIX_TO_YEAR_ONE_S)).cast("decimal(20,0)")
    feed_us = F.when(fits, feed_timestamp).cast("bigint") * 1000000
    observed_us = F.unix_micros(observed_at)
    future = F.when(fits, feed_us > observed_us + K.FUTURE_TOLERANCE_S * 1000000).otherwise(~wraps)
    stale = F.when(fits, feed_us < observed_us - K.STALE_AFTER_S * 1000000).otherwise(wraps)
    return [F.when(future, F.lit("feed_timestamp_future")), F.when(stale, F.lit("feed_timestamp_stale"))]


def validation_flags(df: DataFrame, observed_at: str = "completed_at",
                     expected_kind: str = "expected_kind") -> DataFrame:
    """The seven decode flags as an array, each at most once, in alphabetical order.

    Expects the output of :func:`header_metadata`; only the presence of each payload
    is looked at, so ENTITY_KIND_MESSAGE is enough.
    """
    kind = F.col(expected_kind)
    checks_kind = ~kind.isin("mixed", "auto")

    def payloads(e: Column) -> Column:
        parts = [e[name].isNotNull().cast("int") for name in ("trip_update", "vehicle", "alert")]
        return reduce(lambda a, b: a + b, parts)

    def actual(e: Column) -> Column:
        # of several payloads the last one in this order counts
        return (F.when(e["alert"].isNotNull(), "alert")
                .when(e["vehicle"].isNotNull(), "vehicle_position")
                .when(e["trip_update"].isNotNull(), "trip_update"))

    def any_entity(test) -> Column:
        return F.coalesce(_readable() & F.exists("message.entity", test), F.lit(False))

    future, stale = timestamp_flags(F.col("feed_timestamp"), F.col(observed_at))
    flags = words(  # kept in alphabetical order, so that nothing is left to sort
        F.when(_has_header() & (F.col("incrementality") == 1), F.lit("differential_incrementality")),
        F.when(any_entity(lambda e: (payloads(e) == 0) & ~F.coalesce(e["is_deleted"], F.lit(False))),
               F.lit("entity_without_payload")),
        future,
        stale,
        F.when(_has_header() & F.col("feed_timestamp").isNull(), F.lit("missing_feed_timestamp")),
        F.when(any_entity(lambda e: payloads(e) > 1), F.lit("multiple_entity_payloads")),
        F.when(checks_kind & any_entity(lambda e: F.coalesce(actual(e) != kind, F.lit(False))),
               F.lit("unexpected_entity_kind")),
    )
    return df.withColumn("validation_flags", flags)
