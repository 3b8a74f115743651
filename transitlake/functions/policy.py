"""Retry, lateness and phase rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transitlake import constants as K


def is_permanent(category: Column) -> Column:
    return F.coalesce(category.isin(*K.PERMANENT_CATEGORIES), F.lit(False))


def retry_status(category: Column) -> Column:
    return F.when(is_permanent(category), F.lit("permanent_failure")).otherwise(F.lit("retry"))


def retry_bound_s(attempt: Column) -> Column:
    """Longest wait before attempt n, in seconds; the wait itself is drawn below it."""
    doublings = F.least(F.greatest(attempt, F.lit(1)) - 1, F.lit(K.RETRY_MAX_DOUBLINGS))
    bound = F.lit(K.RETRY_BASE_S) * F.pow(F.lit(2.0), doublings)
    return F.least(bound, F.lit(float(K.RETRY_MAX_S))).cast("bigint")


def next_attempt_at(category: Column, attempt: Column, now: Column, jitter: Column) -> Column:
    """``jitter`` in [0, 1] is a parameter, so that the outcome can be tested."""
    wait = F.floor(retry_bound_s(attempt) * jitter).cast("bigint")
    retry = F.timestamp_seconds(F.unix_micros(now) / 1000000 + wait)
    return F.when(is_permanent(category), now + F.expr("INTERVAL 100 YEARS")).otherwise(retry)


def effective_lateness_ms(configured: Column, interval: Column) -> Column:
    return (
        F.when(configured <= 0, F.lit(0))
        .when(configured >= interval, F.floor(interval / 2))
        .otherwise(configured)
        .cast("bigint")
    )


def is_late(started_at: Column, scheduled_at: Column, configured: Column, interval: Column) -> Column:
    late_us = F.unix_micros(started_at) - F.unix_micros(scheduled_at)
    return late_us > effective_lateness_ms(configured, interval) * 1000


def stable_phase_ns(key: Column, interval_ns: Column) -> Column:
    """FNV-1a of the stream key modulo its interval, exact in 64-bit unsigned arithmetic.

    Decimals carry the 64-bit products, whose 104 bits fit into 38 digits; only the
    low byte takes part in the exclusive-or.
    """
    digits = F.hex(key.cast("binary"))
    octets = F.transform(
        F.sequence(F.lit(1), F.octet_length(key.cast("binary"))),
        lambda i: F.conv(F.substring(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("int"),
    )

    def step(acc: Column, octet: Column) -> Column:
        low = (acc % F.lit(256).cast("decimal(3,0)")).cast("int")
        mixed = acc - low.cast("decimal(20,0)") + low.bitwiseXOR(octet).cast("decimal(20,0)")
        product = mixed.cast("decimal(20,0)") * F.lit(K.FNV64_PRIME).cast("decimal(13,0)")
        return (product % F.lit(str(K.TWO_64)).cast("decimal(20,0)")).cast("decimal(20,0)")

    digest = F.aggregate(octets, F.lit(str(K.FNV64_OFFSET)).cast("decimal(20,0)"), step)
    phase = (digest % interval_ns.cast("decimal(20,0)")).cast("bigint")
    return F.when(interval_ns <= 0, F.lit(0).cast("bigint")).otherwise(phase)
