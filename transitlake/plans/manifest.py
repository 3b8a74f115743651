"""Daily quality manifests and the summaries kept after metadata retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.calendar import day_end, day_start
from transitlake.functions.paths import schema_version
from transitlake.functions.urls import sanitize_url
from transitlake.operators import statistics as S
from transitlake.operators.ledger import REVISION
from transitlake.operators.statistics import DAY
from transitlake.schemas import ARTIFACT

_ZERO_TICKS = ("scheduled_ticks", "skipped_ticks", "http_failures", "network_failures")
_ZERO_CAPTURES = ("captured_responses", "valid_snapshots", "invalid_payloads", "entity_total",
                  "largest_fetch_gap_ms")


def day_facts(captures: DataFrame, ticks: DataFrame, streams: DataFrame) -> DataFrame:
    """All statistics of every stream-day that has ticks or captures.

    Ticks are read once, captures twice: once combined, once for the gaps. All parts
    are grouped by the same key, so the joins reuse their partitioning. ``ticks``
    carry ``archive_date`` (see :func:`with_local_day`).
    """
    day = list(DAY)
    empty = F.create_map().cast("map<string,bigint>")
    facts = (
        S.tick_facts(ticks)
        .join(S.capture_facts(captures), day, "full_outer")
        .join(S.largest_fetch_gap(captures), day, "left")
    )
    zeros = {n: F.coalesce(n, F.lit(0).cast("bigint")) for n in (*_ZERO_TICKS, *_ZERO_CAPTURES)}
    maps = {n: F.coalesce(n, empty) for n in ("failure_category_counts", "parse_status_counts", "validation_flag_counts")}
    facts = facts.withColumns({**zeros, **maps})
    dimension = streams.select("source_id", "stream_id", "expected_kind", "timezone", "registry_id",
                               "license_url", "attribution", F.col("url").alias("_url"))
    return facts.join(dimension, ["source_id", "stream_id"])


def build_manifests(captures: DataFrame, ticks: DataFrame, streams: DataFrame, days: DataFrame,
                    destinations: DataFrame, created_at: Column, config_fingerprint: str = "",
                    application_version: str = "", protobuf_revision: str = "",
                    stop_totals: DataFrame | None = None) -> DataFrame:
    """One manifest row per stream-day and revision in ``days``.

    A day without captures still gets one. ``urls_agree`` is false where the captures
    of a day name different URLs; such a day must not be published. The long lists,
    inputs and files, live in their own tables and join through the revision.
    """
    kind = F.col("expected_kind")
    selected = (
        days.select(*REVISION)
        .join(day_facts(captures, ticks, streams), list(DAY), "left")
    )
    if stop_totals is not None:
        selected = selected.join(stop_totals.select(*DAY, F.col("stop_time_updates").alias("_stops")), list(DAY), "left")
    else:
        selected = selected.withColumn("_stops", F.lit(None).cast("bigint"))
    fixed = {
        "manifest_version": F.lit(K.MANIFEST_FORMAT_VERSION),
        "format_version": F.lit(K.PARQUET_FORMAT_VERSION),
        "schema_version": schema_version(kind),
        "dataset_status": F.when(F.col("captured_responses") > 0, F.lit("ready"))
        .otherwise(F.lit("no_captured_responses")),
        "predecessor_revision": F.when(F.col("revision") > 1, F.col("revision") - 1),
        "sanitized_url": F.coalesce("captured_url", sanitize_url(F.col("_url"))),
        "urls_agree": F.coalesce("urls_agree", F.lit(True)),
        "day_start_utc": day_start(F.col("archive_date"), F.col("timezone")),
        "day_end_utc": day_end(F.col("archive_date"), F.col("timezone")),
        "application_version": F.lit(application_version),
        "protobuf_revision": F.lit(protobuf_revision),
        "config_fingerprint": F.lit(config_fingerprint),
        "created_at": created_at,
        "attribution": F.trim("attribution"),
        "stop_time_update_total": F.when(kind == "trip_update", F.coalesce("_stops", F.lit(0).cast("bigint"))),
    }
    manifests = selected.withColumns(fixed).drop("captured_url", "_url", "_stops")
    return with_destinations(manifests, destinations)


def with_destinations(manifests: DataFrame, destinations: DataFrame) -> DataFrame:
    """Attach the destination snapshot: configuration, read once as a one-row scalar."""
    entry = F.struct(F.col("id"), F.col("required"))
    required = destinations.agg(
        F.array_sort(F.collect_list(F.when(F.col("required"), F.col("id"))))).scalar()
    snapshot = destinations.agg(F.array_sort(F.collect_list(entry))).scalar()
    return manifests.withColumns({"required_destinations": required, "destinations": snapshot})


def manifest_documents(manifests: DataFrame, inputs: DataFrame, files: DataFrame) -> DataFrame:
    """Manifests with their files and inputs listed inside, ready to be written as JSON.

    Every document has both lists whole. A list is one stream's polls of one local day:
    a stream is polled at most once a second, and a local day has at most 25 hours.
    """
    keys = list(REVISION)
    listed = manifests.select(*keys)
    entry = F.struct("scheduled_at", "id", "sha256", "bytes")
    input_lists = (
        inputs.join(listed, keys, "left_semi").groupBy(*keys)
        .agg(F.array_sort(F.collect_list(entry)).alias("_inputs"))
        .select(*keys, F.transform("_inputs", lambda i: i.dropFields("scheduled_at")).alias("input_captures"))
    )
    numbered = F.struct("part", F.struct(*ARTIFACT.names).alias("file"))
    file_lists = (
        files.join(listed, keys, "left_semi").groupBy(*keys)
        .agg(F.array_sort(F.collect_list(numbered)).alias("_files"))
        .select(*keys, F.transform("_files", lambda f: f["file"]).alias("files"))
    )
    return manifests.join(input_lists, keys, "left").join(file_lists, keys, "left")


def daily_summaries(captures: DataFrame, ticks: DataFrame, days: DataFrame, summarized_at: Column) -> DataFrame:
    """What remains of a stream-day once its detail is dropped."""
    day = list(DAY)
    zero, empty = F.lit(0).cast("bigint"), F.create_map().cast("map<string,bigint>")
    joined = days.select(*DAY).join(S.tick_facts(ticks), day, "left").join(S.capture_facts(captures), day, "left")
    return joined.select(
        *DAY, *[F.coalesce(n, zero).alias(n) for n in (*_ZERO_TICKS, "captured_responses", "valid_snapshots", "invalid_payloads")],
        F.coalesce("parse_status_counts", empty).alias("parse_status_counts"),
        summarized_at.alias("summarized_at"),
    )
