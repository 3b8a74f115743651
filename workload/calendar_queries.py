"""Calendar, URLs, paths, shapes, retry policy and the poll grid."""

from pyspark.sql import functions as F

from transitlake.functions import calendar as C
from transitlake.functions import paths as P
from transitlake.functions import policy as R
from transitlake.functions import urls as U
from transitlake.operators import grid as G
from workload.bindings import Bindings, now, text
from workload.oracle_views import stamp
from workload.registry import query


@query("local_date_and_hour", """
SELECT event_id, strftime(local_ts, '%Y-%m-%d') AS archive_date, strftime(local_ts, '%H') AS hour FROM local_v""")
def local_date_and_hour(b: Bindings):
    e = b.events().join(b.streams().select("source_id", "stream_id", "timezone"), ["source_id", "stream_id"])
    at, tz = F.col("scheduled_at"), F.col("timezone")
    return e.select("event_id", C.local_date_text(at, tz).alias("archive_date"), C.local_hour_text(at, tz).alias("hour"))


ZONES = "(VALUES ('America/Vancouver'), ('America/Toronto'), ('America/Halifax'), ('UTC')) z(tz)"


@query("local_day_bounds", f"""
SELECT strftime(d, '%Y-%m-%d') AS date, tz, {stamp("lo")} AS day_start, {stamp("hi")} AS day_end,
  CAST(epoch(hi) - epoch(lo) AS BIGINT) // 3600 AS hours
FROM (SELECT d, tz, timezone('UTC', timezone(tz, CAST(d AS TIMESTAMP))) AS lo,
        timezone('UTC', timezone(tz, CAST(d AS TIMESTAMP) + INTERVAL 1 DAY)) AS hi
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) CROSS JOIN {ZONES})""")
def local_day_bounds(b: Bindings):
    zones = F.array(*[F.lit(z) for z in ("America/Vancouver", "America/Toronto", "America/Halifax", "UTC")])
    days = b.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    d, tz = F.col("d"), F.col("tz")
    lo, hi = C.day_start(d, tz), C.day_end(d, tz)
    return days.withColumn("tz", F.explode(zones)).select(
        d.cast("string").alias("date"), "tz", text(lo).alias("day_start"), text(hi).alias("day_end"),
        ((F.unix_seconds(hi) - F.unix_seconds(lo)) / 3600).cast("bigint").alias("hours"))


@query("sanitize_url", """
SELECT page_id, v, CASE WHEN regexp_matches(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]') THEN
  lower(split_part(u, '://', 1)) || '://' || regexp_replace(regexp_replace(substr(u, strpos(u, '://') + 3), '[?#].*$', ''), '^[^/@]*@', '') END AS url
FROM (SELECT page_id, unnest([1, 2, 3, 4]) AS v, unnest([url, replace(url, '://', '://user:pa@'), upper(url),
  regexp_replace(url, '^[a-z]+:', '')]) AS u FROM pages)""")
def sanitize_url(b: Bindings):
    url = F.col("url")
    variants = F.array(url, F.replace(url, F.lit("://"), F.lit("://user:pa@")), F.upper(url),
                       F.regexp_replace(url, "^[a-z]+:", ""))
    return b.table("pages").select("page_id", F.posexplode(variants).alias("v", "u")).select(
        "page_id", (F.col("v") + 1).alias("v"), U.sanitize_url(F.col("u")).alias("url"))


@query("base64url_key", """
SELECT page_id, rtrim(replace(replace(base64(encode(url)), '+', '-'), '/', '_'), '=') AS url_key,
  rtrim(replace(replace(base64(encode(html)), '+', '-'), '/', '_'), '=') AS html_key FROM pages""")
def base64url_key(b: Bindings):
    return b.table("pages").select("page_id", U.base64url(F.col("url")).alias("url_key"),
                                   U.base64url(F.col("html")).alias("html_key"))


PUBLISH = """
SELECT source_id, stream_id, archive_date, revision,
  CASE expected_kind WHEN 'vehicle_position' THEN 'vehicle_positions' WHEN 'trip_update' THEN 'trip_updates'
    WHEN 'alert' THEN 'service_alerts' WHEN 'mixed' THEN 'mixed' WHEN 'auto' THEN 'mixed' END AS feed_type,
  CASE WHEN stream_id = 'click' AND sanitized_url = '' THEN NULL WHEN sanitized_url <> '' THEN sanitized_url
    ELSE 'https://' || source_id || '.example.test:8443/' || stream_id END AS url, stream_id = 'click' AS gone
FROM manifests_v"""


@query("publish_path", f"""
SELECT source_id, stream_id, archive_date, revision, feed_type,
  'base/x/' || feed_type || '/date=' || archive_date || '/base64url='
    || rtrim(replace(replace(base64(encode(url)), '+', '-'), '/', '_'), '=') || '/revision=' || revision AS path,
  CASE WHEN feed_type IS NULL THEN 'dataset_invalid' WHEN url IS NULL THEN 'stream_not_configured' END AS error
FROM ({PUBLISH})""")
def publish_path(b: Bindings):
    streams = b.streams().filter("stream_id <> 'click'").select("source_id", "stream_id", F.col("url").alias("config_url"))
    m = b.manifests().join(streams, ["source_id", "stream_id"], "left")
    url = F.coalesce(F.nullif("sanitized_url", F.lit("")), U.sanitize_url(F.col("config_url")))
    kind, date, revision = F.col("expected_kind"), F.col("archive_date"), F.col("revision")
    return m.select(
        "source_id", "stream_id", "archive_date", "revision", P.feed_type(kind).alias("feed_type"),
        P.publish_path(kind, date, revision, url, F.lit("base/x/")).alias("path"),
        P.publish_error(kind, date, revision, url, F.col("config_url").isNotNull()).alias("error"))


@query("path_consistency", """
SELECT capture_id, page_id % 5 <> 1 AND page_id % 7 <> 2 AND page_id % 11 <> 3 AND page_id % 13 <> 4 AS consistent FROM landing_v""")
def path_consistency(b: Bindings):
    page = F.col("page_id")
    broken = b.landing().withColumns({
        "archive_date": F.when(page % 5 == 1, "2023-01-01").otherwise(F.col("archive_date")),
        "raw_path": F.when(page % 7 == 2, F.concat("raw_path", F.lit("x"))).otherwise(F.col("raw_path")),
        "body_sha256": F.when(page % 11 == 3, F.substring("body_sha256", 1, 63)).otherwise(F.col("body_sha256")),
        "format_version": F.when(page % 13 == 4, 2).otherwise(1),
    })
    return broken.select("capture_id", P.path_is_consistent().alias("consistent"))


@query("shape_predicates", r"""
SELECT page_id, regexp_full_match(a, '[a-z0-9][a-z0-9_-]{0,62}') AS is_id, regexp_full_match(b, '\d{4}-\d{2}-\d{2}') AS is_date,
  regexp_full_match(c, '[A-Za-z0-9_.=-]+(/[A-Za-z0-9_.=-]+)*') AS is_path, regexp_full_match(d, '[a-fA-F0-9]{64}') AS is_sha
FROM (SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS h, substr(sha256(html), 1, 63 + CAST(page_id % 3 AS INTEGER)) AS d,
   replace(split_part(split_part(url, '://', 2), '/', 1), '.', CASE WHEN page_id % 2 = 0 THEN '-' ELSE '.' END) AS a,
   CASE WHEN page_id % 4 = 0 THEN '2024-1-01' ELSE '2024-01-0' || (page_id % 10) END AS b,
   split_part(url, '://', 2) AS c FROM pages)""")
def shape_predicates(b: Bindings):
    page = F.col("page_id")
    rest = F.split_part("url", F.lit("://"), F.lit(2))
    host = F.split_part(rest, F.lit("/"), F.lit(1))
    return b.table("pages").select(
        "page_id",
        P.is_valid_id(F.replace(host, F.lit("."), F.when(page % 2 == 0, F.lit("-")).otherwise(F.lit(".")))).alias("is_id"),
        P.is_date_text(F.when(page % 4 == 0, F.lit("2024-1-01")).otherwise(
            F.concat(F.lit("2024-01-0"), (page % 10).cast("string")))).alias("is_date"),
        P.is_safe_path(rest).alias("is_path"),
        P.is_sha256(F.substring(F.sha2("html", 256), F.lit(1), (63 + page % 3).cast("int"))).alias("is_sha"))


@query("retry_policy", f"""
SELECT publication_id, attempt_count, CAST(least(21600, 300 * pow(2, least(greatest(attempt_count, 1) - 1, 6))) AS BIGINT) AS bound_s,
  CASE WHEN category IN ('local_integrity', 'remote_integrity', 'dataset_invalid') THEN 'permanent_failure' ELSE 'retry' END AS status,
  {stamp("CASE WHEN category IN ('local_integrity', 'remote_integrity', 'dataset_invalid') THEN TIMESTAMP '2024-01-25 12:00:00' + INTERVAL 100 YEAR ELSE TIMESTAMP '2024-01-25 12:00:00' + to_seconds(CAST(floor(least(21600, 300 * pow(2, least(greatest(attempt_count, 1) - 1, 6))) * 0.5) AS BIGINT)) END")} AS next_at
FROM (SELECT *, ['timeout', 'local_integrity', 'network', 'remote_integrity', 'dataset_invalid'][CAST(publication_id % 5 AS INTEGER) + 1] AS category FROM publications_v)""")
def retry_policy(b: Bindings):
    names = F.array(*[F.lit(x) for x in ("timeout", "local_integrity", "network", "remote_integrity", "dataset_invalid")])
    category = F.element_at(names, (F.col("publication_id") % 5).cast("int") + 1)
    attempt = F.col("attempt_count")
    return b.publications().select(
        "publication_id", "attempt_count", R.retry_bound_s(attempt).alias("bound_s"), R.retry_status(category).alias("status"),
        text(R.next_attempt_at(category, attempt, now(), F.lit(0.5))).alias("next_at"))


@query("late_start", """
SELECT tick_id, lateness_ms, epoch_us(started_at) - epoch_us(scheduled_at) > lateness_ms * 1000 AS late
FROM (SELECT *, CASE WHEN max_start_lateness_ms <= 0 THEN 0 WHEN max_start_lateness_ms >= interval_ms
  THEN interval_ms // 2 ELSE max_start_lateness_ms END AS lateness_ms FROM ticks_v JOIN streams_v USING (source_id, stream_id))""")
def late_start(b: Bindings):
    ticks = b.ticks().join(b.streams(), ["source_id", "stream_id"])
    limits = F.col("max_start_lateness_ms"), F.col("interval_ms")
    return ticks.select("tick_id", R.effective_lateness_ms(*limits).alias("lateness_ms"),
                        R.is_late(F.col("started_at"), F.col("scheduled_at"), *limits).alias("late"))


def polled_streams(b: Bindings):
    """The stream dimension with the range its ticks cover and a phase that SQL can follow."""
    seen = b.ticks().groupBy("source_id", "stream_id").agg(
        F.min("scheduled_at").alias("first_at"), F.max("scheduled_at").alias("last_at"))
    slow = b.streams().withColumn("interval_ms", F.lit(900000).cast("bigint"))
    return slow.join(seen, ["source_id", "stream_id"]).withColumn(
        "phase_us", (F.substring("source_id", 2, 1).cast("bigint") * 7 + F.length("stream_id")) * 1000000)


GRID = """grid_v AS (
  SELECT source_id, stream_id, k AS tick_number, make_timestamp(phase + k * 900000000) AS scheduled_at
  FROM (SELECT source_id, stream_id, phase, unnest(generate_series(
      CAST(floor((lo - phase) / 900000000.0) AS BIGINT) + 1, CAST(floor((hi - phase) / 900000000.0) AS BIGINT))) AS k
    FROM (SELECT source_id, stream_id, epoch_us(min(scheduled_at)) AS lo, epoch_us(max(scheduled_at)) AS hi,
        (CAST(substr(source_id, 2, 1) AS BIGINT) * 7 + length(stream_id)) * 1000000 AS phase
      FROM ticks_v GROUP BY source_id, stream_id)))"""


@query("tick_grid", f"""
SELECT source_id, stream_id, tick_number, {stamp("scheduled_at")} AS scheduled_at FROM (WITH {GRID} SELECT * FROM grid_v)""")
def tick_grid(b: Bindings):
    grid = G.tick_grid(polled_streams(b), F.col("first_at"), F.col("last_at"))
    return grid.withColumn("scheduled_at", text(F.col("scheduled_at")))


@query("grid_coverage", f"""
SELECT g.source_id, g.stream_id, {stamp("g.scheduled_at")} AS scheduled_at FROM (WITH {GRID} SELECT * FROM grid_v) g
WHERE NOT EXISTS (SELECT 1 FROM ticks_v t WHERE t.source_id = g.source_id AND t.stream_id = g.stream_id
  AND epoch_us(t.scheduled_at) // 900000000 = epoch_us(g.scheduled_at) // 900000000)""")
def grid_coverage(b: Bindings):
    """Recorded ticks are snapped to the grid's quarter hours, as the polls they stand for are."""
    streams = polled_streams(b)
    grid = G.tick_grid(streams, F.col("first_at"), F.col("last_at"))
    period = F.floor(F.unix_micros("scheduled_at") / 900000000)
    snapped = b.ticks().join(streams.select("source_id", "stream_id", "phase_us"), ["source_id", "stream_id"]).withColumn(
        "scheduled_at", F.timestamp_micros(period * 900000000 + F.col("phase_us")))
    return G.missed_ticks(grid, snapped).select("source_id", "stream_id", text(F.col("scheduled_at")).alias("scheduled_at"))


@query("stable_phase", """
SELECT source_id, stream_id, CAST((list_reduce(list_transform(string_split(source_id || '/' || stream_id, ''), lambda c: ascii(c)::UHUGEINT),
  lambda h, c: (xor(h, c) * 1099511628211::UHUGEINT) % 18446744073709551616::UHUGEINT, 14695981039346656037::UHUGEINT)
  % 30000000000) // 1000 AS BIGINT) AS phase_us FROM streams_v""")
def stable_phase(b: Bindings):
    return G.with_phase(b.streams()).select("source_id", "stream_id", "phase_us")


@query("hysteresis", """
SELECT event_id, coalesce(last_value(CASE WHEN value >= 90 THEN TRUE WHEN value <= 10 THEN FALSE END IGNORE NULLS) OVER (
  PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), FALSE) AS paused FROM events""")
def hysteresis(b: Bindings):
    series = b.table("events")
    return G.hysteresis(series, "value", ("event_type",), ("ts", "event_id"), 90.0, 10.0, instant="ts").select("event_id", "paused")
