"""Streaming jobs over the test tables, run until all input is consumed."""

from pyspark.sql import functions as F

from transitlake import scratch_dir
from transitlake.operators import metrics as M
from transitlake.operators.statistics import DAY
from transitlake.plans.retention import delete_paths
from transitlake.schemas import CAPTURE
from transitlake.session import qualified
from transitlake.sources import bodies as B
from transitlake.sources.ledger import Ledger
from transitlake.streaming import counters, daily, landing, registration
from workload.bindings import Bindings, now, text
from workload.landing_files import write_landing
from workload.oracle_views import stamp
from workload.registry import query

KEY = "source_id, stream_id, archive_date"


class StreamBindings(Bindings):
    """The same tables, with events read as a stream."""

    def table(self, name: str):
        if name != "events":
            return super().table(name)
        schema = super().table(name).schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.dir)

    def streams(self):
        # the dimension is static, as configuration is
        return Bindings(self.spark, self.dir).streams()


def _landed(b: Bindings) -> str:
    root = scratch_dir(b.spark, "landing")
    write_landing(b.landing(), root)
    return root


@query("stream_landing", """
SELECT source_id AS source, strftime(local_ts, '%Y-%m-%d') AS date, strftime(local_ts, '%H') AS hour, body_bytes, body_sha256,
  'protobuf_decode' AS parse_status FROM landing_v""")
def stream_landing(b: Bindings):
    """Arriving bodies, decoded once, kept as a bronze table."""
    root = _landed(b)
    arriving = B.stream_bodies(b.spark, root, max_files=100)
    landing.start_bronze(arriving, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return b.spark.read.parquet(f"{root}/bronze").select("source", "date", "hour", "body_bytes", "body_sha256", "parse_status")


@query("arrival_log", """
SELECT source_id AS source, strftime(local_ts, '%Y-%m-%d') AS date, strftime(local_ts, '%H') AS hour, stem || '.pb' AS raw_path,
  CASE WHEN page_id % 8 = 3 THEN 0 WHEN page_id % 8 = 5 THEN NULL ELSE body_bytes END AS body_bytes,
  CASE WHEN page_id % 8 = 3 THEN sha256('') WHEN page_id % 8 = 5 THEN NULL ELSE body_sha256 END AS body_sha256,
  CASE WHEN page_id % 8 = 3 THEN 'empty_body' WHEN page_id % 8 = 5 THEN 'missing_body' ELSE 'protobuf_decode' END AS parse_status FROM landing_v""")
def arrival_log(b: Bindings):
    """Bodies by the documents that name them: an eighth is empty, of another eighth only the document arrived."""
    root = scratch_dir(b.spark, "arrivals")
    number = F.col("page_id") % 8
    pages = b.landing().withColumns({"body": F.when(number == 3, F.lit(b"")).otherwise(F.col("body")),
                                     "decoded_length": F.when(number == 3, 0).otherwise(F.col("decoded_length"))})
    write_landing(pages, root)
    lost = pages.filter(number == 5).select(F.col("raw_path").alias("path"), F.lit("capture").alias("kind"), F.col("capture_id").alias("owner"))
    delete_paths(lost, qualified(b.spark, root)).count()
    landing.start_bronze(B.stream_arrivals(b.spark, root), f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return b.spark.read.parquet(f"{root}/bronze").select("source", "date", "hour", "raw_path", "body_bytes", "body_sha256", "parse_status")


WINDOWS = """(SELECT * FROM (SELECT source_id, stream_id, time_bucket(INTERVAL 15 MINUTE, scheduled_at) AS w, count(*) AS scheduled_ticks,
  count(*) FILTER (WHERE result = 'skipped') AS skipped_ticks, count(*) FILTER (WHERE error_category = 'http_status') AS http_failures,
  count(*) FILTER (WHERE error_category IN ('dns', 'connect', 'tls', 'timeout', 'network')) AS network_failures
  FROM ticks_v GROUP BY 1, 2, 3) WHERE w + INTERVAL 15 MINUTE <= (SELECT max(scheduled_at) FROM ticks_v) - INTERVAL 15 MINUTE)"""


def closed_windows(b: Bindings):
    root = scratch_dir(b.spark, "windows")
    windows = daily.tick_windows(StreamBindings(b.spark, b.dir).ticks())
    (windows.writeStream.format("parquet").outputMode("append").option("path", f"{root}/data")
     .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination())
    return b.spark.read.schema(windows.schema).parquet(f"{root}/data")


@query("tumbling_tick_windows", f"""
SELECT source_id, stream_id, {stamp("w")} AS window_start, scheduled_ticks, skipped_ticks, http_failures, network_failures FROM {WINDOWS}""")
def tumbling_tick_windows(b: Bindings):
    return closed_windows(b).withColumn("window_start", text(F.col("window_start")))


@query("rolled_up_days", f"""
SELECT source_id, stream_id, strftime(timezone(timezone, timezone('UTC', w)), '%Y-%m-%d') AS archive_date,
  CAST(sum(scheduled_ticks) AS BIGINT) AS scheduled_ticks, CAST(sum(skipped_ticks) AS BIGINT) AS skipped_ticks,
  CAST(sum(http_failures) AS BIGINT) AS http_failures, CAST(sum(network_failures) AS BIGINT) AS network_failures
FROM {WINDOWS} JOIN streams_v USING (source_id, stream_id) GROUP BY 1, 2, 3""")
def rolled_up_days(b: Bindings):
    return daily.roll_up_days(closed_windows(b), b.streams())


def _delivered(b: Bindings, root: str, handle) -> None:
    """Captures in two deliveries, most in time and a tenth late; the stream runs to its end after each."""
    captures = b.captures()
    for number, wanted in ((1, "event_id % 10 <> 8"), (2, "event_id % 10 = 8 OR event_id % 10 = 7")):
        captures.filter(wanted).select(*CAPTURE.names).write.parquet(f"{root}/arrive/part={number}")
        arriving = b.spark.readStream.schema(CAPTURE).option("recursiveFileLookup", "true").parquet(f"{root}/arrive")
        registration.start(arriving, handle, f"{root}/checkpoint").awaitTermination()


@query("late_data_revisions", f"""
SELECT {KEY}, 1 AS revision, count(*) AS n, CAST(coalesce(sum(entity_count), 0) AS BIGINT) AS entities FROM captures_v
WHERE event_id % 10 <> 8 GROUP BY {KEY}
UNION ALL
SELECT {KEY}, CASE WHEN count(*) FILTER (WHERE event_id % 10 <> 8) > 0 THEN 2 ELSE 1 END, count(*), CAST(coalesce(sum(entity_count), 0) AS BIGINT)
FROM captures_v GROUP BY {KEY} HAVING count(*) FILTER (WHERE event_id % 10 = 8) > 0""")
def late_data_revisions(b: Bindings):
    """Late captures are never dropped: their days get the next revision."""
    root = scratch_dir(b.spark, "late")
    ledger = Ledger(b.spark, root).create()
    _delivered(b, root, registration.revise_late_days(ledger, now()))
    return ledger.current("compactions").select(*DAY, "revision", F.col("rows").alias("n"), "entities")


@query("idempotent_registration", """
SELECT capture_id, CAST(CASE WHEN event_id % 10 = 8 THEN 1 ELSE 0 END AS BIGINT) AS batch FROM captures_v""")
def idempotent_registration(b: Bindings):
    """A tenth of the captures is delivered twice, and registered once."""
    root = scratch_dir(b.spark, "register")
    ledger = Ledger(b.spark, root).create()

    def handle(batch, batch_id):
        registration.register(ledger, batch, batch_id)

    _delivered(b, root, handle)
    return ledger.changes("captures").select("capture_id", F.col("change_seq").alias("batch"))


@query("running_counters", """
SELECT source_id, stream_id, result, count(*) AS n FROM ticks_v GROUP BY ALL""")
def running_counters(b: Bindings):
    root = scratch_dir(b.spark, "counters")
    counted = M.fetch_attempts(StreamBindings(b.spark, b.dir).ticks())
    counters.start_counters(counted, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    changes = b.spark.read.schema("source_id string, stream_id string, result string, n bigint, batch_id bigint").parquet(f"{root}/data")
    return counters.current_counters(changes, ("source_id", "stream_id", "result"))


@query("running_gauges", """
SELECT source_id, stream_id, CAST(floor(max(epoch(completed_at))) AS BIGINT) AS last_capture,
  CAST(floor(max(epoch(completed_at)) FILTER (WHERE is_valid)) AS BIGINT) AS last_valid_capture,
  arg_max(feed_timestamp, epoch_us(completed_at)::HUGEINT * 1000000 + event_id)
    FILTER (WHERE is_valid AND feed_timestamp IS NOT NULL) AS last_feed_timestamp
FROM captures_v GROUP BY source_id, stream_id""")
def running_gauges(b: Bindings):
    root = scratch_dir(b.spark, "gauges")
    seen = M.last_seen(StreamBindings(b.spark, b.dir).captures())
    counters.start_counters(seen, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    changes = b.spark.read.schema(
        "source_id string, stream_id string, last_capture bigint, last_valid_capture bigint, last_feed_timestamp decimal(20,0), batch_id bigint"
    ).parquet(f"{root}/data")
    return counters.current_counters(changes, M.STREAM_KEYS).withColumn("last_feed_timestamp", F.col("last_feed_timestamp").cast("bigint"))
