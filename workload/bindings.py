"""The lake's tables seen in the shared test tables.

``events`` stand for polls: ticks, captures, revisions and publications are derived
from them by arithmetic on the event id. ``orders`` with their ``lineitem`` rows are
trip updates with stop times, and ``pages`` are captured bodies with a URL.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.functions import bodies as B
from transitlake.functions.calendar import local_date_text
from transitlake.functions.paths import capture_stem, revision_directory
from transitlake.functions.urls import sanitize_url
from transitlake.operators.decode import timestamp_flags
from transitlake.operators.ledger import REVISION
from transitlake.operators.statistics import DAY, with_local_day
from transitlake.session import configure

KIND_OF = {"click": "vehicle_position", "purchase": "trip_update", "signup": "alert",
           "view": "mixed", "error": "auto"}
ZONE_OF = {"s0": "America/Vancouver", "s1": "America/Toronto", "s2": "America/Halifax", "s3": "UTC"}
LATENESS_OF = {"s0": 0, "s1": 5000, "s2": 60000, "s3": 20000}
STATUSES = ("pending", "retry", "uploading", "verified", "permanent_failure", "retired", "expired")
NOW = "2024-01-25 12:00:00"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def text(instant: Column) -> Column:
    """Instants leave the queries as text, to be compared between engines."""
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def pick(column: Column, table: dict) -> Column:
    chain = F
    for key, value in table.items():
        chain = chain.when(column == key, F.lit(value))
    return chain


def once(method):
    """Build a table's plan once per instance; no data is kept."""

    @wraps(method)
    def build(self, *args):
        key = (method.__name__, *args)
        if key not in self.plans:
            self.plans[key] = method(self, *args)
        return self.plans[key]

    return build


class Bindings:
    """Lazily derived tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = configure(spark), sf_dir
        self.plans: dict[tuple, DataFrame] = {}

    @once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @once
    def events(self) -> DataFrame:
        raw = self.table("events")
        return raw.withColumns({
            "source_id": F.concat(F.lit("s"), (F.col("user_id") % 4).cast("string")),
            "stream_id": F.col("event_type"),
            "scheduled_at": F.col("ts").cast("timestamp"),
            "m": F.col("event_id") % 20,
        })

    @once
    def streams(self) -> DataFrame:
        pairs = self.events().select("source_id", "stream_id").distinct()
        source = F.col("source_id")
        return pairs.select(
            "source_id", "stream_id",
            pick(F.col("stream_id"), KIND_OF).alias("expected_kind"),
            F.concat(F.lit("https://user:pw@"), source, F.lit(".example.test:8443/"), "stream_id",
                     F.lit("?key=1#top")).alias("url"),
            pick(source, ZONE_OF).alias("timezone"),
            F.lit(30000).cast("bigint").alias("interval_ms"),
            pick(source, LATENESS_OF).cast("bigint").alias("max_start_lateness_ms"),
            F.concat(F.lit("reg-"), source).alias("registry_id"),
            F.lit("https://example.test/license").alias("license_url"),
            F.concat(F.lit(" data of "), source, F.lit(" ")).alias("attribution"),
        )

    def _parse_status(self) -> Column:
        event, m = F.col("event_id"), F.col("m")
        return (F.when(m == 5, "protobuf_decode")
                .when((m == 6) & (event % 3 == 0), "protobuf_required_field").otherwise("valid"))

    @once
    def ticks(self) -> DataFrame:
        """All polls with their local day."""
        event, m = F.col("event_id"), F.col("m")
        category = pick(m, {1: "http_status", 2: "timeout", 3: "dns", 4: "body_too_large"})
        result = (F.when(m == 0, "skipped").when(m <= 4, "failed")
                  .otherwise(B.capture_result(self._parse_status(), event % 33 != 0)))
        ticks = self.events().select(
            F.concat(F.lit("t"), F.lpad(event.cast("string"), 12, "0")).alias("tick_id"),
            "source_id", "stream_id", "scheduled_at",
            F.timestamp_micros(F.unix_micros("scheduled_at") + (event % 23) * 1000000).alias("started_at"),
            F.timestamp_micros(F.unix_micros("scheduled_at") + (event % 7) * 1000000).alias("finished_at"),
            result.alias("result"),
            F.when((m == 0) & (event % 40 == 0), "disk_pressure").when(m == 0, "late").otherwise("").alias("skip_reason"),
            F.coalesce(category, F.lit("")).alias("error_category"), F.lit("").alias("error_detail"),
            F.when(m == 1, 503).when(m >= 4, 200).otherwise(0).alias("http_status"),
            (1 + event % 2).cast("int").alias("attempts"), F.lit("f").alias("config_fingerprint"),
        )
        return with_local_day(ticks, self.streams())

    @once
    def captures(self) -> DataFrame:
        """Kept responses, with every column of the capture schema, and ``event_id``."""
        event, c = F.col("event_id"), F.col
        props = c("props").cast("binary")
        size = F.octet_length(props).cast("bigint")
        kept = self.events().filter("m >= 5").withColumns({
            "expected_kind": pick(c("stream_id"), KIND_OF),
            "timezone": pick(c("source_id"), ZONE_OF),
            "capture_id": F.concat(F.lit("c"), F.lpad(event.cast("string"), 12, "0")),
            "completed_at": F.timestamp_micros(F.unix_micros("scheduled_at") + (event % 7) * 1000000),
            "parse_status": self._parse_status(),
            "encoded_length": size,
            "advertised_length": F.when(event % 33 == 0, size + 1).when(event % 2 == 0, size).otherwise(F.lit(-1)),
            "response_headers": F.create_map(
                F.lit("Content-Type"), F.when(event % 17 == 0, "text/plain")
                .when(event % 5 == 0, "Application/X-Protobuf; charset=utf-8").otherwise("application/x-protobuf"),
                F.lit("ETag"), F.when(event % 3 == 0, "").otherwise(F.concat(F.lit("<"), event.cast("string"), F.lit(">"))),
                F.lit("Server"), F.lit("x")),
            "body_sha256": B.body_sha256(props),
        })
        valid = c("parse_status") == "valid"
        skew = F.when(event % 101 == 0, -100000).when(event % 103 == 0, 1000).otherwise(0)
        stamp = F.floor(F.unix_micros("scheduled_at") / 1000000) - event % 11 + skew
        kept = kept.withColumns({
            "transport_complete": B.transport_complete(F.lit(False), c("encoded_length"), c("advertised_length")),
            "feed_timestamp": F.when(valid & (event % 13 != 0), stamp).cast("decimal(20,0)"),
            "incrementality": F.when(valid, F.when(event % 19 == 0, 1).otherwise(0)),
            "entity_count": F.when(c("parse_status") != "protobuf_decode",
                                   F.get_json_object("props", "$.k").cast("int")),
            "archive_date": local_date_text(c("scheduled_at"), c("timezone")),
        })
        decode_flags = B.words(
            F.when(c("incrementality") == 1, F.lit("differential_incrementality")),
            *timestamp_flags(c("feed_timestamp"), c("completed_at")),
            F.when(valid & c("feed_timestamp").isNull(), F.lit("missing_feed_timestamp")),
        )
        flags = B.ingest_flags(decode_flags, F.element_at("response_headers", "Content-Type"), c("transport_complete"))
        stem = capture_stem(c("source_id"), c("stream_id"), c("scheduled_at"), c("timezone"), c("capture_id"),
                            c("body_sha256"))
        return kept.select(
            F.lit(1).alias("format_version"), "capture_id",
            F.concat(F.lit("t"), F.lpad(event.cast("string"), 12, "0")).alias("tick_id"),
            "source_id", "stream_id", "expected_kind", "scheduled_at", c("scheduled_at").alias("started_at"),
            "completed_at", "archive_date", "timezone",
            sanitize_url(F.concat(F.lit("https://user:pw@"), "source_id", F.lit(".example.test:8443/"), "stream_id",
                                  F.lit("?key=1#top"))).alias("sanitized_url"),
            F.lit(200).alias("http_status"), "response_headers", (event % 5000).alias("duration_ms"),
            (1 + event % 2).cast("int").alias("attempt_count"), "advertised_length", "encoded_length",
            c("encoded_length").alias("decoded_length"), F.lit("").alias("content_encoding"), "body_sha256",
            F.concat(stem, F.lit(".pb")).alias("raw_path"), F.concat(stem, F.lit(".json")).alias("sidecar_path"),
            "transport_complete", "parse_status",
            F.when(valid, "").otherwise("DecodeError").alias("parse_error"),
            F.when(valid, "2.0").otherwise("").alias("feed_version"), "incrementality", "feed_timestamp",
            "entity_count", flags.alias("validation_flags"), F.lit("f").alias("config_fingerprint"),
            F.lit("1.0").alias("application_version"), F.lit("r1").alias("protobuf_revision"),
            "event_id", "props",
        )

    # --- revisions -----------------------------------------------------------
    def _dayed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_d", F.to_date("archive_date")).withColumn("_dom", F.dayofmonth("_d"))

    @once
    def revisions(self) -> DataFrame:
        """The revision numbers of each stream-day: none, one or two."""
        days = self._dayed(self.ticks().select(*DAY).distinct())
        numbers = (F.when(F.col("_dom") % 5 == 4, F.array().cast("array<int>"))
                   .when(F.col("_dom") % 4 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        kinds = {"click": 0, "error": 1, "purchase": 2, "signup": 3, "view": 4}
        place = F.datediff("_d", F.lit("2023-12-30").cast("date")) * 20 \
            + F.substring("source_id", 2, 1).cast("int") * 5 + pick(F.col("stream_id"), kinds)
        return days.withColumn("revision", F.explode(numbers)).withColumn(
            "compaction_id", (place * 10 + F.col("revision")).cast("bigint"))

    def _in_revision(self) -> Column:
        return (F.col("event_id") % 10 != 9) | ((F.col("revision") == 2) & (F.col("_dom") % 8 == 0))

    @once
    def inputs_wide(self) -> DataFrame:
        return self.captures().join(self.revisions(), list(DAY)).filter(self._in_revision())

    def inputs(self) -> DataFrame:
        return self.inputs_wide().select("compaction_id", "capture_id")

    @once
    def compactions(self) -> DataFrame:
        totals = self.inputs_wide().groupBy("compaction_id").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("entity_count").cast("bigint").alias("entities"))
        base = F.col("_d").cast("timestamp")
        directory = revision_directory(F.col("source_id"), F.col("stream_id"), F.col("archive_date"), F.col("revision"))
        retained = F.col("_dom") % 10 == 0
        return self.revisions().join(totals, "compaction_id", "left").select(
            "compaction_id", *DAY, F.lit(1).alias("format_version"), "revision",
            F.when(F.col("_dom") % 3 == 0, "ready").otherwise("published").alias("status"),
            directory.alias("directory"),
            F.when(retained, "").otherwise(F.concat(directory, F.lit("/data.parquet"))).alias("data_path"),
            F.when(retained, "").otherwise(F.concat(directory, F.lit("/manifest.json"))).alias("manifest_path"),
            F.sha2(directory.cast("binary"), 256).alias("data_sha256"),
            F.when(retained, 0).otherwise(F.col("compaction_id") * 10).cast("bigint").alias("data_bytes"),
            F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("entities", F.lit(0)).alias("entities"),
            F.array(F.lit("primary")).alias("required_destinations"),
            (base + F.expr("INTERVAL 1 DAY 15 MINUTES")).alias("created_at"),
            F.when(F.col("_dom") % 3 != 0, base + F.expr("INTERVAL 2 DAYS")).alias("published_at"),
        )

    @once
    def destinations(self) -> DataFrame:
        """Configuration: the destinations named by the publications, with their address."""
        ids = self.publications().select(F.col("destination_id").alias("id"), "required").distinct()
        return ids.withColumn("remote", F.concat(F.lit("lake/"), "id", F.lit("/")))

    @once
    def publications(self) -> DataFrame:
        c = F.col
        targets = F.array(F.struct(F.lit("primary").alias("id"), F.lit(True).alias("required"), F.lit(0).alias("n")),
                          F.struct(F.lit("secondary").alias("id"), F.lit(False).alias("required"), F.lit(3).alias("n")))
        revisions = self.revisions().withColumn("t", F.explode(targets)).filter("t.n = 0 or _dom % 6 <> 0")
        number = ((c("compaction_id") + c("t.n")) % len(STATUSES)).cast("int")
        status = F.element_at(F.array(*[F.lit(s) for s in STATUSES]), number + 1)
        minutes = (c("compaction_id") % 100) * 60
        return revisions.select(
            (c("compaction_id") * 2 + F.when(c("t.n") > 0, 1).otherwise(0)).alias("publication_id"),
            "compaction_id", c("t.id").alias("destination_id"), c("t.required").alias("required"),
            status.alias("status"), (c("compaction_id") % 9).cast("int").alias("attempt_count"),
            F.timestamp_seconds(F.unix_seconds(c("_d").cast("timestamp")) + 86400 + minutes).alias("next_attempt_at"),
            F.lit("").alias("last_error"), F.lit("").alias("remote_path"),
            F.lit(None).cast("timestamp").alias("completed_at"),
        )

    @once
    def summaries(self) -> DataFrame:
        return self._dayed(self.ticks().select(*DAY).distinct()).filter("_dom <= 2").select(*DAY)

    @once
    def manifests(self) -> DataFrame:
        """Documents found on disk: those of the ledger, and some it has never seen."""
        known = self.compactions().select(*REVISION, F.col("rows").alias("captured_responses"),
                                          F.col("entities").alias("entity_total"))
        unseen = known.filter(F.dayofmonth(F.to_date("archive_date")) % 7 == 0) \
            .withColumn("revision", F.col("revision") + 2)
        kinds = self.streams().select("source_id", "stream_id", "expected_kind", "url")
        source = F.col("source_id")
        return known.unionByName(unseen).join(kinds, ["source_id", "stream_id"]).withColumns({
            "sanitized_url": F.when(source == "s3", "").otherwise(sanitize_url(F.col("url"))),
            "expected_kind": F.when((source == "s2") & (F.col("stream_id") == "error"), "unknown")
            .otherwise(F.col("expected_kind")),
        }).drop("url")

    @once
    def manifest_inputs(self) -> DataFrame:
        event = F.col("event_id")
        return self.inputs_wide().select(
            *REVISION,
            F.when(event % 89 == 0, F.concat(F.lit("x"), F.col("capture_id"))).otherwise(F.col("capture_id")).alias("id"),
            F.when(event % 97 == 0, F.lit("0" * 64)).otherwise(F.col("body_sha256")).alias("sha256"),
            F.col("decoded_length").alias("bytes"),
        )

    # --- pages as bodies -----------------------------------------------------
    @once
    def landing(self) -> DataFrame:
        """Each page is a body with its capture document; most are no protobuf at all."""
        page, c = F.col("page_id"), F.col
        source = F.concat(F.lit("s"), (page % 4).cast("string"))
        rows = self.table("pages").select(
            F.lit(1).alias("format_version"),
            F.concat(F.lit("p"), F.lpad(page.cast("string"), 12, "0")).alias("capture_id"),
            F.concat(F.lit("t"), F.lpad(page.cast("string"), 12, "0")).alias("tick_id"),
            source.alias("source_id"), F.lit("pages").alias("stream_id"), F.lit("mixed").alias("expected_kind"),
            F.timestamp_seconds(F.lit(1704067200) + page * 600).alias("scheduled_at"),
            pick(source, ZONE_OF).alias("timezone"), sanitize_url(c("url")).alias("sanitized_url"),
            c("html").cast("binary").alias("body"), page.alias("page_id"),
        )
        stem = capture_stem(c("source_id"), c("stream_id"), c("scheduled_at"), c("timezone"), c("capture_id"),
                            c("body_sha256"))
        size = F.octet_length("body").cast("bigint")
        return rows.withColumn("body_sha256", B.body_sha256(c("body"))).withColumns({
            "started_at": c("scheduled_at"), "completed_at": F.timestamp_seconds(F.unix_seconds("scheduled_at") + 2),
            "archive_date": local_date_text(c("scheduled_at"), c("timezone")),
            "http_status": F.lit(200), "response_headers": F.create_map(F.lit("Content-Type"), F.lit("text/html")),
            "duration_ms": c("page_id") % 700, "attempt_count": F.lit(1), "advertised_length": size,
            "encoded_length": size, "decoded_length": size, "content_encoding": F.lit(""),
            "raw_path": F.concat(stem, F.lit(".pb")), "sidecar_path": F.concat(stem, F.lit(".json")),
            "transport_complete": F.lit(True), "parse_status": F.lit("protobuf_decode"),
            "parse_error": F.lit("DecodeError"), "feed_version": F.lit(""),
            "incrementality": F.lit(None).cast("int"), "feed_timestamp": F.lit(None).cast("decimal(20,0)"),
            "entity_count": F.lit(None).cast("int"), "validation_flags": F.array().cast("array<string>"),
            "config_fingerprint": F.lit("f"), "application_version": F.lit("1.0"), "protobuf_revision": F.lit("r1"),
        })
