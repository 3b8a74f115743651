import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests import lake
from tests.feeds import body, feed
from transitlake.operators import ledger as L
from transitlake.operators import statistics as S
from transitlake.plans import publish, retention
from transitlake.plans.manifest import daily_summaries
from transitlake.schemas import AUDIT, COMPACTION, PUBLICATION, TICK
from transitlake.sources.ledger import Ledger

T0 = dt.datetime(2026, 8, 1)


def at(text):
    return F.lit(text).cast("timestamp")


def tick(i, result="captured", category="", at=T0):
    return (f"t{i}", "demo", "trips", at, at, at, result, "", category, "", 0, 1, "f")


def compaction(i, date="2026-08-01", revision=1, published=None, path="m"):
    return (i, "demo", "trips", date, 1, revision, "ready", "d", "d/x", path, "h", 10, 1, 1, ["a"], T0, published)


def publication(i, c, dest="a", required=True, status="pending", due=T0):
    return (i, c, dest, required, status, 0, due, "", "", None)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_day_stats_keep_every_category(spark):
    ticks = frame(spark, TICK, tick(1, "failed", "http_status"), tick(2, "failed", "body_too_large"),
                  tick(3, "failed", "timeout")).withColumn("archive_date", F.lit("2026-08-01"))
    row = S.tick_facts(ticks).first()
    assert (row["scheduled_ticks"], row["http_failures"], row["network_failures"]) == (3, 1, 1)
    assert row["failure_category_counts"] == {"http_status": 1, "body_too_large": 1, "timeout": 1}
    assert S.day_stats(ticks).first()["http_failures"] == 1


def test_feed_timestamp_round_trips_through_the_ledger(spark, tmp_path):
    captures = lake.captures_with_bodies(spark, [body(feed(timestamp=2**64 - 1))])
    ledger = Ledger(spark, str(tmp_path)).create()
    ledger.append("captures", captures, 1)
    assert ledger.current("captures").first()["feed_timestamp"] == Decimal(2**64 - 1)
    ledger.append("captures", captures, 2, removed=True)
    assert ledger.current("captures").count() == 0
    assert not L.capture_exists(ledger.current("captures"), "demo-trips-1")


def test_tick_upsert_keeps_identity(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path)).create()
    ledger.append("ticks", frame(spark, TICK, tick(1, "running")), 1)
    later = tick(1, "captured", at=dt.datetime(2027, 1, 1))
    ledger.append("ticks", frame(spark, TICK, later), 2)
    row = ledger.current("ticks").first()
    assert row["result"] == "captured" and row["scheduled_at"] == T0 and row["started_at"] == dt.datetime(2027, 1, 1)


def test_scan_day_is_ordered(spark):
    captures = lake.captures_with_bodies(spark, [body(feed())] * 5).repartition(3)
    rows = L.scan_day(captures, "demo", "trips", "2026-08-12").collect()
    assert [r["capture_id"] for r in rows] == [f"demo-trips-{i}" for i in range(1, 6)]


def test_jobs_and_queue_are_ordered(spark):
    jobs = frame(spark, COMPACTION, compaction(1, "2026-08-02"), compaction(2, "2026-08-01"))
    assert [r["compaction_id"] for r in L.jobs_in_order(jobs).collect()] == [2, 1]
    later = T0 + dt.timedelta(minutes=1)
    queue = frame(spark, PUBLICATION, publication(1, 1, due=later), publication(2, 1), publication(3, 1, status="verified"),
                  publication(4, 1, due=dt.datetime(2030, 1, 1)))
    assert [r["publication_id"] for r in L.publication_queue(queue, at("2026-08-02")).collect()] == [2, 1]
    assert L.publication_queue(queue, at("2026-08-02"), "b").count() == 0


def test_backfill_is_optional_and_retirement_releases(spark):
    compactions = frame(spark, COMPACTION, compaction(1), compaction(2, path=""))
    queue = frame(spark, PUBLICATION, publication(1, 1, "a"))
    added = publish.backfill(compactions, queue, "b", at("2026-08-02"))
    assert [(r["compaction_id"], r["required"]) for r in added.collect()] == [(1, False)]
    everything = queue.unionByName(added)
    retired = publish.apply_changes(everything, publish.retire_publications(everything, "a", "gone", at("2026-08-03")), "publication_id")
    released = publish.release_retired(compactions, retired, "a", at("2026-08-03")).collect()
    assert [(r["compaction_id"], r["status"], r["published_at"]) for r in released] == [(1, "published", dt.datetime(2026, 8, 3))]
    moment = spark.range(1).select(at("2026-08-03").alias("created_at"))
    audit = publish.retirement_audit(moment, "a", "gone")
    assert audit.columns == AUDIT.names and audit.first()["action"] == "retire_destination"


def test_another_required_destination_holds_the_release(spark):
    compactions = frame(spark, COMPACTION, compaction(1))
    queue = frame(spark, PUBLICATION, publication(1, 1, "a"), publication(2, 1, "b"))
    retired = publish.apply_changes(queue, publish.retire_publications(queue, "a", "gone", at("2026-08-03")), "publication_id")
    assert publish.release_retired(compactions, retired, "a", at("2026-08-03")).count() == 0
    assert publish.gate(retired).first()["released"] is False


def test_optional_verification_stamps_again(spark):
    compactions = frame(spark, COMPACTION, compaction(1, published=T0))
    queue = frame(spark, PUBLICATION, publication(1, 1, "a", status="verified"), publication(2, 1, "b", False, "verified"))
    released = publish.release(compactions, queue, queue.filter("publication_id = 2"), at("2026-08-09")).first()
    assert released["published_at"] == dt.datetime(2026, 8, 9)


def test_retention_end_to_end(spark):
    captures = lake.captures_with_bodies(spark, [body(feed())])
    day = captures.first()["archive_date"]
    compactions = frame(spark, COMPACTION, compaction(1, day, published=dt.datetime(2026, 8, 12)))
    inputs = captures.select(F.lit(1).cast("bigint").alias("compaction_id"), "capture_id")
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    none = compactions.select(*S.DAY).filter("false")
    required, optional = lake.destinations(spark, ("a", True, "x")), lake.destinations(spark, ("a", False, "x"))
    week = retention.RetentionPolicy(metadata_s=7 * 86400)
    now = at("2026-08-20")

    def report(captures, destinations, now, policy=week):
        return retention.retention_report(captures, inputs, compactions, none, streams, destinations, now, policy).first().asDict()

    found = report(captures, required, now)
    assert (found["raw_captures"], found["datasets"], found["summarized_days"]) == (1, 1, 1) and found["raw_bytes"] > 0
    early = report(captures, required, at("2026-08-18"))
    assert (early["raw_captures"], early["datasets"], early["summarized_days"]) == (0, 0, 0)
    assert report(captures, optional, now)["raw_captures"] == 0
    allowed = retention.RetentionPolicy(metadata_s=7 * 86400, local_only_cleanup=True)
    assert report(captures, optional, now, allowed)["raw_captures"] == 1
    limit = retention.cutoff(now, week.raw_s)
    raw = retention.raw_candidates(captures, inputs, compactions, limit)
    assert retention.files_to_remove(raw, retention.dataset_candidates(compactions, limit)).count() == 4
    gone = retention.mark_captures_retained(raw)
    assert gone.first()["raw_path"] == "@retained/demo-trips-1.pb" and L.live_captures(gone).count() == 0
    days = retention.summary_candidates(compactions, none, gone, streams, limit)
    summary = daily_summaries(gone, lake.ticks(gone), days, now).first()
    assert (summary["scheduled_ticks"], summary["captured_responses"], summary["valid_snapshots"]) == (1, 1, 1)
    assert summary["parse_status_counts"] == {"valid": 1} and retention.drop_days(gone, days).count() == 0


def test_unpublished_revision_keeps_everything(spark):
    captures = lake.captures_with_bodies(spark, [body(feed())])
    day = captures.first()["archive_date"]
    compactions = frame(spark, COMPACTION, compaction(1, day, published=T0), compaction(2, day, revision=2))
    inputs = captures.select("capture_id").withColumn("compaction_id", F.explode(F.array(F.lit(1), F.lit(2))))
    assert retention.raw_candidates(captures, inputs, compactions, at("2030-01-01")).count() == 0
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    none = compactions.select(*S.DAY).filter("false")
    assert retention.summary_candidates(compactions, none, captures.filter("false"), streams, at("2030-01-01")).count() == 0


def test_attempts_and_categories(spark):
    work = frame(spark, PUBLICATION, *[publication(i, i) for i in range(4)]).withColumns({
        "error_category": F.when(F.col("publication_id") == 3, "stream_not_configured"),
        "remote_path": F.when(F.col("publication_id") != 3, "x")})
    outcomes = spark.createDataFrame([(0, None), (1, "remote_integrity"), (2, "timeout")], "publication_id bigint, failed_with string")
    rows = publish.attempt_outcomes(work, outcomes, at("2026-08-01"), F.lit(1.0)).orderBy("publication_id").collect()
    assert [r["status"] for r in rows] == ["verified", "permanent_failure", "retry", "retry"]
    assert [r["attempt_count"] for r in rows] == [1, 1, 1, 0]
    assert rows[1]["next_attempt_at"].year == 2126 and rows[2]["next_attempt_at"] == dt.datetime(2026, 8, 1, 0, 5)
