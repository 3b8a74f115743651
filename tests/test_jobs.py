"""Jobs over one ledger, from landing files to retention."""

import datetime as dt

from pyspark.sql import functions as F

from tests import lake
from tests.test_compaction import flattened_bodies
from transitlake.plans import compact, jobs, retention
from transitlake.schemas import CAPTURE
from transitlake.sources import bodies as B
from transitlake.sources import revisions as R
from transitlake.sources.ledger import Ledger
from transitlake.streaming import registration
from workload.landing_files import write_landing


def at(text):
    return F.lit(text).cast("timestamp")


def test_from_landing_to_retention(spark, tmp_path):
    root = str(tmp_path)
    ledger = Ledger(spark, root).create()
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    target = lake.destinations(spark, ("primary", True, f"file://{root}/out"), ("spare", True, ""))
    write_landing(lake.captures_with_bodies(spark, flattened_bodies()), root)
    found = jobs.reconcile_lake(ledger, root, at("2026-08-20"), 1).first()
    assert (found["captures_registered"], found["revisions_adopted"], found["corrupt"]) == (3, 0, 0)

    result = jobs.compact_due(ledger, root, B.scan_bodies(spark, root), streams, target, at("2026-08-20"), 2)
    assert result.violations.count() == 0
    row = ledger.current("compactions").first()
    assert (row["revision"], row["rows"], row["status"]) == (1, 3, "ready") and len(row["data_sha256"]) == 64
    assert ledger.current("compaction_inputs").count() == 3 and ledger.current("publications").count() == 2
    again = jobs.compact_due(ledger, root, B.scan_bodies(spark, root), streams, target, at("2026-08-20"), 3)
    assert again.manifests.count() == 0 and ledger.current("compactions").count() == 1

    only = target.filter("id = 'primary'")
    jobs.publish_round(ledger, root, streams, only, at("2026-08-21"), F.lit(0.5), 4)
    states = {r["destination_id"]: r["status"] for r in ledger.current("publications").collect()}
    assert states["primary"] == "verified" and ledger.current("compactions").first()["published_at"] is None
    jobs.retire_destination(ledger, "spare", "closed", at("2026-08-22"), 5)
    assert ledger.current("compactions").first()["published_at"] == dt.datetime(2026, 8, 22)
    assert [(r["action"], r["target"], r["reason"]) for r in ledger.current("audit").collect()] == [
        ("retire_destination", "spare", "closed")]

    day = retention.RetentionPolicy(raw_s=86400, parquet_s=86400, metadata_s=86400)
    assert jobs.clean_up(ledger, streams, only, at("2026-08-22"), 6, day).count() == 0
    paths = jobs.clean_up(ledger, streams, only, at("2026-08-24"), 8, day)
    assert paths.count() == 8
    summary = ledger.current("daily_summaries").first()
    assert (summary["captured_responses"], summary["scheduled_ticks"]) == (3, 3)
    for table in ("captures", "ticks", "compaction_inputs"):
        assert ledger.current(table).count() == 0, table
    audit = {r["action"]: r["target"] for r in ledger.current("audit").collect()}
    assert audit["retention_cleanup"].startswith("captures=3 datasets=1 days=1 ")


def test_a_late_capture_is_written_and_a_refused_day_stays_due(spark, tmp_path):
    root = str(tmp_path)
    ledger = Ledger(spark, root).create()
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    target = lake.destinations(spark, ("primary", True, f"file://{root}/out"))
    both = R.materialize(lake.captures_with_bodies(spark, flattened_bodies()), root, "bronze")
    first, late = both.filter("capture_id <> 'demo-trips-1'"), both.filter("capture_id = 'demo-trips-1'")

    def write(days):
        captures = ledger.current("captures")
        return compact.compact_days(spark, root, captures, lake.ticks(captures), both, streams, days, target, at("2026-08-20"))

    handle = registration.revise_late_days(ledger, at("2026-08-20"), write, target)
    handle(first.select(*CAPTURE.names), 1)
    handle(late.select(*CAPTURE.names), 2)
    rows = ledger.current("compactions").orderBy("revision").collect()
    assert [(r["revision"], r["rows"]) for r in rows] == [(1, 2), (2, 3)] and all(r["data_path"] for r in rows)
    assert R.read_revisions(spark, root, flattened=True).filter("revision = 2").count() == 4
    assert ledger.current("publications").count() == 2
    changed = late.withColumns({"capture_id": F.lit("demo-trips-9"), "sanitized_url": F.lit("https://example.test/other")})
    handle(changed.select(*CAPTURE.names), 3)
    assert ledger.current("compactions").count() == 2 and ledger.current("captures").count() == 4
