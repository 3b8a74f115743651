from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import lake
from tests.feeds import MALFORMED, body, feed
from transitlake.functions.bodies import body_sha256
from transitlake.operators import statistics as S
from transitlake.operators.decode import decode_bodies
from transitlake.operators.flatten import flatten_trip_updates
from transitlake.plans import reconcile
from transitlake.schemas import TRIP_UPDATE_MESSAGE
from transitlake.sources import bodies as B
from workload import feeds
from workload.bindings import Bindings
from workload.landing_files import write_landing

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def landed(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed()), MALFORMED, b""])
    write_landing(captures, root)
    return root, captures


def hashed(bodies):
    return bodies.withColumn("found_sha256", body_sha256(F.col("body"))).drop("body")


def test_sidecars_round_trip(spark, landed):
    root, captures = landed
    found = B.scan_sidecars(spark, root)
    assert found.filter("corrupt").count() == 0
    columns = [c for c in captures.columns if c not in ("body", "response_headers", "validation_flags")]
    assert found.select(*columns).exceptAll(captures.select(*columns)).count() == 0
    assert found.first()["response_headers"] == {"Content-Type": "application/x-protobuf"}


def test_unknown_captures_are_registered(spark, landed):
    root, captures = landed
    known = captures.filter("capture_id = 'demo-trips-1'")
    checked = reconcile.check_sidecars(B.scan_sidecars(spark, root), hashed(B.scan_bodies(spark, root)), known)
    assert Counter(r["status"] for r in checked.collect()) == {"new": 2, "known": 1}
    ticks = reconcile.ticks_of(reconcile.new_captures(checked)).collect()
    # whatever its parse status, a capture found on disk was captured
    assert {t["result"] for t in ticks} == {"captured"} and len(ticks) == 2


def test_recorded_capture_without_files_is_corrupt(spark, landed):
    root, captures = landed
    ghost = captures.limit(1).withColumns({"capture_id": F.lit("ghost"), "raw_path": F.lit("raw/source=x/g.pb")})
    retained = captures.limit(1).withColumns({"capture_id": F.lit("kept"), "raw_path": F.lit("@retained/kept.pb")})
    ledger = captures.unionByName(ghost).unionByName(retained)
    files = reconcile.classify_files(B.list_bodies(spark, root), B.scan_sidecars(spark, root), ledger)
    assert Counter(r["status"] for r in files.collect()) == {"present": 3, "missing": 1}
    checked = reconcile.check_sidecars(B.scan_sidecars(spark, root), hashed(B.scan_bodies(spark, root)), ledger)
    none = spark.createDataFrame([], "source_id string, stream_id string, archive_date string, revision int")
    row = reconcile.reconcile_counters(checked, files, none, none).first()
    assert (row["captures_registered"], row["revisions_adopted"], row["corrupt"]) == (0, 0, 1)


def test_broken_documents_are_rows(spark, landed, tmp_path):
    root, captures = landed
    path = captures.first()["sidecar_path"]
    (tmp_path / path).write_text("{ not json")
    checked = reconcile.check_sidecars(B.scan_sidecars(spark, root), hashed(B.scan_bodies(spark, root)), captures)
    assert Counter(r["status"] for r in checked.collect()) == {"known": 2, "corrupt_document": 1}


def test_partition_filter_prunes_bodies(spark, landed):
    root, _ = landed
    day = B.scan_bodies(spark, root).filter("source = 'demo' and hour = '12'")
    assert day.count() == 2 and B.empty_bodies(B.scan_sidecars(spark, root)).count() == 1 and B.scan_bodies(spark, root).filter("hour = '13'").count() == 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def flattened(b):
    captured = feeds.feed_captures(b).withColumns({
        "parse_status": F.lit("valid"), "validation_flags": F.array().cast("array<string>")})
    rows = flatten_trip_updates(decode_bodies(captured, wanted=TRIP_UPDATE_MESSAGE, keep_body=False))
    return captured, rows.select("trip_id", "stop_sequence", "stop_id", "arrival_delay")


def test_blocks_of_line_numbers_lose_no_rows(spark, monkeypatch):
    """With small blocks every feed has several bodies; the rows must be those of the plain join."""
    b = Bindings(spark, SMALL)
    whole, wanted = flattened(b)
    bodies = whole.count()
    monkeypatch.setattr(feeds, "LINE_BLOCK", 2)
    split, found = flattened(Bindings(spark, SMALL))
    assert split.count() > 3 * bodies
    # an order is cut at a body's end, so only its base rows could differ: none may
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


def test_gap_over_slices_equals_one_window(spark):
    from pyspark.sql import Window

    captures = Bindings(spark, SMALL).captures()
    w = Window.partitionBy(*S.DAY).orderBy("scheduled_at", "capture_id")
    gap = ((F.unix_micros("completed_at") - F.unix_micros(F.lag("completed_at").over(w))) / 1000).cast("bigint")
    plain = captures.withColumn("g", gap).groupBy(*S.DAY).agg(
        F.greatest(F.max("g"), F.lit(0)).cast("bigint").alias("largest_fetch_gap_ms"))
    sliced = S.largest_fetch_gap(captures)
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == plain.count()
