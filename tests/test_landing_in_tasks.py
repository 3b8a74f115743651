"""Whole scans of the landing area whose files are listed and opened by tasks, against Spark's own scans."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from tests import lake
from tests.feeds import MALFORMED, body, feed
from transitlake.functions.bodies import body_sha256
from transitlake.plans import reconcile
from transitlake.sources import bodies as B
from transitlake.sources.ledger import Ledger
from workload.catalog import QUERIES
from workload.landing_files import write_landing

WHOLE = {"scan_bodies": ["scan_bodies"], "classify_files": ["list_bodies", "scan_sidecars"], "retention_deleted": ["list_bodies", "scan_sidecars"]}


def rows(frame):
    return sorted(map(repr, frame.collect()))


def test_the_same_rows_and_no_file_known_to_the_driver(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed()), MALFORMED, b"", body(feed(timestamp=7))])
    odd = lake.captures_with_bodies(spark, [body(feed())], stream="a b%3Ac+d")
    write_landing(captures.unionByName(odd), root)
    documents = [r["sidecar_path"] for r in captures.orderBy("capture_id").collect()]
    text = (tmp_path / documents[1]).read_text()
    (tmp_path / documents[0]).write_text("{ not json")
    (tmp_path / documents[1]).write_text(f"[{text}, {text}]")
    (tmp_path / "raw" / "astray.json").write_text(text)
    (tmp_path / "raw" / "_hidden.json").write_text(text)
    for scan in (B.scan_bodies, B.scan_sidecars):
        told, found = scan(spark, root), scan(spark, root, in_tasks=True)
        if scan is B.scan_sidecars:  # Spark's scan escapes odd names in the path, where they were found as written
            strange = F.col("stream_id").like("a b%")
            assert found.filter(strange).filter("found_path = sidecar_path").count() == told.filter(strange).count() == 1
            told, found = (t.filter(F.coalesce(~strange, F.lit(True))) for t in (told, found))
        assert rows(found.select(*told.columns)) == rows(told) and found.columns == told.columns and told.count() > 3
        assert found.inputFiles() == [] != told.inputFiles()
    assert rows(B.list_bodies(spark, root, in_tasks=True)) == rows(B.list_bodies(spark, root).select("raw_path"))
    with pytest.raises(PythonException):
        B.scan_bodies(spark, f"{root}/nowhere", in_tasks=True).count()


def test_a_listing_beyond_the_threshold_is_not_broadcast(spark, tmp_path):
    root, key = str(tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    write_landing(lake.captures_with_bodies(spark, [body(feed(timestamp=n + 1)) for n in range(30)]), root)
    known = Ledger(spark, root).create().current("captures")

    def checked(in_tasks):
        hashed = B.scan_bodies(spark, root, in_tasks=in_tasks).withColumn("found_sha256", body_sha256(F.col("body"))).drop("body")
        return reconcile.check_sidecars(B.scan_sidecars(spark, root, in_tasks=in_tasks), hashed, known).select("capture_id", "status")

    before = spark.conf.get(key)
    spark.conf.set(key, "1k")  # thirty paths with their hashes take more
    try:
        found = checked(True)
        assert rows(found) == rows(checked(False)) and found.filter("status = 'new'").count() == 30
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "SortMergeJoin [_body_path" in plan and "BroadcastHashJoin [_body_path" not in plan


def test_queries_over_the_whole_area_open_no_file_on_the_driver(spark, monkeypatch):
    """Their scans are those of tasks: the plans name no file."""
    found = {}
    for name in ("scan_bodies", "scan_sidecars", "list_bodies"):
        scan = getattr(B, name)
        monkeypatch.setattr(B, name, lambda *args, name=name, scan=scan, **kw: found.setdefault(name, scan(*args, **kw)))
    for query, scans in WHOLE.items():
        found.clear()
        assert QUERIES[query](spark, "/root/testdata/sf0.001").count() > 0
        assert set(scans) <= set(found) and all(frame.inputFiles() == [] for frame in found.values())
