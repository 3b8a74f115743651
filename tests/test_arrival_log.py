"""The log of arrivals: every file noted once, by tasks, and streams whose driver knows parts of the log alone."""

import time

import pytest

from tests import lake
from tests.feeds import body, feed
from transitlake.sources import arrivals
from transitlake.sources import bodies as B
from transitlake.sources.arrivals import ArrivalLog
from transitlake.streaming import landing
from workload.landing_files import write_landing


def land(spark, root, count, stream="trips"):
    write_landing(lake.captures_with_bodies(spark, [body(feed(timestamp=n + 1)) for n in range(count)], stream=stream), root)


def noted(log):
    return sorted(r["path"] for r in log.noted().collect())


def test_a_stream_keeps_no_name_of_a_file(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 60)
    bodies = B.stream_bodies(spark, root, max_files=100)
    landing.start_bronze(bodies, f"{root}/bronze", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").select("raw_path").distinct().count() == 60
    kept = [line for p in tmp_path.glob("cp/sources/*/[!.]*") for line in p.read_text().splitlines() if "path" in line]
    assert 1 <= len(kept) <= 4 and not any(".pb" in line for line in kept)
    assert [len(p.read_text().splitlines()) for p in sorted(tmp_path.glob("arrivals/pb/names/*/[!.]*.json"))] in ([50, 10], [10, 50])
    assert spark.conf.get("spark.sql.streaming.checkpointFileManagerClass").endswith("FileSystemBasedCheckpointFileManager")


def test_rounds_of_listing(spark, tmp_path):
    """Nothing twice: not by a later round, nor by one that was left before its parts were moved, nor by two at the same time."""
    root = str(tmp_path)
    land(spark, root, 3)
    log = ArrivalLog(spark, root, ".pb")
    log.note()
    log.note()
    assert len(noted(log)) == 3 and len(list(tmp_path.glob("arrivals/pb/_rounds/[0-9]*"))) == 1
    land(spark, root, 2, "more")
    settle = log._settle

    def overtaken():
        log._settle = settle
        last = settle()
        ArrivalLog(spark, root, ".pb").note()
        return last

    log._settle = overtaken
    log.note()
    assert len(noted(log)) == 5 == len(set(noted(log)))
    for place in tmp_path.glob("arrivals/pb/names/round=*2"):
        attempt = (tmp_path / "arrivals/pb/_rounds" / place.name.split("=")[1]).read_text()
        place.rename(tmp_path / "arrivals/pb/_written" / attempt)
    assert len(noted(log)) == 3
    log.note()
    assert len(noted(log)) == 5 == len(set(noted(log)))
    with pytest.raises(ValueError):
        log.stream(max_files=7)


def test_a_file_deleted_since_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, 3)
    ArrivalLog(spark, root, ".pb").note()
    next(tmp_path.glob("raw/**/*.pb")).unlink()
    landing.start_bronze(B.stream_bodies(spark, root), f"{root}/bronze", f"{root}/cp").awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 2


def test_a_stream_that_goes_on_sees_later_files(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(arrivals, "LOOK_S", 1.0)
    monkeypatch.setattr(arrivals, "_FOLLOWED", {})
    land(spark, root, 2)
    query = B.stream_bodies(spark, root).writeStream.format("parquet").option("path", f"{root}/out") \
        .option("checkpointLocation", f"{root}/cp").trigger(processingTime="200 milliseconds").start()
    query.processAllAvailable()
    land(spark, root, 2, "more")
    until = time.monotonic() + 60
    while spark.read.parquet(f"{root}/out").count() < 4 and time.monotonic() < until:
        time.sleep(1)
    query.stop()
    assert spark.read.parquet(f"{root}/out").select("raw_path").distinct().count() == 4 == spark.read.parquet(f"{root}/out").count()
