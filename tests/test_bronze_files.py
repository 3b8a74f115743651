"""What a batch of arriving bodies costs beside the bodies: its files, its listing and its log."""

from tests import lake
from tests.feeds import body, feed
from transitlake import session
from transitlake.sources import bodies as B
from transitlake.streaming import landing
from workload.landing_files import write_landing


def test_a_day_of_one_batch_is_one_file(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed(timestamp=n)) for n in range(1, 25)])
    other = lake.captures_with_bodies(spark, [body(feed())] * 3, stream="others")
    write_landing(captures.unionByName(other), root)
    landing.start_bronze(B.stream_bodies(spark, root, max_files=100), f"{root}/bronze", f"{root}/cp").awaitTermination()
    for stream, rows in (("trips", 24), ("others", 3)):
        kept = spark.read.parquet(f"{root}/bronze").filter(f"stream = '{stream}'")
        assert kept.count() == rows == kept.select("raw_path").distinct().count()
        assert len(list(tmp_path.glob(f"bronze/source=demo/stream={stream}/date=*/*.parquet"))) == 1


def test_listing_takes_no_more_tasks_than_there_is_room_for(spark):
    conf = session.configure(spark).conf
    assert conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == str(2 * spark.sparkContext.defaultParallelism)
    assert conf.get("spark.sql.streaming.fileSource.log.compactInterval") == "100"
