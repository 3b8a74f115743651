"""What the tasks of a compaction are given: bodies in file order, and a bounded share of what is decoded."""

from pyspark.sql import functions as F

from tests import lake
from tests.feeds import body, feed
from transitlake.operators.ledger import REVISION
from transitlake.plans import compact
from transitlake.session import split_bytes
from transitlake.sources import revisions as R

SPLIT = "spark.sql.files.maxPartitionBytes"


def test_decoded_captures_lie_in_file_order(spark):
    captures = lake.captures_with_bodies(spark, [body(feed(timestamp=n)) for n in range(1, 40)])
    mixed = captures.orderBy(F.xxhash64("capture_id"))
    days = lake.days(spark, ("demo", "trips", "2026-08-12", 1))
    decoded = compact.decoded_captures(mixed.drop("body"), mixed.select("raw_path", "body"), days)
    part, found = F.spark_partition_id().alias("part"), {}
    for row in decoded.select(part, *REVISION, "scheduled_at", "capture_id").collect():
        found.setdefault(row["part"], []).append(tuple(row)[1:])
    assert sum(map(len, found.values())) == 39
    assert all(rows == sorted(rows) for rows in found.values())


def test_a_task_reads_about_a_part(spark, tmp_path):
    rows = spark.range(0, 3_000_000, 1, 6).select(F.xxhash64("id").alias("v"))
    stored = R.materialize(rows, str(tmp_path), "rows")  # six parts of some 4 MB
    before, again = spark.conf.get(SPLIT), lambda: spark.read.schema(stored.schema).parquet(*stored.inputFiles())
    with split_bytes(spark, 1 << 20):
        few = again().select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(few) == 6 and spark.conf.get(SPLIT) == before
    try:
        with split_bytes(spark, 1 << 20):
            raise KeyError
    except KeyError:
        assert spark.conf.get(SPLIT) == before


def test_a_compaction_flattens_and_places_by_small_splits(spark, tmp_path, monkeypatch):
    seen = {}
    for name in ("write_flattened", "place_captures"):
        def run(*args, _old=getattr(R, name), _name=name, **kwargs):
            seen[_name] = spark.conf.get(SPLIT)
            return _old(*args, **kwargs)
        monkeypatch.setattr(R, name, run)
    wide = R.materialize(lake.captures_with_bodies(spark, [body(feed(timestamp=n)) for n in range(1, 5)]), str(tmp_path), "wide")
    captures = wide.drop("body")
    before = spark.conf.get(SPLIT)
    result = compact.compact_days(
        spark, str(tmp_path), captures, lake.ticks(captures), wide.select("raw_path", "body"),
        lake.streams(spark, ("demo", "trips", "trip_update", "UTC")), lake.days(spark, ("demo", "trips", "2026-08-12", 1)),
        lake.destinations(spark, ("a", True, "x/")), F.lit("2026-08-14").cast("timestamp"))
    assert result.manifests.count() == 1 and result.violations.count() == 0
    assert seen == {"write_flattened": str(compact.DECODED_SPLIT), "place_captures": str(compact.DECODED_SPLIT)}
    assert spark.conf.get(SPLIT) == before
