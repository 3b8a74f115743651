"""Days that are due, by digests of captures, against the lists of inputs themselves."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests import lake
from tests.feeds import body, feed
from transitlake.operators import ledger as L
from transitlake.operators.statistics import DAY
from transitlake.plans import backlog, jobs
from transitlake.plans.journal import Job
from transitlake.sources.ledger import Ledger

def now():
    return F.lit("2026-08-20").cast("timestamp")


CAPTURES = "source_id string, stream_id string, archive_date string, capture_id string"
REVISIONS = "compaction_id bigint, source_id string, stream_id string, archive_date string, revision int, rows bigint"


def fixture(spark, revised):
    """Ten days of one stream with four captures each; ``revised`` makes a day's input lists from its captures."""
    ids = {d: [f"{d}-{k}" for k in range(4)] for d in range(1, 11)}
    captures = [("demo", "trips", f"2026-08-{d:02d}", i) for d, own in ids.items() for i in own]
    revisions, inputs = [], []
    for d, own in ids.items():
        for number, listed in enumerate(revised(d, own), 1):
            revisions.append((100 * d + number, "demo", "trips", f"2026-08-{d:02d}", number, len(own)))
            inputs += [(100 * d + number, i) for i in listed]
    ticks = [("demo", "trips", f"2026-08-{d:02d}", dt.datetime(2026, 8, d, 12)) for d in ids if d != 10]
    return (spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(revisions, REVISIONS),
            spark.createDataFrame(inputs, "compaction_id bigint, capture_id string"),
            spark.createDataFrame(ticks, "source_id string, stream_id string, archive_date string, scheduled_at timestamp"))


def revised(d, own):
    if d == 1:
        return []
    if d == 2:
        return [own]
    if d == 3:
        return [own[:3]]
    if d == 4:
        return [own[:3], own]  # the latest one counts
    if d == 5:
        return [own, own[:2]]
    if d == 6:
        return [[*own[:3], "another"]]  # one exchanged for another: the number is right
    if d == 7:
        return [random.Random(d).sample(own, 4)]  # the order does not matter
    return [own] if d != 8 else [[]]


def test_digests_find_the_same_days(spark):
    captures, revisions, inputs, ticks = fixture(spark, revised)
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    summaries = spark.createDataFrame([("demo", "trips", "2026-08-09")], "source_id string, stream_id string, archive_date string")
    by_list = backlog.days_to_compact(streams, ticks, captures, revisions, inputs, summaries, now())
    digests = L.revision_digests(revisions, inputs)
    by_digest = backlog.days_due(streams, ticks, captures, digests, summaries, now())
    found = sorted(map(tuple, by_digest.collect()))
    assert found == sorted(map(tuple, by_list.collect()))
    assert [(r[2][-2:], r[3]) for r in found] == [("01", 1), ("03", 2), ("05", 3), ("06", 2), ("08", 2)]


def test_repeats_and_many_rows_do_not_overflow(spark):
    digest = lambda df: df.agg(L.captures_digest(F.col("id").cast("string"))).first()[0]
    rows = spark.range(200_000)
    assert digest(rows) == digest(rows.repartition(7)) and digest(rows).startswith("200000:")
    assert digest(rows.limit(0)) == L.NO_CAPTURES != digest(rows.limit(1))
    # one capture twice in place of another: xor and sum tell what the count does not
    assert digest(rows.filter("id < 3")) != digest(rows.filter("id < 2").unionByName(rows.filter("id = 1")))


def test_the_job_reads_no_list_of_inputs(spark, tmp_path):
    """Revisions recorded before there were digests get them once, from their inputs."""
    root = str(tmp_path)
    ledger = Ledger(spark, root).create()
    captures = lake.captures_with_bodies(spark, [body(feed())] * 3).drop("body")
    ledger.append("captures", captures, 1)
    ledger.append("ticks", lake.ticks(captures).drop("archive_date"), 1)
    day = captures.select(*DAY).distinct().withColumns({"revision": F.lit(1), "compaction_id": F.lit(7).cast("bigint")})
    missing = {f.name: F.lit(None).cast(f.dataType) for f in ledger.current("compactions").schema.fields if f.name not in day.columns}
    ledger.append("compactions", day.withColumns(missing), 1)
    ledger.append("compaction_inputs", captures.select(F.lit(7).cast("bigint").alias("compaction_id"), "capture_id"), 1)
    job = Job(ledger, "compact_due", 10)
    made = jobs.all_digests(job)
    assert made.count() == 1
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    days = lake.ticks(captures)
    assert backlog.days_due(streams, days, captures, made, ledger.current("daily_summaries"), now()).count() == 0
    later = Job(ledger, "compact_due", 20)
    kept = jobs.all_digests(later)
    assert kept.count() == 1 and "digests" not in later.done
    plan = backlog.days_due(streams, days, ledger.current("captures"), kept, ledger.current("daily_summaries"), now())
    files = plan.inputFiles()
    assert not [f for f in files if "compaction_inputs" in f] and [f for f in files if "revision_digests" in f]
    assert plan.count() == 0
    more = captures.limit(1).withColumn("capture_id", F.lit("late"))
    assert backlog.days_due(streams, days, captures.unionByName(more), kept, ledger.current("daily_summaries"), now()).first()["revision"] == 2
