import datetime as dt

from pyspark.sql import functions as F

from tests import lake
from tests.feeds import MALFORMED, body, feed
from transitlake.schemas import CAPTURE, TICK
from transitlake.sources import bodies as B
from transitlake.sources.ledger import Ledger
from transitlake.streaming import daily, landing, registration
from workload.landing_files import write_landing


def at(text):
    return F.lit(text).cast("timestamp")


def deliver(df, path, part):
    df.coalesce(1).write.parquet(f"{path}/part={part}")


def arriving(spark, path):
    return spark.readStream.schema(CAPTURE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(path)


def test_bronze_keeps_every_body_once(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed()), MALFORMED, b""])
    assert write_landing(captures, root) == 3

    def run():
        arrivals = B.stream_bodies(spark, root, max_files=1).unionByName(B.empty_bodies(B.stream_sidecars(spark, root)))
        landing.start_bronze(arrivals, f"{root}/bronze", f"{root}/cp").awaitTermination()
        return spark.read.parquet(f"{root}/bronze")

    statuses = sorted(r["parse_status"] for r in run().collect())
    assert statuses == ["empty_body", "protobuf_decode", "valid"]
    write_landing(lake.captures_with_bodies(spark, [body(feed(timestamp=1))], stream="more"), root)
    bronze = run()
    assert bronze.count() == 4
    joined = captures.join(bronze.select("raw_path", F.col("body").alias("kept")), "raw_path")
    assert joined.filter("body = kept").count() == 3


def test_arrivals_by_their_documents(spark, tmp_path):
    """Bodies come with the documents that name them: empty ones, those of odd names, and the news of a missing one."""
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed()), b"", MALFORMED, body(feed(timestamp=7))], stream="a b")
    write_landing(captures.filter("capture_id LIKE '%-1' OR capture_id LIKE '%-2'"), root)

    def run():
        landing.start_bronze(B.stream_arrivals(spark, root, max_files=1), f"{root}/bronze", f"{root}/cp").awaitTermination()
        return {r["raw_path"]: (r["parse_status"], r["body"] and bytes(r["body"])) for r in spark.read.parquet(f"{root}/bronze").collect()}

    assert sorted(s for s, _ in run().values()) == ["empty_body", "valid"]
    write_landing(captures.filter("capture_id LIKE '%-3' OR capture_id LIKE '%-4'"), root)
    gone = captures.filter("capture_id LIKE '%-4'").first()["raw_path"]
    B.located(f"file://{root}")[0].delete_file(f"{root}/{gone}")
    found = run()
    assert found.pop(gone) == ("missing_body", None)
    batch = B.scan_bodies(spark, root).unionByName(B.empty_bodies(B.scan_sidecars(spark, root)))
    assert {p: b for p, (_, b) in found.items()} == {r["raw_path"]: bytes(r["body"]) for r in batch.collect()}
    assert sorted(s for s, _ in found.values()) == ["empty_body", "protobuf_decode", "valid"]
    plan = B.open_arrivals(B.scan_sidecars(spark, root), root)
    assert all(f.endswith(".json") for f in plan.inputFiles())  # no body is listed


def test_large_bodies_come_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "OPENED_BYTES", 10)
    import pyarrow as pa

    for name in "abc":
        (tmp_path / name).write_bytes(name.encode() * 8)
    rows = pa.RecordBatch.from_pydict({**{n: ["x"] * 4 for n in ("source", "stream", "date", "hour")}, "raw_path": ["a", "b", "none", "c"],
                                       "decoded_length": [8, 8, 8, 8]})
    out = list(B._opener(f"file://{tmp_path}")([rows]))
    assert [b.num_rows for b in out] == [2, 2]
    assert [v for b in out for v in b.column("body").to_pylist()] == [b"a" * 8, b"b" * 8, None, b"c" * 8]


def test_late_captures_open_a_revision_and_repeats_do_not(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed())] * 4).drop("body")
    first, late = captures.filter("capture_id <> 'demo-trips-4'"), captures.filter("capture_id = 'demo-trips-4'")
    ledger = Ledger(spark, root).create()
    seen = []
    handle = registration.revise_late_days(ledger, at("2026-08-20"), compact=lambda days: seen.append(days.count()))

    def run():
        registration.start(arriving(spark, f"{root}/in"), handle, f"{root}/cp").awaitTermination()
        return [(r["revision"], r["rows"]) for r in ledger.current("compactions").orderBy("revision").collect()]

    deliver(first, f"{root}/in", 1)
    assert run() == [(1, 3)]
    deliver(first, f"{root}/in", 2)
    assert run() == [(1, 3)]
    deliver(late, f"{root}/in", 3)
    assert run() == [(1, 3), (2, 4)] and ledger.current("captures").count() == 4
    inputs = ledger.current("compaction_inputs").groupBy("compaction_id").count()
    assert sorted(r["count"] for r in inputs.collect()) == [3, 4]
    # a batch that is run once more changes nothing
    handle(late, 2)
    assert ledger.current("compactions").count() == 2 and ledger.changes("captures").count() == 4


def test_a_capture_far_behind_is_registered(spark, tmp_path):
    root = str(tmp_path)
    captures = lake.captures_with_bodies(spark, [body(feed())] * 2).drop("body")
    newer, older = captures.filter("capture_id <> 'demo-trips-1'"), captures.filter("capture_id = 'demo-trips-1'")
    ledger = Ledger(spark, root).create()

    def run():
        handle = lambda batch, batch_id: registration.register(ledger, batch, batch_id)
        registration.start(arriving(spark, f"{root}/in"), handle, f"{root}/cp").awaitTermination()
        return {r["capture_id"] for r in ledger.current("captures").collect()}

    far = older.withColumn("completed_at", F.col("completed_at") - F.expr("INTERVAL 90 DAYS"))
    deliver(newer, f"{root}/in", 1)
    assert run() == {"demo-trips-2"}
    deliver(far, f"{root}/in", 2)
    assert run() == {"demo-trips-1", "demo-trips-2"}


def test_windows_nest_in_local_days(spark, tmp_path):
    root = str(tmp_path)
    start = dt.datetime(2026, 8, 12, 6, 50)
    rows = [(f"t{i}", "demo", "trips", start + dt.timedelta(minutes=5 * i), None, None, "captured", "", "", "", 200, 1, "f")
            for i in range(24)]
    spark.createDataFrame(rows, TICK).coalesce(1).write.parquet(f"{root}/ticks")
    stream = spark.readStream.schema(TICK).parquet(f"{root}/ticks")
    windows = daily.tick_windows(stream)
    (windows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    closed = spark.read.schema(windows.schema).parquet(f"{root}/out")
    # the last tick is at 08:45, so the watermark is 08:30 and closes the windows up to it
    assert closed.agg(F.max("window_start")).first()[0] == dt.datetime(2026, 8, 12, 8, 15)
    days = daily.roll_up_days(closed, lake.streams(spark, ("demo", "trips", "trip_update", "America/Vancouver")))
    found = {r["archive_date"]: r["scheduled_ticks"] for r in days.collect()}
    assert found == {"2026-08-11": 2, "2026-08-12": 18}
