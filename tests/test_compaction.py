
import pytest
from pyspark.sql import functions as F

from tests import lake
from tests.feeds import MALFORMED, body, feed, trip
from transitlake.functions.paths import publish_path
from transitlake.operators.statistics import DAY
from transitlake.plans import backlog, compact, publish, reconcile, verify
from transitlake.schemas import FLAT_ROW
from transitlake.sources import bodies as B
from transitlake.sources import revisions as R
from workload.landing_files import write_landing

def now():
    return F.lit("2026-08-20 00:00:00").cast("timestamp")


def flattened_bodies():
    one, two = feed(), feed()
    e1 = one.entity.add(id=b"e1")
    trip(e1)
    e1.trip_update.stop_time_update.add(stop_sequence=4, stop_id=b"quay")
    e1.trip_update.stop_time_update.add(stop_sequence=9, stop_id=b"mill")
    trip(one.entity.add(id=b"e2"))
    e4 = two.entity.add(id=b"e4", is_deleted=True)
    trip(e4)
    e4.trip_update.stop_time_update.add(stop_sequence=17)
    return [body(one), MALFORMED, body(two)]


def nested_bodies():
    m = feed()
    m.entity.add(id=b"v").vehicle.timestamp = 5
    trip(m.entity.add(id=b"t"))
    m.entity.add(id=b"a").alert.header_text.translation.add(text=b"Ferry replaced by coach", language=b"en")
    m.entity.add(id=b"d", is_deleted=True)
    return [body(m), MALFORMED, body(m)]


@pytest.fixture(scope="module")
def compacted(spark, tmp_path_factory):
    """A trip-update day and a mixed day with malformed bodies, and a day with ticks only."""
    root = str(tmp_path_factory.mktemp("lake"))
    flat = lake.captures_with_bodies(spark, flattened_bodies())
    mixed = lake.captures_with_bodies(spark, nested_bodies(), kind="mixed", stream="mixed", incomplete=(2,),
                                      url="https://example.test/mixed")
    both = R.materialize(flat.unionByName(mixed), root, "bronze")
    captures, bodies = both.drop("body"), both.select("raw_path", "body")
    empty = lake.ticks(captures.limit(1)).withColumns({
        "tick_id": F.lit("t-empty"), "stream_id": F.lit("silent"), "result": F.lit("skipped"),
        "scheduled_at": F.col("scheduled_at"), "archive_date": F.lit("2026-08-12")})
    ticks = lake.ticks(captures).unionByName(empty)
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"), ("demo", "mixed", "mixed", "UTC"),
                           ("demo", "silent", "trip_update", "UTC"))
    destinations = lake.destinations(spark, ("primary", True, f"file://{root}/out"), ("spare", False, f"file://{root}/spare"))
    chosen = lake.days(spark, *[("demo", s, "2026-08-12", 1) for s in ("trips", "mixed", "silent")])
    result = compact.compact_days(spark, root, captures, ticks, bodies, streams, chosen, destinations, now(),
                                  R.WriterOptions(row_group_rows=2))
    return dict(root=root, captures=captures, bodies=bodies, ticks=ticks, streams=streams, days=chosen,
                destinations=destinations, result=result)


def manifest(compacted, stream):
    return compacted["result"].manifests.filter(F.col("stream_id") == stream).first()


def test_flattened_day(spark, compacted):
    rows = R.read_revisions(spark, compacted["root"], flattened=True).collect()
    assert sorted((r["entity_id"], r["stop_id"] or "") for r in rows) == [("e1", "mill"), ("e1", "quay"), ("e2", ""), ("e4", "")]
    m = manifest(compacted, "trips")
    assert (m["captured_responses"], m["entity_total"], m["stop_time_update_total"]) == (3, 3, 3)
    assert m["schema_version"] == 2 and [f["rows"] for f in m["files"]] == [3]
    assert len(m["input_captures"]) == 3 and m["parse_status_counts"] == {"protobuf_decode": 1, "valid": 2}
    assert m["required_destinations"] == ["primary"] and [d["id"] for d in m["destinations"]] == ["primary", "spare"]
    ledger = compacted["result"].compactions.filter("stream_id = 'trips'").first()
    assert ledger["rows"] == 3 and ledger["data_sha256"] == m["files"][0]["sha256"]


def test_file_order_and_columns(spark, compacted):
    path = f"{R.data_root(compacted['root'])}/source=demo/stream=trips/date=2026-08-12/revision=1"
    rows = spark.read.parquet(path)
    assert rows.columns == FLAT_ROW.names
    assert [r["entity_id"] for r in rows.collect()] == ["e1", "e1", "e2", "e4"]


def test_nested_day(spark, compacted):
    rows = R.read_revisions(spark, compacted["root"], flattened=False).orderBy("scheduled_at").collect()
    assert [len(r["entities"]) for r in rows] == [4, 0, 4] and bytes(rows[1]["feed_message_pb"]) == MALFORMED
    assert rows[0]["entities"][2]["alert"]["header_text"]["translation"][0]["text"] == "Ferry replaced by coach"
    m = manifest(compacted, "mixed")
    assert (m["valid_snapshots"], m["invalid_payloads"], m["schema_version"]) == (1, 2, 1)
    assert m["stop_time_update_total"] is None and m["entity_total"] == 8


def test_day_without_captures(compacted):
    m = manifest(compacted, "silent")
    assert m["dataset_status"] == "no_captured_responses" and m["stop_time_update_total"] == 0
    assert m["skipped_ticks"] == 1 and m["files"] is None and m["sanitized_url"] == "https://example.test/silent"


def test_fresh_revisions_verify(spark, compacted):
    result, root = compacted["result"], compacted["root"]
    assert result.violations.count() == 0
    found = verify.verify_revisions(result.manifests, result.compactions, result.inputs, result.files, R.scan_parts(spark, root))
    assert found.collect() == []


def test_missing_fields_break_their_rules(spark, compacted):
    result = compacted["result"]
    rules = {"manifest_version": "format_version", "format_version": "format_version", "schema_version": "schema_version",
             "dataset_status": "dataset_status", "captured_responses": "aggregate_counts", "entity_total": "aggregate_counts",
             "expected_kind": "flattened_kind", "stop_time_update_total": "flattened_total"}
    for field, rule in rules.items():
        kind = result.manifests.schema[field].dataType
        damaged = result.manifests.withColumn(field, F.lit(None).cast(kind))
        found = verify.manifest_violations(damaged, result.compactions, result.inputs, result.files)
        assert rule in {r["violation"] for r in found.collect()}, field
    # the same of the ledger, but nothing is said of a revision that the ledger does not have
    parts = R.scan_parts(spark, compacted["root"])
    for field, rule in {"rows": "aggregate_counts", "entities": "aggregate_counts", "data_bytes": "ledger_artifact",
                        "data_path": "ledger_artifact", "data_sha256": "ledger_artifact"}.items():
        damaged = result.compactions.withColumn(field, F.lit(None).cast(result.compactions.schema[field].dataType))
        found = verify.verify_revisions(result.manifests, damaged, result.inputs, result.files, parts)
        assert rule in {r["violation"] for r in found.collect()}, field
    unknown = verify.verify_revisions(result.manifests, result.compactions.filter("false"), result.inputs, result.files, parts)
    assert {r["violation"] for r in unknown.collect()} == {"identity"}


def test_damage_is_found(spark, compacted):
    result, root = compacted["result"], compacted["root"]
    parts = R.scan_parts(spark, root).withColumn("sha256", F.lit("0" * 64))
    found = {r["violation"] for r in verify.file_violations(result.manifests, result.compactions, result.files, parts).collect()}
    assert found == {"artifact_integrity"}
    gone = verify.file_violations(result.manifests, result.compactions, result.files, parts.filter("false"))
    assert {r["violation"] for r in gone.collect()} == {"artifact_missing"}


def test_content_check_sees_a_wrong_body(compacted):
    captures = compacted["captures"].filter("stream_id = 'trips'")
    other = compacted["bodies"].withColumn("body", F.lit(b"x"))
    expected = compact.expected_counts(captures, other, compacted["days"])
    written = compact.flattened_plan(captures, compacted["bodies"], compacted["days"])
    found = compact.check_flattened(written, expected).collect()
    assert {r["violation"] for r in found} == {"body_hash_mismatch"} and len(found) == 3
    missing = compact.expected_counts(captures, compacted["bodies"].filter("false"), compacted["days"])
    assert compact.check_flattened(written, missing).count() == 3


def test_empty_body_needs_no_file(spark, tmp_path):
    root = str(tmp_path)
    captures = R.materialize(lake.captures_with_bodies(spark, [b"", body(feed())], kind="alert", stream="alerts"), root, "c")
    chosen = lake.days(spark, ("demo", "alerts", "2026-08-12", 1))
    listed = captures.filter("decoded_length > 0").select("raw_path", "body")
    rows = compact.nested_plan(captures.drop("body"), listed, chosen).orderBy("scheduled_at").collect()
    assert [(r["parse_status"], r["entity_count"], len(r["feed_message_pb"]) > 0) for r in rows] == [
        ("empty_body", None, False), ("valid", 0, True)]
    assert rows[0]["header"] is None and rows[0]["entities"] == []


def test_disagreeing_urls_are_refused(spark, compacted, tmp_path):
    moved = compacted["captures"].withColumn("sanitized_url", F.concat("sanitized_url", F.lit("/"), "capture_id"))
    result = compact.compact_days(spark, str(tmp_path), moved, compacted["ticks"], compacted["bodies"], compacted["streams"],
                                  compacted["days"], compacted["destinations"], now())
    assert [r["stream_id"] for r in result.manifests.collect()] == ["silent"]
    reported = {(r["stream_id"], r["violation"]) for r in result.violations.collect()}
    assert reported and {violation for _, violation in reported} == {"url_mismatch"}
    assert "silent" not in {stream for stream, _ in reported}


def test_leftovers_of_an_unfinished_attempt_are_not_read(spark, compacted, tmp_path):
    root = str(tmp_path)
    args = (compacted["captures"], compacted["bodies"], compacted["days"])
    R.write_flattened(compact.flattened_plan(*args), root)
    result = compact.compact_days(spark, root, compacted["captures"], compacted["ticks"], compacted["bodies"],
                                  compacted["streams"], compacted["days"], compacted["destinations"], now())
    assert result.violations.count() == 0 and R.scan_written(spark, root, flattened=True).count() == 8
    assert R.read_revisions(spark, root, flattened=True).count() == 4


def test_backlog_follows_the_ledger(compacted):
    args = (compacted["streams"], compacted["ticks"], compacted["captures"])
    result = compacted["result"]
    captured = compacted["captures"].select("capture_id", *DAY)
    inputs = captured.join(result.compactions.select("compaction_id", *DAY), list(DAY)).select("compaction_id", "capture_id")
    nothing = result.compactions.filter("false")
    none = compacted["days"].filter("false")
    due = backlog.days_to_compact(*args, nothing, inputs.filter("false"), none, now())
    assert {(r["stream_id"], r["revision"]) for r in due.collect()} == {("trips", 1), ("mixed", 1), ("silent", 1)}
    assert backlog.days_to_compact(*args, result.compactions, inputs, none, now()).count() == 0
    late = inputs.filter("capture_id <> 'demo-trips-3'")
    due = backlog.days_to_compact(*args, result.compactions, late, none, now())
    assert [(r["stream_id"], r["revision"]) for r in due.collect()] == [("trips", 2)]
    early = F.lit("2026-08-13 00:14:59").cast("timestamp")
    assert backlog.days_to_compact(*args, nothing, inputs, none, early).count() == 0
    summarised = compacted["days"].filter("stream_id = 'trips'")
    due = backlog.days_to_compact(*args, nothing, inputs, summarised, now())
    assert {r["stream_id"] for r in due.collect()} == {"mixed", "silent"}


def test_adoption(spark, compacted):
    result, root = compacted["result"], compacted["root"]
    none = result.compactions.filter("false")
    found = verify.verify_revisions(result.manifests, none, result.inputs, result.files, R.scan_parts(spark, root))
    adopted = reconcile.adoptable(result.manifests, none, result.inputs, compacted["captures"], found)
    assert adopted.count() == 3
    queue = reconcile.adoption_queue(adopted, now()).collect()
    assert len(queue) == 6 and {(q["destination_id"], q["required"]) for q in queue} == {("primary", True), ("spare", False)}
    fewer = compacted["captures"].filter("capture_id <> 'demo-mixed-1'")
    assert {r["stream_id"] for r in reconcile.adoptable(result.manifests, none, result.inputs, fewer, found).collect()} == {"trips", "silent"}


def test_publication_round(spark, compacted):
    result, root = compacted["result"], compacted["root"]
    queue = R.materialize(compact.queue_publications(result.compactions, compacted["destinations"], now()), root, "q")
    only = compacted["destinations"].filter("id = 'primary'")
    done = publish.publish_due(spark, root, queue, result.compactions, result.manifests, only, compacted["streams"], now(), F.lit(0.5))
    states = {(r["destination_id"], r["status"], r["last_error"]) for r in done.collect()}
    assert states == {("primary", "verified", ""), ("spare", "retry", "destination_not_configured")}
    path = f"file://{root}/out/mixed/date=2026-08-12/base64url=aHR0cHM6Ly9leGFtcGxlLnRlc3QvbWl4ZWQ/revision=1"
    assert path in {r["remote_path"] for r in done.collect()}
    assert spark.read.json(path + "/manifest.json").first()["captured_responses"] == 3
    after = publish.apply_changes(queue, done, "publication_id")
    released = publish.release(result.compactions, after, done.filter("status = 'verified'"), now())
    assert {r["status"] for r in released.collect()} == {"published"} and released.count() == 3
    # a second round finds its own copies and leaves them alone
    again = publish.publish_due(spark, root, queue, result.compactions, result.manifests, only, compacted["streams"], now(), F.lit(0.5))
    assert again.filter("status = 'verified'").count() == 3


def test_unsound_revision_is_not_published(spark, compacted, tmp_path):
    result, root = compacted["result"], compacted["root"]
    wrong = result.compactions.withColumn("entities", F.when(F.col("stream_id") == "trips", 99).otherwise(F.col("entities")))
    target = compacted["destinations"].filter("required").withColumn("remote", F.lit(f"file://{tmp_path}/out"))
    queue = R.materialize(compact.queue_publications(wrong, target, now()), root, "q2")
    done = publish.publish_due(spark, root, queue, wrong, result.manifests, target, compacted["streams"], now(), F.lit(0.5))
    streams = done.join(wrong.select("compaction_id", "stream_id"), "compaction_id").collect()
    assert {r["stream_id"]: (r["status"], r["last_error"]) for r in streams} == {
        "trips": ("permanent_failure", "local_integrity"), "mixed": ("verified", ""), "silent": ("verified", "")}
    assert not (tmp_path / "out" / "trip_updates" / "date=2026-08-12" / "base64url=aHR0cHM6Ly9leGFtcGxlLnRlc3QvdHJpcHM").exists()


def test_misplaced_manifest_is_not_adopted(spark, compacted, tmp_path):
    root = str(tmp_path)
    documents = compacted["result"].manifests
    columns = {p: F.col(c) for p, c in zip(R.PARTITIONS[:3], ("source_id", "stream_id", "archive_date"), strict=True)}
    moved = documents.withColumns(columns).withColumn("manifest_revision", F.col("revision")).withColumn(
        "date", F.when(F.col("stream_id") == "mixed", "2020-01-01").otherwise(F.col("date")))
    moved.write.partitionBy(*R.PARTITIONS).json(R.manifest_root(root))
    found = R.misplaced_manifests(spark, root)
    assert [r["stream_id"] for r in found.collect()] == ["mixed"]
    result, none = compacted["result"], compacted["result"].compactions.filter("false")
    clean = verify.verify_revisions(result.manifests, result.compactions, result.inputs, result.files, R.scan_parts(spark, compacted["root"]))
    adopted = reconcile.adoptable(R.scan_manifests(spark, root), none, result.inputs, compacted["captures"], clean, found)
    assert {r["stream_id"] for r in adopted.collect()} == {"trips", "silent"}


def test_publication_never_overwrites(spark, compacted, tmp_path):
    source, target = tmp_path / "a", tmp_path / "b"
    source.write_bytes(b"one")
    target.write_bytes(b"two")
    rows = [(f"file://{source}", f"file://{target}", "7692c3ad3540bb803c020b3aee66cd8887123234ea0c6e7143c0add73ff431ed"),
            (f"file://{source}", f"file://{tmp_path}/x/c", "0" * 64),
            (f"file://{tmp_path}/none", f"file://{tmp_path}/d", "0" * 64)]
    copied = publish.copy_files(spark.createDataFrame(rows, "source string, target string, sha256 string"))
    found = {r["target"][-1]: r["status"] for r in copied.collect()}
    assert found == {"b": "remote_integrity", "c": "local_integrity", "d": "local_integrity"}
    assert target.read_bytes() == b"two" and not (tmp_path / "x" / "c").exists()


def test_publish_path_vectors(spark):
    rows = [("alert", "2026-08-14", 3, "https://example.test/feed"), ("auto", "2026-08-14", 1, "https://example.test/feed"),
            ("nonsense", "2026-08-14", 1, "u"), ("alert", "14.08.2026", 1, "u"), ("alert", "2026-08-14", 0, "u")]
    df = spark.createDataFrame(rows, "k string, d string, r int, u string")
    paths = [r[0] for r in df.select(publish_path(*[F.col(c) for c in "kdru"])).collect()]
    key = "base64url=aHR0cHM6Ly9leGFtcGxlLnRlc3QvZmVlZA"
    assert paths == [f"service_alerts/date=2026-08-14/{key}/revision=3", f"mixed/date=2026-08-14/{key}/revision=1", None, None, None]


def test_writer_options():
    with pytest.raises(ValueError):
        R.WriterOptions(compression="gzip")


def tombstone(entity=b"gone"):
    m = feed()
    e = m.entity.add(id=entity, is_deleted=True)
    e.ClearField("trip_update")
    return body(m)


def run_lake(spark, root, per_stream):
    """Compact trip-update streams, given the bodies of each; all as revision 1."""
    frames = [lake.captures_with_bodies(spark, bodies, stream=name, url=f"https://example.test/{name}")
              for name, bodies in per_stream.items()]
    both = frames[0]
    for more in frames[1:]:
        both = both.unionByName(more)
    both = R.materialize(both, root, "bronze")
    captures = both.drop("body")
    streams = lake.streams(spark, *[("demo", name, "trip_update", "UTC") for name in per_stream])
    target = lake.destinations(spark, ("primary", True, f"file://{root}/out"))
    chosen = lake.days(spark, *[("demo", name, "2026-08-12", 1) for name in per_stream])
    result = compact.compact_days(spark, root, captures, lake.ticks(captures), both.select("raw_path", "body"), streams,
                                  chosen, target, now())
    return result, streams, target


def published(spark, root, result, streams, target):
    queue = R.materialize(compact.queue_publications(result.compactions, target, now()), root, "queue")
    done = publish.publish_due(spark, root, queue, result.compactions, result.manifests, target, streams, now(), F.lit(0.5))
    return [(r["status"], r["last_error"]) for r in done.collect()]


def sound(spark, root, result):
    return verify.verify_revisions(result.manifests, result.compactions, result.inputs, result.files,
                                   R.scan_parts(spark, root)).collect() == []


def test_capture_without_rows_beside_a_full_one(spark, tmp_path):
    root = str(tmp_path)
    result, *rest = run_lake(spark, root, {"trips": [flattened_bodies()[0], tombstone()]})
    m = result.manifests.first()
    assert (m["captured_responses"], m["entity_total"], [f["entities"] for f in m["files"]]) == (2, 3, [3])
    assert result.violations.count() == 0 and sound(spark, root, result)
    assert published(spark, root, result, *rest) == [("verified", "")]


def test_day_whose_captures_flatten_to_nothing(spark, tmp_path):
    root = str(tmp_path)
    result, *rest = run_lake(spark, root, {"trips": [MALFORMED, tombstone()]})
    m = result.manifests.first()
    assert (m["dataset_status"], m["captured_responses"], m["stop_time_update_total"], m["files"]) == ("ready", 2, 0, None)
    assert result.violations.count() == 0 and sound(spark, root, result)
    assert R.read_revisions(spark, root, flattened=True).count() == 0
    assert published(spark, root, result, *rest) == [("verified", "")]


def test_repeated_job_leaves_one_document_and_one_list(spark, tmp_path):
    root = str(tmp_path)
    per_stream = {"trips": flattened_bodies()}
    run_lake(spark, root, per_stream)
    result, *rest = run_lake(spark, root, per_stream)
    assert result.manifests.count() == 1 and result.inputs.count() == 3 and result.files.count() == 1
    assert sound(spark, root, result) and published(spark, root, result, *rest) == [("verified", "")]
    assert R.read_revisions(spark, root, flattened=True).count() == 4


def test_lake_where_every_day_was_refused(spark, compacted, tmp_path):
    root = str(tmp_path)
    moved = compacted["captures"].withColumn("sanitized_url", F.concat("sanitized_url", "capture_id"))
    chosen = compacted["days"].filter("stream_id <> 'silent'")
    result = compact.compact_days(spark, root, moved, compacted["ticks"], compacted["bodies"], compacted["streams"],
                                  chosen, compacted["destinations"], now())
    assert result.manifests.count() == 0 and R.unreadable_manifests(spark, root).count() == 0
    queue = compact.queue_publications(result.compactions, compacted["destinations"], now())
    done = publish.publish_due(spark, root, queue, result.compactions, result.manifests, compacted["destinations"],
                               compacted["streams"], now(), F.lit(0.5))
    assert done.count() == 0


def test_unreadable_documents_and_ledger_differences_count_as_corrupt(spark, compacted, tmp_path):
    root = str(tmp_path)
    R.write_manifests(compacted["result"].manifests.filter("stream_id <> 'silent'"), root)
    home = tmp_path / "manifests" / "format=v1" / "source=demo" / "stream=silent" / "date=2026-08-12" / "revision=1"
    home.mkdir(parents=True)
    (home / "part-0.json").write_text("{not a document\n")
    broken = R.unreadable_manifests(spark, root)
    assert [r["stream_id"] for r in broken.collect()] == ["silent"]
    assert {r["stream_id"] for r in R.scan_manifests(spark, root).collect()} == {"trips", "mixed"}
    result = compacted["result"]
    altered = result.compactions.withColumn("data_sha256", F.lit("0" * 64))
    found = verify.verify_revisions(result.manifests, altered, result.inputs, result.files, R.scan_parts(spark, compacted["root"]))
    assert {r["stream_id"] for r in reconcile.unsound(found).collect()} == {"trips", "mixed"}


def test_only_the_days_in_hand_are_read(spark, compacted, tmp_path):
    root = str(tmp_path)
    write_landing(compacted["captures"].join(compacted["bodies"], "raw_path"), root)
    wanted = compacted["days"].filter("stream_id = 'trips'")
    bodies = compact.bodies_of_days(B.scan_bodies(spark, root), wanted)
    assert {r["stream"] for r in bodies.select("stream").distinct().collect()} == {"trips"}
    plans = [bodies, R.of_days(R.scan_inputs(spark, compacted["root"]), wanted),
             R.of_days(R.scan_files(spark, compacted["root"]), wanted)]
    for plan in plans:
        assert "dynamicpruning" in plan._jdf.queryExecution().toString().lower()
