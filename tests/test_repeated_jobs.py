"""Jobs that fail once after any of their steps end like the undisturbed job."""

import datetime as dt

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tests import lake
from tests.test_compaction import flattened_bodies
from transitlake.plans import jobs, journal, retention
from transitlake.sources import bodies as B
from transitlake.sources.ledger import KEYS, Ledger
from workload.landing_files import write_landing

NAMES = {15: "reconcile_lake", 30: "publish_round", 40: "clean_up"}
WEEK = retention.RetentionPolicy(raw_s=86400, parquet_s=86400, metadata_s=86400)


def at(text):
    return F.lit(text).cast("timestamp")


class Broken(Exception):
    pass


def state(ledger):
    """Every table's present rows, and how many change rows there are."""
    out = {}
    for table in KEYS:
        rows = ledger.current(table)
        names = [c for c in rows.columns if c not in ("created_at", "parse_status_counts", "response_headers")]
        out[table] = (sorted(repr(r).replace(ledger.root, "") for r in rows.select(*names).collect()), ledger.changes(table).count())
    return out


def tree(root, *parts):
    store, base = fs.FileSystem.from_uri(f"file://{root}")
    found = []
    for part in parts:
        if store.get_file_info(f"{base}/{part}").type == fs.FileType.Directory:
            found += [f.path[len(base) + 1:] for f in store.get_file_info(fs.FileSelector(f"{base}/{part}", recursive=True))
                      if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]
    return sorted(found)


def failing_at(monkeypatch, step):
    """Make the job fail when ``step`` is written, but not yet noted as finished."""
    real = journal.Job.note

    def note(self, name):
        if name == step:
            raise Broken(step)
        real(self, name)

    monkeypatch.setattr(journal.Job, "note", note)


def steps_of(monkeypatch, run):
    seen = []
    real = journal.Job.note
    monkeypatch.setattr(journal.Job, "note", lambda self, step: (seen.append(step), real(self, step)))
    run()
    monkeypatch.undo()
    return [s for s in seen if s != "begin"]


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """A lake before each job: as landed, compacted, and published; copied for each trial."""
    root = str(tmp_path_factory.mktemp("lake"))
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    stages = {}

    def keep(name):
        copy = str(tmp_path_factory.mktemp(name))
        fs.copy_files(f"file://{root}", f"file://{copy}")
        stages[name] = copy

    def target(path):
        return lake.destinations(spark, ("primary", True, f"file://{path}/out"))

    write_landing(lake.captures_with_bodies(spark, flattened_bodies()), root)
    ledger = Ledger(spark, root).create()
    keep("landed")
    jobs.reconcile_lake(ledger, root, at("2026-08-20"), 10)
    jobs.compact_due(ledger, root, B.scan_bodies(spark, root), streams, target(root), at("2026-08-20"), 20)
    keep("compacted")
    keep("lost")
    journal.remove_tree(ledger, f"{stages['lost']}/ledger")
    Ledger(spark, stages["lost"]).create()
    jobs.publish_round(ledger, root, streams, target(root), at("2026-08-21"), F.lit(0.5), 30)
    keep("published")

    def fresh(name):
        copy = str(tmp_path_factory.mktemp("trial"))
        fs.copy_files(f"file://{stages[name]}", f"file://{copy}")
        return copy
    return fresh, streams, target


def trial(spark, monkeypatch, copies, stage, number, job, *trees, also=()):
    """The job straight through, and with a failure at each of its appends, one after the other."""
    fresh, streams, target = copies
    root = fresh(stage)
    steps = steps_of(monkeypatch, lambda: job(Ledger(spark, root), root, streams, target(root), number))
    wanted, files = state(Ledger(spark, root)), tree(root, *trees)
    assert tree(root, f"work/{NAMES[number]}-{number}", "ledger/jobs/active") == []
    root = fresh(stage)
    ledger = Ledger(spark, root)
    for step in steps:
        if step.startswith("append-") or step in also:
            failing_at(monkeypatch, step)
            with pytest.raises(Broken, match=step):
                job(ledger, root, streams, target(root), number)
            monkeypatch.undo()
    job(ledger, root, streams, target(root), number)
    assert state(ledger) == wanted and tree(root, *trees) == files
    assert tree(root, f"work/{NAMES[number]}-{number}", "ledger/jobs/active") == []
    before = {t: ledger.changes(t).count() for t in KEYS}
    job(ledger, root, streams, target(root), number)  # a finished job does nothing
    assert {t: ledger.changes(t).count() for t in KEYS} == before
    return steps, wanted


def test_clean_up_with_deletion(spark, monkeypatch, copies):
    def job(ledger, root, streams, target, number):
        return jobs.clean_up(ledger, streams, target, at("2026-08-30"), number, WEEK, delete=True)

    steps, wanted = trial(spark, monkeypatch, copies, "published", 40, job, "raw", "parquet", "manifests")
    assert [s for s in steps if s.startswith("append-")] == [
        "append-deletions-0", "append-deletions-1", "append-captures-0", "append-publications-0", "append-compactions-0",
        "append-daily_summaries-0", "append-compaction_inputs-1-removed", "append-captures-1-removed", "append-ticks-1-removed", "append-audit-0"]
    assert wanted["captures"][0] == wanted["ticks"][0] == wanted["compaction_inputs"][0] == [] and len(wanted["daily_summaries"][0]) == 1
    assert len(wanted["deletions"][0]) == 8


def test_publish_round(spark, monkeypatch, copies):
    def job(ledger, root, streams, target, number):
        return jobs.publish_round(ledger, root, streams, target, at("2026-08-21"), F.lit(0.5), number)

    steps, wanted = trial(spark, monkeypatch, copies, "compacted", 30, job, "parquet", "out", also=("copied",))
    assert [s for s in steps if s.startswith("append-")] == ["append-publications-0", "append-compactions-0"]
    assert "verified" in wanted["publications"][0][0] and "published" in wanted["compactions"][0][0]


def test_reconcile_lake(spark, monkeypatch, copies):
    """The ledger is lost: captures are registered and the revision on disk is adopted, once."""
    fresh, streams, target = copies

    def job(ledger, root, streams, target, number):
        return jobs.reconcile_lake(ledger, root, at("2026-08-20"), number)

    steps, wanted = trial(spark, monkeypatch, copies, "lost", 15, job, "raw")
    assert [s for s in steps if s.startswith("append-")] == [
        "append-ticks-0", "append-captures-0", "append-compaction_inputs-0", "append-revision_digests-0", "append-publications-0",
        "append-compactions-0"]
    assert [len(wanted[t][0]) for t in ("captures", "ticks", "compaction_inputs", "publications", "compactions")] == [3, 3, 3, 1, 1]


def test_a_run_given_up_loses_nothing(spark, monkeypatch, copies):
    """The next run, under its own number, deletes what was only intended and removes what was only summarised."""
    fresh, streams, target = copies
    steps = ["append-deletions-0", "append-daily_summaries-0"]
    ends = []
    for stop in [None, *steps]:
        root = fresh("published")
        ledger = Ledger(spark, root)
        if stop:
            real = journal.Job.note

            def note(self, step, stop=stop, real=real):
                real(self, step)
                if step == stop:
                    raise Broken(step)
            monkeypatch.setattr(journal.Job, "note", note)
            with pytest.raises(Broken):
                jobs.clean_up(ledger, streams, target(root), at("2026-08-30"), 40, WEEK, delete=True)
            monkeypatch.undo()
        jobs.clean_up(ledger, streams, target(root), at("2026-08-30"), 50, WEEK, delete=True)
        left = {t: ledger.current(t).count() for t in ("captures", "ticks", "compaction_inputs", "daily_summaries")}
        ends.append((left, tree(root, "raw", "parquet", "manifests")))
        assert tree(root, "work/clean_up-40", "work/clean_up-50", "ledger/jobs/active") == []
        assert {r["outcome"] for r in ledger.current("deletions").collect()} <= {"deleted", "gone"}
    assert ends[0] == ends[1] == ends[2] and ends[0][1] == [] and ends[0][0]["daily_summaries"] == 1


def test_deletion_on_request(spark, copies):
    """Listed first, deleted later, once; a file that is gone already is as good as deleted."""
    fresh, streams, target = copies
    root = fresh("published")
    ledger = Ledger(spark, root)
    only_files = retention.RetentionPolicy(raw_s=86400, parquet_s=86400, metadata_s=400 * 86400)
    found = jobs.clean_up(ledger, streams, target(root), at("2026-08-30"), 40, only_files)
    assert {r["outcome"] for r in found.collect()} == {"listed"} and found.count() == 8
    files = tree(root, "raw", "parquet", "manifests")
    assert len(files) == 8
    fs.FileSystem.from_uri(f"file://{root}")[0].delete_file(f"{root}/{files[-1]}")  # a raw file
    done = jobs.delete_listed(ledger, at("2026-08-31"), 50)
    assert sorted(r["outcome"] for r in done.collect()) == ["deleted"] * 7 + ["gone"] and tree(root, "raw", "parquet", "manifests") == []
    assert done.agg(F.sum("bytes")).first()[0] > 0
    assert jobs.delete_listed(ledger, at("2026-08-31"), 60).count() == 0


def test_a_failed_path_keeps_its_owner(spark, copies):
    fresh, streams, target = copies
    root = fresh("published")
    ledger = Ledger(spark, root)
    outside = ledger.current("captures").filter("capture_id = 'demo-trips-1'").withColumn("sidecar_path", F.lit("raw/../../elsewhere.json"))
    ledger.append("captures", outside, 35)
    found = jobs.clean_up(ledger, streams, target(root), at("2026-08-30"), 40, WEEK, delete=True)
    outcomes = {r["path"]: r["outcome"] for r in found.collect()}
    assert outcomes["raw/../../elsewhere.json"] == "refused" and sorted(set(outcomes.values())) == ["deleted", "refused"]
    live = ledger.current("captures").filter("NOT raw_path LIKE '@retained/%'").collect()
    assert [r["capture_id"] for r in live] == ["demo-trips-1"] and ledger.current("daily_summaries").count() == 0


@pytest.mark.parametrize("path, good", [
    ("raw/source=a/b.pb", True), ("manifests/x", True), ("parquet/x/", True), ("", False), ("/raw/x", False), ("raw", False), ("ledger/captures", False),
    ("raw/../x", False), ("raw/./x", False), ("raw//x", False), ("@retained/a.pb", False)])
def test_paths_that_may_go(path, good):
    assert retention.may_delete(path) is good


def test_numbers_are_one_sequence(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path)).create()
    first = ledger.claim("stream a", 0)
    other = ledger.claim("stream b", 0)
    assert first < other and ledger.claim("stream a", 0) == first and ledger.claim("stream b", 0) == other
    third = ledger.claim("stream a", 1)
    assert third > other and ledger.claim("clean_up", "2026-08-20") > third
    journal.Job(ledger, "compact_due", 500)
    assert ledger.claim("stream b", 1) > 500
    with pytest.raises(ValueError, match="given out"):
        journal.Job(ledger, "publish_round", 70)
    with pytest.raises(ValueError, match="belongs to"):
        journal.Job(ledger, "clean_up", 500)
    names = tree(str(tmp_path), "ledger/numbers")
    assert len(names) == 4  # one for each owner


def test_a_job_first_and_a_stream_later(spark, tmp_path):
    """Revision numbers stay unique over jobs, streams, batches run again and new checkpoints."""
    from transitlake.schemas import CAPTURE
    from transitlake.streaming import registration

    root = str(tmp_path)
    ledger = Ledger(spark, root).create()
    streams = lake.streams(spark, ("demo", "trips", "trip_update", "UTC"))
    target = lake.destinations(spark, ("primary", True, f"file://{root}/out"))
    both = lake.captures_with_bodies(spark, flattened_bodies())
    write_landing(both.filter("capture_id = 'demo-trips-1'"), root)
    jobs.reconcile_lake(ledger, root, at("2026-08-20"), 40)
    jobs.compact_due(ledger, root, B.scan_bodies(spark, root), streams, target, at("2026-08-20"), 50)
    late = both.select(*CAPTURE.names)

    def run(number, checkpoint):
        late.filter(f"capture_id = 'demo-trips-{number}'").coalesce(1).write.mode("append").parquet(f"{root}/in-{checkpoint}")
        arriving = spark.readStream.schema(CAPTURE).parquet(f"{root}/in-{checkpoint}")
        registration.start(arriving, registration.revise_late_days(ledger, at("2026-08-20")), f"{root}/{checkpoint}").awaitTermination()

    run(2, "first")   # batch 0, after numbers 40 and 50
    run(3, "second")  # batch 0 again, of another stream
    rows = ledger.changes("compactions").orderBy("change_seq").collect()
    assert [r["revision"] for r in rows] == [1, 2, 3] and [r["rows"] for r in rows] == [1, 2, 3]
    assert len({r["compaction_id"] for r in rows}) == 3 and [r["change_seq"] for r in rows] == [50, 60, 70]
    # a batch run again, after a job with a higher number, adds nothing
    handle = registration.revise_late_days(ledger, at("2026-08-20"))
    more = late.filter("capture_id = 'demo-trips-1'").withColumn("capture_id", F.lit("demo-trips-9"))
    handle(more, 7)
    jobs.retire_destination(ledger, "nowhere", "test", at("2026-08-21"), 200)
    handle(more, 7)
    assert [r["revision"] for r in ledger.changes("compactions").orderBy("change_seq").collect()] == [1, 2, 3, 4]
    assert dt.datetime(2026, 8, 20) in {r["created_at"] for r in ledger.current("compactions").collect()}
