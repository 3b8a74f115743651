"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs to the no-op sink: all rows are computed, none is collected. Before
the clock starts, bodies are encoded from orders and lineitem, and the ledger tables
are derived from events and stored, as a lake keeps them. Each query runs twice and
the faster run counts, so that compiling generated code is not what is measured.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from transitlake import build_session, schemas  # noqa: E402
from transitlake.operators.decode import decode_bodies, header_metadata, validation_flags  # noqa: E402
from transitlake.operators.flatten import flatten_trip_updates, projected_rows, stop_time_updates  # noqa: E402
from transitlake.operators.statistics import DAY  # noqa: E402
from transitlake.plans import compact, reconcile  # noqa: E402
from transitlake.sources import revisions as R  # noqa: E402
import workload.catalog  # noqa: E402, F401  registers the queries
from workload.bindings import Bindings, now  # noqa: E402
from workload.feeds import feed_captures  # noqa: E402
from workload.registry import BUILDERS  # noqa: E402

STORED = ("streams", "ticks", "captures", "inputs", "compactions", "publications", "manifests", "manifest_inputs")

HEADLINE = (
    "decode_flatten_trip_updates", "day_stats", "largest_fetch_gap", "build_manifest", "daily_summary",
    "days_to_compact", "missing_from_latest", "raw_retention_candidates", "verify_manifest_rules",
    "hysteresis", "upsert_ticks", "fetch_seconds_histogram", "body_hash_and_length", "publication_work",
)


class StoredLedger(Bindings):
    """The ledger tables read from disk instead of derived from events."""

    def store(self, work: str) -> "StoredLedger":
        source = Bindings(self.spark, self.dir)
        for name in STORED:
            table = R.materialize(getattr(source, name)(), work, name)
            setattr(self, name, lambda table=table: table)
        return self


def compacted(spark, root: str, bronze, b: Bindings):
    """The whole compaction of the orders' days: decode, flatten, write, check, manifests."""
    captures = bronze.drop("body").withColumn("entity_count", F.lit(100))
    days = captures.select(*DAY).distinct().withColumn("revision", F.lit(1))
    ticks = reconcile.ticks_of(captures).join(captures.select("tick_id", "archive_date"), "tick_id")
    streams = captures.groupBy("source_id", "stream_id", "expected_kind", "timezone").agg(F.first("sanitized_url").alias("url")).withColumns(
        {n: F.lit("") for n in ("registry_id", "license_url", "attribution")})
    result = compact.compact_days(spark, root, captures, ticks, bronze.select("raw_path", "body"), streams, days, b.destinations(), now())
    return result.manifests


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    b = Bindings(spark, sf_dir)
    work = tempfile.mkdtemp(prefix="bench-")
    timings: dict[str, float] = {}

    def timed(name, build):
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        timings[name] = round(min(runs), 3)

    captured = feed_captures(b).withColumns({
        "parse_status": F.lit("valid"), "validation_flags": F.array().cast("array<string>")})
    # as many files as cores, as a bronze table would have
    bronze = R.materialize(captured.repartition(int(cpus), "capture_id"), work, "bronze")
    stops = b.table("lineitem").count()
    decode_bodies(bronze.limit(8), wanted=schemas.TRIP_UPDATE_MESSAGE).write.format("noop").mode("overwrite").save()

    def flat():
        return flatten_trip_updates(decode_bodies(bronze, wanted=schemas.TRIP_UPDATE_MESSAGE, keep_body=False))

    timed("flatten_bodies", flat)
    timed("nested_bodies", lambda: decode_bodies(bronze, wanted=schemas.FEED_MESSAGE))
    timed("flag_bodies", lambda: validation_flags(header_metadata(
        decode_bodies(bronze, wanted=schemas.ENTITY_KIND_MESSAGE, keep_body=False))))
    timed("count_bodies", lambda: decode_bodies(bronze, wanted=schemas.TRIP_UPDATE_MESSAGE, keep_body=False)
          .select(projected_rows(), stop_time_updates()))
    timed("compact_days", lambda: compacted(spark, tempfile.mkdtemp(dir=work), bronze, b))
    stored = StoredLedger(spark, sf_dir).store(work)
    for name in HEADLINE:
        timed(name, lambda name=name: BUILDERS[name](stored))

    print(json.dumps({
        "metric": "total of headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")),
        "flattened_rows_per_sec": round(stops / timings["flatten_bodies"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
