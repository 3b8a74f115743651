"""What one task and one Python worker take at a time is bounded, and a session that asks for less keeps it."""

from pyspark.sql import functions as F

from transitlake import session
from transitlake.operators import wire

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_a_task_takes_less_of_a_shuffle_than_by_default(spark):
    before = spark.conf.get(ADVISORY, None)
    try:
        spark.conf.unset(ADVISORY)
        assert session.configure(spark).conf.get(ADVISORY) == "32m"
        spark.conf.set(ADVISORY, "8m")
        assert session.configure(spark).conf.get(ADVISORY) == "8m"
    finally:
        spark.conf.unset(ADVISORY) if before is None else spark.conf.set(ADVISORY, before)


def test_arrow_batches_are_bounded_by_bytes(spark):
    session.configure(spark)
    assert wire.BATCH_BODY_BYTES == 1 << 20

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["bytes"])

    large = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    found = [r["bytes"] for r in large.mapInArrow(sizes, "bytes bigint").collect()]
    assert len(found) > 2 and max(found) <= 10 << 20 and sum(found) >= 40 << 20
