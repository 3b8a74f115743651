"""Session settings the library relies on, and where it may put scratch data."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan here assumes. Instants are compared in UTC, and Arrow batches
# are bounded by rows and by bytes, because one body may be 32 MiB: a Python worker holds
# a batch several times over.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.openCostInBytes": str(1 << 20),
    # partition values stay text: hour 09 must not become 9, nor a source 007 become 7
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # a stream's log of files seen is rewritten whole every so many batches: less often than Spark's ten
    "spark.sql.streaming.fileSource.log.compactInterval": "100",
    # no stack trace per column expression: plans here have thousands of them
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# What adaptive execution gives to one task at most of a shuffle. The rows take ten times these bytes in the task's
# sorts. A session that asks for less keeps it.
_ADVISORY, ADVISORY_MB = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 32
# Directories, and the files of a stream's batch, are listed by a few tasks with many each: a task for every one of them
# costs more than its listing.
_LISTING, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 64


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    for key, value in SESSION_CONF.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if (spark.conf.get(_ADVISORY, None) or "64MB").upper().rstrip("B") in ("64M", "67108864"):  # Spark's own value
        spark.conf.set(_ADVISORY, f"{ADVISORY_MB}m")
    spark.conf.set(_LISTING, str(min(LISTING_TASKS, 2 * spark.sparkContext.defaultParallelism)))
    return spark


# How streams write their logs. Spark's own way goes through Hadoop's FileContext, which on a local disk starts a process
# (chmod, readlink) several times for each file, and a batch writes four. Through FileSystem it starts one or none; temporary files and
# renames are the same, and a file that is there is not overwritten.
_LOGS, FILE_SYSTEM_LOGS = "spark.sql.streaming.checkpointFileManagerClass", \
    "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"


def light_logs(spark: SparkSession, checkpoint: str) -> None:
    """Streams started next write their logs without processes of their own, if ``checkpoint`` is on a local disk."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None and qualified(spark, checkpoint).startswith("file:") and spark.conf.get(_LOGS, None) is None \
            and jvm.org.apache.spark.util.Utils.classIsLoadable(FILE_SYSTEM_LOGS):
        spark.conf.set(_LOGS, FILE_SYSTEM_LOGS)
    elif spark.conf.get(_LOGS, None) == FILE_SYSTEM_LOGS and not qualified(spark, checkpoint).startswith("file:"):
        spark.conf.unset(_LOGS)


@contextmanager
def split_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Within this block tasks read at most about ``size`` bytes of stored files, where Spark's 128 MB would be more."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(app: str = "transitlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new directory under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master with nothing configured.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = os.path.join(tempfile.gettempdir(), "transitlake-scratch")
    return f"{qualified(spark, base).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def located(path: str):
    """The file system and the place in it of a path as Spark writes it: with a scheme, and nothing escaped.

    A URI's parser would refuse blanks and turn the ``%3A`` in a directory's name into a colon.
    """
    from pyarrow import fs

    parts = re.fullmatch(r"(?s)([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", path)
    if parts is None:
        return fs.FileSystem.from_uri(path)
    scheme, authority, place = parts.groups()
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority or ''}/")
    return store, base.rstrip("/") + place


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, so that tasks outside the JVM mean the same one."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None or "://" in path:
        return path
    target = jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(target).toString()
