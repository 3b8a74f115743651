"""The log of arrivals: names of a landing area's files, each noted once, for streams to read.

A stream over the files themselves keeps every name on the driver and goes through all of them for each batch. Here tasks
list the area, leave out the names the log has, and write the others in parts of a few names; a stream reads
parts, so the driver knows of parts alone. A log lies in ``arrivals/<kind>`` below the lake's root:

* ``names/round=N`` holds the parts of one round of listing. A stream reads these;
* ``_rounds/N`` names the attempt whose parts these are. It is made exclusively when they are written, so
  of two listings at the same time one counts, and the other one lists again;
* ``_written/<attempt>`` holds the parts until then; a round that was not moved to its place is moved by the next listing;
* ``_part_size`` has the most names of a part, for as long as the log lasts.
"""

from __future__ import annotations

import threading
import time
import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.session import qualified

# Names in a part at most: fewer make more files of the log, at 20 ms each here, and more leave fewer tasks to open a small batch.
NAMES = 50
NAME = "path string"
# A file that is made exclusively has its text an instant later. One that has none after this was never finished.
TEXT_S = 10.0


class ArrivalLog:
    """The log of one kind of file (``suffix``) below a lake's root."""

    def __init__(self, spark: SparkSession, root: str, suffix: str, part_size: int = NAMES) -> None:
        self.spark, self.raw, self.suffix = spark, f"{root}/raw", suffix
        self.path = f"{qualified(spark, root).rstrip('/')}/arrivals/{suffix.strip('.')}"
        self.names = f"{self.path}/names"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in (self.names, f"{self.path}/_rounds"):
            self._store.mkdirs(self._path(folder))
        size = f"{self.path}/_part_size"
        self._make(size, str(min(part_size, NAMES)))
        self.part_size = int(self._text(size) or NAMES)

    def note(self) -> None:
        """List the area and note the files that the log does not have."""
        from transitlake.sources.bodies import listed

        while True:
            last = self._settle()
            found = listed(self.spark, self.raw, self.suffix)
            if last:
                # a listing looks as small as the row it starts from: never broadcast it
                found = found.hint("merge").join(self.noted(), "path", "left_anti")
            attempt = uuid.uuid4().hex
            written = f"{self.path}/_written/{attempt}"
            # files of one day are noted together: a batch then has few days
            dealt = found.withColumn("_day", F.regexp_replace("path", r"/[^/]*/[^/]*$", "")).hint("rebalance", F.col("_day"))
            dealt.sortWithinPartitions("path").drop("_day").write.option("maxRecordsPerFile", self.part_size).json(written)
            if self.spark.read.schema(NAME).json(written).isEmpty():
                self._store.delete(self._path(written), True)
                return
            if self._make(f"{self.path}/_rounds/{last + 1:019d}", attempt):
                self._settle()
                return
            self._store.delete(self._path(written), True)

    def noted(self) -> DataFrame:
        """Every name of the log."""
        return self.spark.read.schema(NAME).option("recursiveFileLookup", "true").json(self.names)

    def stream(self, max_files: int) -> DataFrame:
        """Names as they are noted, at most ``max_files`` of them in a batch."""
        if max_files < self.part_size:
            raise ValueError(f"{self.path} has parts of {self.part_size} names; a batch cannot have {max_files}")
        return (
            self.spark.readStream.schema(NAME).option("recursiveFileLookup", "true")
            .option("maxFilesPerTrigger", max_files // self.part_size).json(self.names)
        )

    def _settle(self) -> int:
        """Move the parts of every finished round to their place; returns the number of the last round."""
        rounds = sorted(s.getPath().getName() for s in self._store.listStatus(self._path(f"{self.path}/_rounds"))
                        if s.getPath().getName().isdigit())
        placed = {s.getPath().getName() for s in self._store.listStatus(self._path(self.names))}
        for number in rounds:
            attempt = None if f"round={number}" in placed else self._text(f"{self.path}/_rounds/{number}")
            if attempt:  # another listing may move it at the same time: one of the two finds nothing to move
                self._store.rename(self._path(f"{self.path}/_written/{attempt}"), self._path(f"{self.names}/round={number}"))
        return int(rounds[-1]) if rounds else 0

    def _make(self, place: str, text: str) -> bool:
        """Make a file; False if it is there."""
        try:
            out = self._store.create(self._path(place), False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName() and "already exists" not in str(error.java_exception.getMessage()):
                raise
            return False
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, place: str) -> str:
        until = time.monotonic() + TEXT_S
        while True:
            stream = self._store.open(self._path(place))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text or time.monotonic() > until:
                return text
            time.sleep(0.05)


# Seconds between two looks for streams with nothing left to read.
LOOK_S = 10.0
_FOLLOWED: dict[SparkSession, dict[str, ArrivalLog]] = {}


def _follow(log: ArrivalLog) -> None:
    """From now on the area is listed again whenever a running stream has read all of the log, for streams that go on."""
    begun = log.spark in _FOLLOWED
    logs = _FOLLOWED.setdefault(log.spark, {})
    logs[log.names] = log
    if not begun:
        threading.Thread(target=_look, args=(log.spark, logs), daemon=True).start()


def _look(spark: SparkSession, logs: dict[str, ArrivalLog]) -> None:
    while True:
        time.sleep(LOOK_S)
        if spark.sparkContext._jsc is None:  # stopped
            _FOLLOWED.pop(spark, None)
            return
        try:
            for query in spark.streams.active:
                status, last = query.status, query.lastProgress
                if not status["isDataAvailable"] and not status["isTriggerActive"]:
                    read = " ".join(s["description"] for s in last["sources"]) if last else None
                    for log in list(logs.values()):
                        if read is None or log.names in read:  # a stream without any batch yet does not say what it reads
                            log.note()
        except Exception as error:
            if spark.sparkContext._jsc is not None:
                warnings.warn(f"arrivals were not listed: {error}", stacklevel=1)


def stream_names(spark: SparkSession, root: str, suffix: str, max_files: int) -> DataFrame:
    """Names (``path``) of files as they arrive. What is there now is noted now, later files whenever the stream is idle."""
    log = ArrivalLog(spark, root, suffix, max_files)
    names = log.stream(max_files)
    log.note()
    _follow(log)
    return names
