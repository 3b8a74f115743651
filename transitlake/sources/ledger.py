"""Ledger tables: Parquet directories with fixed schemas, appended to, never edited.

A changed row is appended with a higher ``change_seq``; the current state of a table
is the last change of each key. A removed row is appended with ``removed`` set.

Change numbers come from one sequence for jobs and streams (:meth:`Ledger.claim`): each number is a file of
its own, made exclusively, so no two owners get the same one, and later ones are higher,
whoever asks. An owner that asks again, as a stream's batch does after a failure, gets
its number back.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.operators.ledger import latest_by, upsert_ticks
from transitlake.schemas import LEDGER
from transitlake.session import qualified

KEYS: dict[str, tuple[str, ...]] = {
    "ticks": ("tick_id",),
    "captures": ("capture_id",),
    "compactions": ("compaction_id",),
    "compaction_inputs": ("compaction_id", "capture_id"),
    "revision_digests": ("compaction_id",),
    "publications": ("publication_id",),
    "audit": (),
    "daily_summaries": ("source_id", "stream_id", "archive_date"),
    "deletions": ("path",),
}
# Tables of captures and revisions lie in one directory per archive date, so that work
# on a few days reads those days only.
PARTITIONED = {"captures": ["archive_date"], "compactions": ["archive_date"], "daily_summaries": ["archive_date"],
               "revision_digests": ["archive_date"]}
# A job may use the numbers up to the next multiple, for changes that come after its others.
STRIDE = 10
_CHANGE = [T.StructField("change_seq", T.LongType()), T.StructField("removed", T.BooleanType())]


class Ledger:
    """The ledger tables below one directory."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/ledger/{table}"

    def changes(self, table: str, days: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """All change rows, or those of the archive dates in ``days``, or with numbers below ``before``."""
        schema = T.StructType([*LEDGER[table].fields, *_CHANGE])
        try:
            rows = self.spark.read.schema(schema).parquet(self.path(table)).select(*schema.names)
        except AnalysisException as error:  # a table of a later version, or one nothing was appended to
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], schema)
        if before is not None:
            rows = rows.filter(F.col("change_seq") < before)
        if days is None:
            return rows
        # the comparison makes the list selective in the optimizer's eyes: it prunes directories
        dates = days.select("archive_date").filter("archive_date > ''").distinct()
        return rows.join(dates, "archive_date", "left_semi").select(*schema.names)

    def append(self, table: str, rows: DataFrame, seq: int | Column, removed: bool = False) -> None:
        """Append change rows under one sequence number, given by the single writer."""
        fields = LEDGER[table].fields
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]
        number = F.lit(seq) if isinstance(seq, int) else seq
        changed = rows.select(*columns, number.cast("bigint").alias("change_seq"), F.lit(removed).alias("removed"))
        self._write(table, changed)

    def _write(self, table: str, changed: DataFrame) -> None:
        partitions = PARTITIONED.get(table, [])
        if partitions:
            # one task per directory, or more where a directory's share is large
            changed = changed.hint("rebalance", *[F.col(c) for c in partitions])
        changed.write.mode("append").partitionBy(*partitions).parquet(self.path(table))

    def create(self) -> Ledger:
        """Make every table exist, empty."""
        for table, schema in LEDGER.items():
            empty = self.spark.createDataFrame([], T.StructType([*schema.fields, *_CHANGE]))
            empty.write.mode("append").parquet(self.path(table))  # no row, so no directory of a date
        return self

    def current(self, table: str, days: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The present state, or that before a number: a tick keeps its identity, other rows their last change."""
        changes, keys = self.changes(table, days, before), KEYS[table]
        names = LEDGER[table].names
        if not keys:
            return changes.select(*names)
        if table == "ticks":
            kept = upsert_ticks(changes)
        else:
            kept = latest_by(changes, keys, "change_seq")
        return kept.filter(~F.col("removed")).select(*names)

    def claim(self, owner: str, run: int | str) -> int:
        """The change number of an owner's run: a new one, higher than all before, or the one it has.

        An owner has one run at a time: with a new run, the owner's earlier numbers are forgotten, so
        there are about as many files as owners.
        """
        store, folder = self._numbers()
        name = f"{owner}\n{run}"
        while True:
            taken = self._taken(store, folder)
            mine = [n for n, o in taken.items() if o == name]
            if mine:
                return mine[0]
            number = (max(taken, default=0) // STRIDE + 1) * STRIDE
            if self._make(store, folder, number, name):
                self._forget(store, folder, taken, owner)
                return number

    def take(self, owner: str, number: int) -> None:
        """Use a number of one's own choice; it must be claimed, or higher than all given so far."""
        store, folder = self._numbers()
        taken = self._taken(store, folder)
        if number in taken:
            return
        if number < max(taken, default=0):
            raise ValueError(f"change number {number} is below {max(taken)}, which was given out")
        if not self._make(store, folder, number, f"{owner}\n{number}"):
            raise ValueError(f"change number {number} was given out just now")
        self._forget(store, folder, taken, owner)

    def _taken(self, store, folder) -> dict[int, str]:
        taken = {}
        for status in store.listStatus(folder):
            owner = self._owner_of(store, status.getPath())
            if owner is not None:
                taken[int(status.getPath().getName())] = owner
        return taken

    def _forget(self, store, folder, taken: dict[int, str], owner: str) -> None:
        for old in [n for n, o in taken.items() if o.split("\n")[0] == owner]:
            store.delete(self._place(folder, old), False)

    def _numbers(self):
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(qualified(self.spark, f"{self.root}/ledger/numbers"))
        store = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        store.mkdirs(folder)
        return store, folder

    def _place(self, folder, number: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:019d}")

    def _make(self, store, folder, number: int, owner: str) -> bool:
        """Make a number's file; False if another owner was first."""
        try:
            out = store.create(self._place(folder, number), False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName() and "already exists" not in str(error.java_exception.getMessage()):
                raise
            return False
        out.write(bytearray(owner.encode()))
        out.close()
        return True

    def _owner_of(self, store, path) -> str | None:
        """Who has a number; None for other files, and for one that was just removed."""
        if not path.getName().isdigit():
            return None
        try:
            stream = store.open(path)
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
            return None
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
