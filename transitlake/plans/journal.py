"""Jobs that can be run again: an intent for each job, steps that are done once.

A job runs under a change number of the ledger. Its intent, ``ledger/jobs/active/seq=N``, names the steps
that are finished; a job run again under the same number reads it first. Tables between steps lie
in ``work/<job>-<number>/<step>``, are read back where the step is finished and written anew where it is
not, and go when the job ends. Three rules make the repeated run end like an undisturbed one:

* state is read as it was before the job's number (:meth:`Job.current`), so what the first
  attempt appended does not change what the second one decides;
* an append that may have happened leaves out the rows that are there under the number;
* what a job does outside the ledger (copies, deletions) can be done twice.

When a job ends, its intent makes way for ``ledger/jobs/finished/job=<name>``, one row with the job's last number.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.schemas import LEDGER
from transitlake.session import located, qualified
from transitlake.sources.ledger import KEYS, Ledger

STEPS = "job string, step string, seq bigint"
FINISHED = "seq bigint, job string"


class Job:
    """One run of the job ``name`` under the change number ``seq``."""

    def __init__(self, ledger: Ledger, name: str, seq: int) -> None:
        self.ledger, self.spark, self.name, self.seq = ledger, ledger.spark, name, seq
        self.scratch = f"{ledger.root}/work/{name}-{seq}"
        last = _read(ledger, "finished", FINISHED).filter(F.col("job") == name).agg(F.max("seq")).first()[0]
        self.finished = last is not None and seq <= last
        rows = _read(ledger, "active", STEPS).filter(F.col("seq") == seq).collect()  # a handful: one job's steps
        if any(r["job"] != name for r in rows):
            raise ValueError(f"change number {seq} belongs to {rows[0]['job']}")
        self.done = {r["step"] for r in rows}
        self.repeated = bool(rows)
        if not self.repeated and not self.finished:
            ledger.take(name, seq)
            if last is not None:
                remove_tree(ledger, f"{ledger.root}/work/{name}-{last}")
            self.note("begin")

    def note(self, step: str) -> None:
        """Record a finished step."""
        row = self.spark.range(0, 1, 1, 1).select(F.lit(self.name).alias("job"), F.lit(step).alias("step"))
        row.write.mode("append").parquet(f"{_path(self.ledger, 'active')}/seq={self.seq}")
        self.done.add(step)

    def current(self, table: str, days: DataFrame | None = None) -> DataFrame:
        """A ledger table as it was before this job."""
        return self.ledger.current(table, days, before=self.seq)

    def table(self, step: str, rows: DataFrame) -> DataFrame:
        """The rows of a step, computed in the first run that gets to its end."""
        path = f"{self.scratch}/{step}"
        if step not in self.done:
            rows.write.mode("overwrite").parquet(path)
            if not self.finished:
                self.note(step)
        return self.spark.read.schema(rows.schema).parquet(path)

    def append(self, table: str, rows: DataFrame, removed: bool = False, after: int = 0) -> None:
        """Append change rows under the number, or ``after`` numbers later, once."""
        step = f"append-{table}-{after}" + ("-removed" if removed else "")
        if step in self.done:
            return
        number = self.seq + after
        if self.repeated:
            # without a key, all but the time tells rows apart
            keys = list(KEYS[table]) or [c for c in LEDGER[table].names if c != "created_at"]
            there = self.ledger.changes(table).filter((F.col("change_seq") == number) & (F.col("removed") == F.lit(removed)))
            rows = rows.join(there.select(*keys), keys, "left_anti")
        self.ledger.append(table, rows, number, removed)
        self.note(step)

    def appended(self, table: str, after: int = 0) -> DataFrame:
        """What this job appended to a table."""
        number = F.col("change_seq") == self.seq + after
        return self.ledger.changes(table).filter(number).select(*LEDGER[table].names)

    def end(self, clear: bool = True) -> None:
        """Take note that the job is finished, then clear away its intent and its scratch tables. Without
        ``clear`` these stay, for the job's result, until the job runs next."""
        row = self.spark.range(0, 1, 1, 1).select(F.lit(self.seq).cast("bigint").alias("seq"))
        row.write.mode("overwrite").parquet(f"{_path(self.ledger, 'finished')}/job={self.name}")
        self.finished = True
        remove_tree(self.ledger, f"{_path(self.ledger, 'active')}/seq={self.seq}")
        if clear:
            remove_tree(self.ledger, self.scratch)


def unfinished(ledger: Ledger, name: str, before: int) -> list[int]:
    """Numbers below ``before`` of runs of a job that were given up; there are few, as a run is repeated or given up."""
    rows = _read(ledger, "active", STEPS).filter((F.col("job") == name) & (F.col("seq") < before)).select("seq").distinct().collect()
    return sorted(r["seq"] for r in rows)


def give_up(ledger: Ledger, name: str, seq: int) -> None:
    """Clear away the intent and scratch tables of a run that another one has made good."""
    remove_tree(ledger, f"{_path(ledger, 'active')}/seq={seq}")
    remove_tree(ledger, f"{ledger.root}/work/{name}-{seq}")


def remove_tree(ledger: Ledger, path: str) -> None:
    """Remove a directory; one that is not there is fine."""
    from pyarrow import fs

    store, place = located(qualified(ledger.spark, path))
    if store.get_file_info(place).type == fs.FileType.Directory:
        store.delete_dir(place)


def _path(ledger: Ledger, part: str) -> str:
    return f"{ledger.root}/ledger/jobs/{part}"


def _read(ledger: Ledger, part: str, schema: str) -> DataFrame:
    try:
        return ledger.spark.read.schema(schema).parquet(_path(ledger, part))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return ledger.spark.createDataFrame([], schema)
