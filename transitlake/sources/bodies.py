"""The landing area: raw bodies and their sidecars, in hive-partitioned directories."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlake.schemas import CAPTURE
from transitlake.session import located, qualified
from transitlake.sources.arrivals import stream_names
from transitlake.sources.directories import in_hand

BODIES = T.StructType([*[T.StructField(n, T.StringType()) for n in ("source", "stream", "date", "hour", "raw_path")],
                       T.StructField("body_bytes", T.LongType()), T.StructField("body", T.BinaryType())])
_SOURCE, _STREAM, _DATE, _HOUR = r"/source=([^/]+)/", r"/stream=([^/]+)/", r"/date=([^/]+)/", r"/hour=([^/]+)/"

_PARTS = (("source", _SOURCE), ("stream", _STREAM), ("date", _DATE), ("hour", _HOUR))


def _unescaped(value: Column) -> Column:
    """A partition value from a directory's name, as Spark reads it: percent escapes undone, a plus left alone."""
    return F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)


def relative_path(path: Column) -> Column:
    """The part of a file's path below the lake's root."""
    return F.regexp_extract(path, r"/(raw/source=.*)$", 1)


def _with_partitions(files: DataFrame) -> DataFrame:
    path = F.col("path")
    return files.select(
        F.regexp_extract(path, _SOURCE, 1).alias("source"),
        F.regexp_extract(path, _STREAM, 1).alias("stream"),
        F.regexp_extract(path, _DATE, 1).alias("date"),
        F.regexp_extract(path, _HOUR, 1).alias("hour"),
        relative_path(path).alias("raw_path"),
        F.col("length").alias("body_bytes"),
        F.col("content").alias("body"),
    )


def scan_bodies(spark: SparkSession, root: str, days: DataFrame | None = None, in_tasks: bool = False) -> DataFrame:
    """All raw bodies with their partition columns, as text. A filter on source,
    stream, date or hour prunes directories before any file is opened. With ``days``, a stored table
    of stream-days, only their directories are listed. A job over the whole area takes ``in_tasks``:
    files are then listed and opened by tasks, and the driver learns of none; no filter prunes them."""
    if in_tasks:
        opened = listed(spark, f"{root}/raw", ".pb").repartition(_tasks(spark), "path").mapInArrow(_read_files, OPENED)
        path = F.col("path")
        parts = [_unescaped(F.regexp_extract(path, pattern, 1)).alias(name) for name, pattern in _PARTS]
        return _of_any_size(opened.select(*parts, relative_path(path).alias("raw_path"), F.col("length").alias("body_bytes"), F.col("content").alias("body")))
    reader, raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.pb"), f"{root}/raw"
    paths = None if days is None else in_hand(spark, raw, days, {"source": "source_id", "stream": "stream_id", "date": "archive_date"})
    if paths == []:
        return spark.createDataFrame([], BODIES)
    files = reader.load(raw) if paths is None else reader.option("basePath", raw).load(paths)
    return files.select(
        "source", "stream", "date", "hour", relative_path(F.col("path")).alias("raw_path"),
        F.col("length").alias("body_bytes"), F.col("content").alias("body"))


OPENED = T.StructType([T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def _tasks(spark: SparkSession) -> int:
    return 4 * spark.sparkContext.defaultParallelism


# Names passed on in one batch.
LISTED_AT_ONCE = 10_000
ENTRIES = T.StructType([T.StructField("path", T.StringType()), T.StructField("is_file", T.BooleanType())])


def _lister(suffix: str, deep: bool, top: bool = False):
    """The function given to mapInArrow: directories to what lies in them, one level or all files below.

    Hidden and empty files are passed over, as Spark's own scans do. The top must be there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path, is_file in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if is_file:
                    rows.append((path, True))
                    continue
                store, base = located(path)
                waiting = [base]
                while waiting:
                    for info in store.get_file_info(fs.FileSelector(waiting.pop(), allow_not_found=not top)):
                        if info.base_name.startswith((".", "_")):
                            continue
                        if info.type != fs.FileType.Directory:
                            if info.size and info.path.endswith(suffix):
                                rows.append((path + info.path[len(base):], True))
                        elif deep:
                            waiting.append(info.path)
                        else:
                            rows.append((path + info.path[len(base):], False))
                    while len(rows) >= LISTED_AT_ONCE:
                        yield _entries(rows[:LISTED_AT_ONCE])
                        rows = rows[LISTED_AT_ONCE:]
            if rows:
                yield _entries(rows)
    return run


def _entries(rows: list[tuple[str, bool]]) -> pa.RecordBatch:
    paths, files = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(files, pa.bool_())], names=ENTRIES.names)


def listed(spark: SparkSession, raw: str, suffix: str) -> DataFrame:
    """Paths (``path``) of the files below the landing area, found by tasks: level by level down to the days, and what
    lies below a day, or beside its way, with it. Nothing passes through the driver."""
    found = spark.range(1, numPartitions=1).select(F.lit(qualified(spark, raw)).alias("path"), F.lit(False).alias("is_file"))
    for level in range(3):
        found = found.mapInArrow(_lister(suffix, False, top=level == 0), ENTRIES).repartition(_tasks(spark), "path")
    return found.mapInArrow(_lister(suffix, True), ENTRIES).select("path")


def _of_any_size(listing: DataFrame) -> DataFrame:
    """Joins of a listing are sort-merge joins. The optimizer takes it to be as small as the one row it starts from, so it
    would broadcast any number of files through the driver, and adaptive execution does not take a broadcast back."""
    return listing.hint("merge")


def _read_files(batches: Iterator[pa.RecordBatch], arrived: bool = False) -> Iterator[pa.RecordBatch]:
    """``arrived``: the names come from the log of arrivals, so a file may have been deleted since, and is passed over."""
    def passed(rows):
        paths, contents = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(map(len, contents), pa.int64()), pa.array(contents, pa.binary())],
                                          names=OPENED.names)

    for batch in batches:
        held, size = [], 0
        for path in batch.column("path").to_pylist():
            store, place = located(path)
            try:
                with store.open_input_stream(place, compression=None) as stream:
                    held.append((path, stream.read()))
            except FileNotFoundError:
                if not arrived:
                    raise
                continue
            size += len(held[-1][1])
            if size >= OPENED_BYTES:
                yield passed(held)
                held, size = [], 0
        if held:
            yield passed(held)


def _read_arrived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _read_files(batches, arrived=True)


def empty_bodies(sidecars: DataFrame) -> DataFrame:
    """The empty bodies, from their documents: Spark's file scans pass over files of
    zero bytes, so these come from the captures that recorded no byte. Works on a
    stream of sidecars as well."""
    return sidecars.filter(F.col("decoded_length") == 0).select(
        F.col("source_id").alias("source"), F.col("stream_id").alias("stream"), F.col("archive_date").alias("date"),
        F.regexp_extract("raw_path", _HOUR, 1).alias("hour"), "raw_path",
        F.lit(0).cast("bigint").alias("body_bytes"), F.lit(b"").alias("body"))


def list_bodies(spark: SparkSession, root: str, in_tasks: bool = False) -> DataFrame:
    """Paths and sizes only; the content column is pruned, so no body is read. ``in_tasks``, see
    :func:`scan_bodies`, gives paths alone."""
    if in_tasks:
        return _of_any_size(listed(spark, f"{root}/raw", ".pb").select(relative_path(F.col("path")).alias("raw_path")))
    return scan_bodies(spark, root).drop("body")


DOCUMENT = T.StructType([*CAPTURE.fields, T.StructField("_corrupt_record", T.StringType())])


def _parsed(opened: DataFrame) -> DataFrame:
    """Opened documents as rows: ``path`` and the struct ``c``, all of NULL where a document cannot be read."""
    text = F.col("content").cast("string")
    # a document holding a list gives a row for each entry, as Spark's reader does
    several = F.from_json(F.when(F.ltrim(text).startswith("["), text), T.ArrayType(CAPTURE), {"mode": "PERMISSIVE"})
    one = F.from_json(text, DOCUMENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = F.coalesce(F.transform(several, lambda c: F.struct(*[c[n].alias(n) for n in CAPTURE.names], F.lit(None).cast("string").alias("_corrupt_record"))),
                      F.array(one))
    return opened.select("path", F.explode(rows).alias("c"))


def scan_sidecars(spark: SparkSession, root: str, in_tasks: bool = False) -> DataFrame:
    """Capture documents, one JSON file each, with the path they were found at.

    A document that cannot be read keeps its row with ``corrupt`` set. ``in_tasks``: see :func:`scan_bodies`.
    """
    if in_tasks:
        opened = listed(spark, f"{root}/raw", ".json").repartition(_tasks(spark), "path").mapInArrow(_read_files, OPENED)
        return _of_any_size(_parsed(opened).select(
            *[F.col("c")[n].alias(n) for n in CAPTURE.names], relative_path(F.col("path")).alias("found_path"),
            (F.col("c._corrupt_record").isNotNull() | F.col("c.capture_id").isNull()).alias("corrupt")))
    documents = (
        spark.read.schema(DOCUMENT).option("multiLine", "true").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").json(f"{root}/raw")
    )
    return documents.select(
        *CAPTURE.names,
        relative_path(F.col("_metadata.file_path")).alias("found_path"),
        (F.col("_corrupt_record").isNotNull() | F.col("capture_id").isNull()).alias("corrupt"),
    )


def stream_bodies(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Bodies as they arrive, each once, by the log of arrivals: see :mod:`transitlake.sources.arrivals`."""
    return _with_partitions(stream_names(spark, root, ".pb", max_files).mapInArrow(_read_arrived, OPENED))


def stream_sidecars(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Capture documents as they arrive, likewise."""
    opened = stream_names(spark, root, ".json", max_files).mapInArrow(_read_arrived, OPENED)
    return _parsed(opened).select(*[F.col("c")[n].alias(n) for n in CAPTURE.names])


# Bodies opened before a batch of them is passed on.
OPENED_BYTES = 8 << 20


def _opener(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = located(root)
        for batch in batches:
            begin, held, size = 0, [], 0
            for at, (path, length) in enumerate(zip(batch.column("raw_path").to_pylist(), batch.column("decoded_length").to_pylist(), strict=True)):
                held.append(_opened(store, f"{base}/{path}", length))
                size += len(held[-1] or b"")
                if size >= OPENED_BYTES:
                    yield _with_bodies(batch.slice(begin, at + 1 - begin), held)
                    begin, held, size = at + 1, [], 0
            if held:
                yield _with_bodies(batch.slice(begin), held)
    return run


def _opened(store, place: str, length: int | None) -> bytes | None:
    if length == 0:
        return b""
    try:
        with store.open_input_stream(place, compression=None) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


def _with_bodies(rows: pa.RecordBatch, bodies: list[bytes | None]) -> pa.RecordBatch:
    kept = [f.name for f in BODIES.fields[:5]]
    sizes = pa.array([None if b is None else len(b) for b in bodies], pa.int64())
    return pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), sizes, pa.array(bodies, pa.binary())], names=BODIES.names)


def open_arrivals(sidecars: DataFrame, root: str) -> DataFrame:
    """The bodies that documents name, opened by path in tasks. Works on a stream and on a batch alike.

    A poller writes a body first and its document last, so the documents are the log of what arrived: bodies need no listing, and an empty
    one comes with its document. A body that is not there is NULL, as is its size.
    """
    named = sidecars.filter("raw_path IS NOT NULL").select(
        F.col("source_id").alias("source"), F.col("stream_id").alias("stream"), F.col("archive_date").alias("date"),
        F.regexp_extract("raw_path", _HOUR, 1).alias("hour"), "raw_path", "decoded_length")
    return named.mapInArrow(_opener(qualified(sidecars.sparkSession, root)), BODIES)


def stream_arrivals(spark: SparkSession, root: str, max_files: int = 10_000) -> DataFrame:
    """Bodies as they arrive, empty ones included, by the documents that complete them."""
    return open_arrivals(stream_sidecars(spark, root, max_files), root)
