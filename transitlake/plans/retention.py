"""Retention: what may be dropped, and what remains of it.

The candidates are tables, :func:`files_to_remove` lists their paths, and :func:`delete_paths` deletes
listed paths where that is asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.operators import ledger as L
from transitlake.operators.statistics import DAY
from transitlake.session import located


@dataclass(frozen=True)
class RetentionPolicy:
    raw_s: int = K.RAW_RETENTION_S
    parquet_s: int = K.PARQUET_RETENTION_S
    metadata_s: int = K.METADATA_RETENTION_S
    local_only_cleanup: bool = False


def cutoff(now: Column, seconds: int) -> Column:
    return F.timestamp_micros(F.unix_micros(now) - seconds * 1000000)


def _all_published_before(limit: Column) -> Column:
    unpublished = F.count_if(F.col("published_at").isNull())
    return (unpublished == 0) & (F.max("published_at") <= limit)


def raw_candidates(captures: DataFrame, inputs: DataFrame, compactions: DataFrame, limit: Column) -> DataFrame:
    """Live captures all of whose revisions are published, the newest not after the limit."""
    revisions = inputs.join(compactions.select("compaction_id", "published_at"), "compaction_id")
    released = (
        revisions.groupBy("capture_id").agg(_all_published_before(limit).alias("_released"))
        .filter("_released").select("capture_id")
    )
    live = L.live_captures(captures)
    return live.join(released, "capture_id", "left_semi")


def dataset_candidates(compactions: DataFrame, limit: Column) -> DataFrame:
    return compactions.filter(
        F.col("published_at").isNotNull() & (F.col("published_at") <= limit) & (F.col("manifest_path") != "")
    )


def summary_candidates(compactions: DataFrame, summaries: DataFrame, captures: DataFrame,
                       streams: DataFrame, limit: Column) -> DataFrame:
    """Stream-days fully published, of a configured stream, without live bodies."""
    published = (
        compactions.groupBy(*DAY).agg(_all_published_before(limit).alias("_released"))
        .filter("_released").drop("_released")
    )
    configured = published.join(streams.select("source_id", "stream_id"), ["source_id", "stream_id"], "left_semi")
    alive = L.live_captures(captures).select(*DAY).distinct()
    return L.without_summary(configured, summaries).join(alive, list(DAY), "left_anti")


def mark_captures_retained(captures: DataFrame) -> DataFrame:
    """Change rows that put the sentinel in place of both paths."""
    stem = F.concat(F.lit(K.RETAINED_PREFIX), F.col("capture_id"))
    return captures.withColumns({
        "raw_path": F.concat(stem, F.lit(".pb")), "sidecar_path": F.concat(stem, F.lit(".json")),
    })


def mark_datasets_retained(compactions: DataFrame) -> DataFrame:
    return compactions.withColumns({
        "data_path": F.lit(""), "manifest_path": F.lit(""), "data_bytes": F.lit(0).cast("bigint"),
    })


def expire_optional(publications: DataFrame, retained: DataFrame) -> DataFrame:
    """Change rows for unfinished optional publications of retained revisions."""
    open_optional = publications.filter(~F.col("required") & (F.col("status") != "verified"))
    touched = open_optional.join(retained.select("compaction_id"), "compaction_id", "left_semi")
    return touched.withColumns({
        "status": F.lit("expired"), "last_error": F.lit("local_retention_elapsed"),
    }).select(*publications.columns)


def drop_days(table: DataFrame, days: DataFrame) -> DataFrame:
    """What stays of a detail table once ``days`` are summarised."""
    return table.join(days.select(*DAY), list(DAY), "left_anti")


def may_clean(destinations: DataFrame, policy: RetentionPolicy) -> Column:
    """Nothing is dropped before it is kept elsewhere, unless local cleanup is allowed."""
    required = destinations.agg(F.count_if("required") > 0).scalar()
    return F.lit(policy.local_only_cleanup) | required


def retention_report(captures: DataFrame, inputs: DataFrame, compactions: DataFrame, summaries: DataFrame,
                     streams: DataFrame, destinations: DataFrame, now: Column,
                     policy: RetentionPolicy | None = None) -> DataFrame:
    """One row: files, days and bytes a cleanup would release now.

    Bodies dropped by this cleanup count as gone when its days are looked at.
    """
    policy = policy or RetentionPolicy()
    gate = may_clean(destinations, policy)
    raw = raw_candidates(captures, inputs, compactions, cutoff(now, policy.raw_s)).filter(gate)
    data = dataset_candidates(compactions, cutoff(now, policy.parquet_s)).filter(gate)
    kept = captures.join(raw.select("capture_id"), "capture_id", "left_anti")
    days = summary_candidates(compactions, summaries, kept, streams, cutoff(now, policy.metadata_s)).filter(gate)
    parts = [
        raw.agg(F.count(F.lit(2)).alias("raw_captures"),
                F.coalesce(F.sum("decoded_length"), F.lit(0)).alias("raw_bytes")),
        data.agg(F.count(F.lit(1)).alias("datasets"), F.count_if(F.col("data_path") != "").alias("data_files"),
                 F.coalesce(F.sum("data_bytes"), F.lit(0)).alias("data_bytes")),
        days.agg(F.count(F.lit(1)).alias("summarized_days")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union.agg(*[F.max(name).alias(name) for name in union.columns])


def files_to_remove(captures: DataFrame, datasets: DataFrame) -> DataFrame:
    """The relative paths a cleanup would delete, two per capture and two per dataset, with what owns them."""
    raw = captures.select(F.explode(F.array("raw_path", "sidecar_path")).alias("path"), F.lit("capture").alias("kind"),
                          F.col("capture_id").alias("owner"))
    data = datasets.select(F.explode(F.array("data_path", "manifest_path")).alias("path"), F.lit("dataset").alias("kind"),
                           F.col("compaction_id").cast("string").alias("owner"))
    return raw.unionByName(data).filter("path <> ''")


# Outcomes of a deletion. A path that is already gone is as good as deleted.
GONE = ("deleted", "gone")
OUTCOME = "path string, kind string, owner string, outcome string, bytes bigint"
_TREES = ("raw/", "parquet/", "manifests/")


def may_delete(path: str) -> bool:
    """Only paths within the lake's trees: relative, and without a step upwards."""
    return path.startswith(_TREES) and not {"", ".", ".."} & set(path.rstrip("/").split("/"))


def _delete_one(store, base: str, path: str) -> tuple[str, int]:
    from pyarrow import fs

    if not may_delete(path):
        return "refused", 0
    place = f"{base}/{path}"
    info = store.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        return "gone", 0
    if info.type == fs.FileType.File:
        store.delete_file(place)
        return "deleted", info.size
    # a dataset of several parts is a directory; a revision's directory holds nothing else
    files = store.get_file_info(fs.FileSelector(place, recursive=True))
    store.delete_dir(place)
    return "deleted", sum(f.size for f in files if f.type == fs.FileType.File)


def _deleter(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = located(root)
        for batch in batches:
            outcomes, sizes = [], []
            for path in batch.column("path").to_pylist():
                try:
                    outcome, size = _delete_one(store, base, path)
                except FileNotFoundError:  # another attempt of this task was faster
                    outcome, size = "gone", 0
                except OSError:
                    outcome, size = "failed", 0
                outcomes.append(outcome)
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("path", "kind", "owner")), pa.array(outcomes), pa.array(sizes, pa.int64())],
                names=["path", "kind", "owner", "outcome", "bytes"])
    return run


def delete_paths(paths: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Delete (path, kind, owner) below ``root``, a URI; one row with the outcome for each path.

    The paths are spread over tasks, whoever owns them. Doing it twice is harmless: what is gone counts as
    deleted. ``refused`` are paths outside the lake's trees, ``failed`` those the store would not delete.
    The result must be written before it is used, as each use deletes again.
    """
    spark = paths.sparkSession
    spread = paths.select("path", "kind", "owner").repartition(tasks or 4 * spark.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(_deleter(root), OUTCOME)


def fully_gone(outcomes: DataFrame) -> DataFrame:
    """Owners (kind, owner) all of whose listed paths are gone."""
    left = F.count_if(~F.col("outcome").isin(*GONE))
    return outcomes.groupBy("kind", "owner").agg(left.alias("_left")).filter("_left = 0").select("kind", "owner")
