"""Verify revisions: every rule is one boolean column, every violation one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake import constants as K
from transitlake.functions.bodies import words
from transitlake.operators.ledger import REVISION
from transitlake.sources import revisions as R
from transitlake.sources.footers import footer_violations, scan_footers


def expected_artifact_rows() -> Column:
    """Rows the artifacts of a manifest must add up to; NULL when it names none."""
    flattened = F.col("schema_version") == K.SCHEMA_FLATTENED
    return F.when(flattened, F.col("stop_time_update_total")).otherwise(F.col("captured_responses"))


def missing_or(broken: Column) -> Column:
    """A rule over required fields: one that is missing breaks it."""
    return F.coalesce(broken, F.lit(True))


def manifest_rules(input_count: Column, file_count: Column) -> dict[str, Column]:
    """Rules over a manifest joined with its ledger row (``ledger_*`` columns)."""
    c = F.col
    ids = F.transform("destinations", lambda d: d["id"])
    required = F.transform(F.filter("destinations", lambda d: d["required"]), lambda d: d["id"])
    listed = F.coalesce("required_destinations", F.array().cast("array<string>"))
    has_destinations = F.coalesce(F.size("destinations") > 0, F.lit(False))
    flattened = c("schema_version") == K.SCHEMA_FLATTENED
    in_ledger = c("ledger_known").isNotNull()
    may_lack_parts = F.coalesce(flattened & (c("stop_time_update_total") == 0), F.lit(False))
    return {
        "format_version": missing_or(c("manifest_version") != K.MANIFEST_FORMAT_VERSION)
        | missing_or(c("format_version") != K.PARQUET_FORMAT_VERSION),
        "schema_version": missing_or(~c("schema_version").isin(*K.SUPPORTED_SCHEMA_VERSIONS)),
        "identity": ~in_ledger,
        "aggregate_counts": missing_or(input_count != c("captured_responses")) | c("entity_total").isNull()
        | (in_ledger & (missing_or(c("captured_responses") != c("ledger_rows"))
                        | missing_or(c("entity_total") != c("ledger_entities")))),
        # captures that all flatten to nothing leave a day without parts
        "ready_shape": (c("dataset_status") == "ready") & ((c("captured_responses") <= 0) | ((file_count < 1) & ~may_lack_parts)),
        "empty_shape": (c("dataset_status") == "no_captured_responses")
        & ((c("captured_responses") != 0) | (file_count != 0)),
        "dataset_status": missing_or(~c("dataset_status").isin(*K.DATASET_STATUSES)),
        "destination_ids": has_destinations
        & (F.exists(ids, lambda i: i == "") | (F.size(F.array_distinct(ids)) != F.size(ids))),
        "destination_snapshot": has_destinations & (F.array_sort(required) != F.array_sort(listed)),
        "flattened_kind": flattened & missing_or(c("expected_kind") != "trip_update"),
        "flattened_total": flattened & (c("expected_kind") == "trip_update") & c("stop_time_update_total").isNull(),
    }


def _as_violations(df: DataFrame, rules: dict[str, Column], keys: tuple[str, ...]) -> DataFrame:
    broken = words(*[F.when(test, F.lit(name)) for name, test in rules.items()])
    return df.select(*keys, F.explode(broken).alias("violation"))


def manifest_violations(manifests: DataFrame, compactions: DataFrame, inputs: DataFrame,
                        files: DataFrame) -> DataFrame:
    """Violations that follow from documents, ledger and long tables alone."""
    keys = list(REVISION)
    ledger = compactions.select(*keys, F.col("rows").alias("ledger_rows"), F.col("entities").alias("ledger_entities"),
                                F.lit(True).alias("ledger_known"))
    counted = inputs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_inputs"))
    parts = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("_files"))
    joined = manifests.join(ledger, keys, "left").join(counted, keys, "left").join(parts, keys, "left")
    zero = F.lit(0).cast("bigint")
    rules = manifest_rules(F.coalesce("_inputs", zero), F.coalesce("_files", zero))
    return _as_violations(joined, rules, REVISION)


def file_violations(manifests: DataFrame, compactions: DataFrame, files: DataFrame,
                    on_disk: DataFrame) -> DataFrame:
    """Violations of the artifacts: names, presence, bytes, hashes, totals, ledger.

    ``on_disk`` holds size and SHA-256 of the parts actually found.
    """
    keys = list(REVISION)
    found = on_disk.select(*keys, "relative_path", F.col("bytes").alias("_bytes"), F.col("sha256").alias("_sha"))
    listed = files.join(manifests.select(*keys), keys, "left_semi").join(found, [*keys, "relative_path"], "left")
    per_file = _as_violations(listed, {
        "artifact_name": F.col("relative_path").contains("/"),
        "artifact_missing": F.col("_sha").isNull(),
        "artifact_integrity": F.col("_sha").isNotNull() & (
            missing_or(F.col("_sha") != F.col("sha256")) | missing_or(F.col("_bytes") != F.col("bytes"))),
    }, REVISION)
    totals = files.groupBy(*keys).agg(
        F.sum("rows").alias("_rows"), F.sum("entities").alias("_entities"), F.sum("bytes").alias("_size"),
        F.count(F.lit(1)).alias("_parts"), F.max("sha256").alias("_one"))
    ledger = compactions.select(*keys, "data_bytes", "data_sha256", "data_path", "directory")
    in_ledger = F.col("directory").isNotNull()
    summed = manifests.join(totals, keys).join(ledger, keys, "left")
    per_revision = _as_violations(summed, {
        "artifact_metadata": missing_or(F.col("_rows") != expected_artifact_rows())
        | missing_or(F.col("_entities") != F.col("entity_total")),
        # without a ledger row there is nothing to compare with
        "ledger_artifact": in_ledger & (
            missing_or(F.col("data_bytes") != F.col("_size"))
            | ((F.col("_parts") == 1) & missing_or(F.col("data_sha256") != F.col("_one")))
            | missing_or(~F.col("data_path").startswith(F.col("directory")))),
    }, REVISION)
    return per_file.unionByName(per_revision)


def verify_revisions(manifests: DataFrame, compactions: DataFrame, inputs: DataFrame, files: DataFrame,
                     on_disk: DataFrame) -> DataFrame:
    """All violations; a revision without any is sound."""
    return manifest_violations(manifests, compactions, inputs, files).unionByName(
        file_violations(manifests, compactions, files, on_disk))


def verify_days(spark: SparkSession, root: str, compactions: DataFrame, days: DataFrame) -> DataFrame:
    """All violations of the selected revisions, what their footers say included; only their directories are listed."""
    manifests, inputs, files = (R.of_days(scan(spark, root, days), days) for scan in (R.scan_manifests, R.scan_inputs, R.scan_files))
    on_disk = R.of_days(R.scan_parts(spark, root, days), days)
    found = verify_revisions(manifests, R.of_days(compactions, days), inputs, files, on_disk)
    return found.unionByName(footer_violations(manifests, files, scan_footers(spark, root, days)))
