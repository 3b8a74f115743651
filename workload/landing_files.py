"""Write captures as landing files, a body and a sidecar each, from Spark tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.schemas import CAPTURE


def write_landing(captures: DataFrame, root: str) -> int:
    """``captures``: the capture columns and ``body``. Returns the number of pairs.

    A field that is empty is left out of the document, as pollers do.
    """
    texts = [F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(n)
             if n in ("scheduled_at", "started_at", "completed_at") else F.col(n) for n in CAPTURE.names]
    document = F.to_json(F.struct(*texts))
    files = captures.select(F.concat(F.lit(f"{root}/"), "raw_path").alias("body_path"),
                            F.concat(F.lit(f"{root}/"), "sidecar_path").alias("document_path"),
                            "body", document.alias("document"))
    written = files.mapInArrow(_write_pairs, "pairs bigint")
    return written.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]


def _write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        for body_path, document_path, body, document in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            store, path = fs.FileSystem.from_uri(body_path)
            _, sidecar = fs.FileSystem.from_uri(document_path)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path) as out:
                out.write(body)
            with store.open_output_stream(sidecar) as out:
                out.write(json.dumps(json.loads(document), indent=2).encode())
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["pairs"])
