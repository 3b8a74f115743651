"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents are tokenized, each ended by one token, and only documents longer than a
sequence are cut, the first piece being the short one. Pieces and gaps have whole sizes
up to the sequence length, so ranges of equal size are their sorted order. One round
for each size, largest first: its pieces sweep the sorted gaps for the successor, the smallest gap that
holds them; conflicts between pieces of a size, and between gaps of a size, are resolved by
rank, the r-th piece to the r-th place; the gaps are updated, pieces without a gap open new
sequences, and the next size follows. This is best-fit decreasing, done for all pieces of a
size at once. Rounds work on runs (a range of ranks, a range of sequences), whose number
depends on the sequence length and not on the corpus; ranks of pieces are found in Spark,
and each piece looks up its run.

Token ids are those of the tokenizer file: byte pair merges by rank, with the
special token recognised in texts, as the tokenizers library does by default. They are
computed from the same vocabulary as ranks, which is about five times as fast and gives
equal ids (tested). A null text counts as empty, and an empty document is its end token.
Repeated rows are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import bisect
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.ranks import ranked
from transitlake.llm.tables import prepare, stored, unit_hash

LENGTH = 1024
END = 2
SPECIAL = {"<|endoftext|>": 50256}
SLICE = 1 << 16

_encodings: dict = {}


def encoding(name: str):
    """The byte pair encoding of a vocabulary file, loaded once in a process."""
    if name not in _encodings:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _encodings[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                             special_tokens=SPECIAL)
    return _encodings[name]


def encode(text: str, name: str = "byte_bpe_50k") -> np.ndarray:
    """Token ids of a text. A long text goes in slices that end where no token can span:
    before a space between two ASCII letters."""
    encoder, parts, at = encoding(name), [], 0
    while len(text) - at > SLICE:
        cut = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])").search(text, at + SLICE // 2)
        if cut is None:
            break
        parts.append(encoder.encode_to_numpy(text[at:cut.start()], allowed_special="all"))
        at = cut.start()
    parts.append(encoder.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts).astype(np.uint32)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
           tokenizer: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` (and ``ids``): the documents, tokenized and cut."""
    prepare(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        for batch in batches:
            owner, columns, kept = [], [[], [], [], []], []
            for row, own in enumerate(batch.column(1)):
                ids = np.append(encode(own.as_py() or "", tokenizer), np.uint32(end)).astype("<u4")
                start, size = 0, len(ids) % length or min(length, len(ids))
                for number in range(-(-len(ids) // length)):
                    cut = ids[start:start + size]
                    owner.append(row)
                    for column, value in zip(columns, (number, start, size, zlib.crc32(cut.tobytes()))):
                        column.append(value)
                    if with_ids:
                        kept.append(cut.astype(np.int32))
                    start, size = start + size, length
            arrays = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(columns[0], pa.int32()),
                      *(pa.array(c, pa.int64()) for c in columns[1:])]
            if with_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema(
                [(n, a.type) for n, a in zip(("id", "piece", "start", "length", "ids_crc32", "ids"), arrays)]))

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema)


def pack_rounds(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(size, rank, ranks, sequence, each, offset)`` from the number of pieces of each size.

    Pieces of ``size`` with ranks from ``rank`` on fill sequences from ``sequence`` on, ``each``
    in a sequence, the first at ``offset``.
    """
    runs, new = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, how many)
    sizes: list[int] = []                        # the gaps there are, sorted

    def put(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, many))

    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            at = bisect.bisect_left(sizes, size)
            if at < len(sizes):
                gap = sizes[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            else:
                gap, first = length, new
                many = -(-left // (length // size))
                new += many
            each = gap // size
            whole = min(many, left // each)
            if whole:
                runs.append((size, rank, whole * each, first, each, length - gap))
                rank, left = rank + whole * each, left - whole * each
                put(gap - each * size, first, whole)
                first, many = first + whole, many - whole
            if many and left and left < each:
                runs.append((size, rank, left, first, each, length - gap))
                put(gap - left * size, first, 1)
                first, many, left = first + 1, many - 1, 0
            put(gap, first, many)
    return runs


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; every sequence is gapless from 0."""
    spark = cut.sparkSession
    cut = stored(cut.withColumn("order_", unit_hash(F.coalesce(F.col("id").cast("string"), F.lit("")), "piece", "ids_crc32")), "pieces")
    sizes = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # ``length`` rows at most
    runs = spark.createDataFrame(pack_rounds(sizes, length), "length long, rank long, ranks long, sequence long, each long, at long")
    counts = spark.createDataFrame(list(sizes.items()), "length long, n long")
    ordered = ranked(cut, ["length"], "order_", ["piece"], F.broadcast(counts))
    # the runs' number is bounded by the sequence length
    placed = ordered.alias("p").join(F.broadcast(runs.alias("r")), (F.col("p.length") == F.col("r.length"))
                                     & (F.col("rank_") >= F.col("rank")) & (F.col("rank_") < F.col("rank") + F.col("ranks")))
    within = F.col("rank_") - F.col("rank")
    return placed.select("p.*", (F.col("sequence") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"),
                         (F.col("at") + within % F.col("each") * F.col("p.length")).cast("long").alias("offset")) \
        .drop("rank_", "n", "in_bucket_", "order_")


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END,
                   tokenizer: str = "byte_bpe_50k", with_ids: bool = False) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) for each piece."""
    return pack(pieces(docs, key, text, length, end, tokenizer, with_ids), length).withColumnRenamed("id", key)
