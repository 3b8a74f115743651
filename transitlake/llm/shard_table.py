"""Sharding by a lookup table that shards fill in turns.

Each shard has a preference order over the slots of a prime-sized table: a start and a
stride from a hash of its name, which visit every slot once. The shards take turns, and
each claims its next slot that is still free, until the table is full; so every shard has
``slots / shards`` slots, give or take one, and a shard that leaves frees its own slots
while nearly all others stay. The table has ``slots`` rows, a parameter, so it is
broadcast and a document's place is one lookup by the hash of its key.

A null key counts as the empty text; rows with equal keys share a shard, so the key to
use is one that no large part of the rows shares. An empty table stays empty, texts are not looked at. Extra columns pass through
whatever their names; only a column with the name of a result (``slot_``, ``shard_``) gives way to it. Built-in functions only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.llm.tables import prepare

SLOTS = 65537
SHARDS = 64


def preference(name: str, slots: int) -> tuple[int, int]:
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in ``names``) of every slot; ``slots`` must be a prime."""
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime")
    if not 0 < len(names) <= slots or len(set(names)) < len(names):
        raise ValueError("shards need different names, and no more than there are slots")
    places, strides = zip(*(preference(name, slots) for name in names))
    places, owner, left = list(places), [-1] * slots, slots
    while True:
        for shard, stride in enumerate(strides):
            place = places[shard]
            while owner[place] >= 0:
                place = (place + stride) % slots
            owner[place] = shard
            places[shard] = (place + stride) % slots
            left -= 1
            if not left:
                return owner


def shard_names(shards: int = SHARDS) -> list[str]:
    return [f"shard-{k:05d}" for k in range(shards)]


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """From the first 60 bits of the key's md5, which other engines compute alike."""
    head = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(slots)).cast("int")


def lookup_table(spark: SparkSession, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``slot_, shard_``: the filled table."""
    owners = F.split(F.lit(",".join(map(str, fill(names, slots)))), ",")
    return spark.range(1).select(F.posexplode(owners).alias("slot_", "shard")).select("slot_", F.col("shard").cast("int").alias("shard_"))


def place(docs: DataFrame, key: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``docs`` with ``slot_`` and ``shard_``."""
    prepare(docs.sparkSession)
    lookup = lookup_table(docs.sparkSession, names or shard_names(), slots)
    # the table has ``slots`` rows of two numbers
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("slot_", "shard_")]
    placed = docs.select(F.struct(*kept).alias("row_"), slot_of(F.col(f"`{key}`"), slots).alias("slot_"))
    return placed.join(F.broadcast(lookup), "slot_").select("row_.*", "slot_", "shard_")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", names: list[str] | None = None, slots: int = SLOTS,
                 files: int = 1) -> None:
    """Write ``docs`` below ``path`` by shard, each in ``files`` files or so."""
    placed = place(docs, key, names, slots)
    part = F.pmod(F.col("slot_"), F.lit(files))
    placed.repartition("shard_", part).drop("slot_").write.partitionBy("shard_").parquet(path)
