"""Tables between steps, connected components, and other plain Spark helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.session import scratch_dir

# Python stages look at whole texts: few rows a batch bound the memory beside the JVM
BATCH_ROWS = "1000"


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                       ("spark.sql.adaptive.enabled", "true")):
        if spark.conf.get(key, None) != value and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: computed once, and
    there when an executor is lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128 bits that name a text."""
    return F.unhex(F.md5(text))


def unit_hash(*columns: Column | str) -> Column:
    """A uniform number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)).cast("double") / float(1 << 53)


def fold(key: Column, folds: int) -> Column:
    """The crc32 of a key's text, modulo ``folds``; a null key counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % folds


def packed(df: DataFrame, name: str = "row_") -> DataFrame:
    """All columns as one struct, so that added columns cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


HOT_SHARE = 1000


def meeting(rows: DataFrame, facts: DataFrame, key: str, copies: str) -> DataFrame:
    """``rows`` with the facts of their ``key``, which is unique in the stored table ``facts``.

    ``copies`` says how many rows a key has. Keys with more than a thousandth of all rows, fewer than a thousand
    keys, are broadcast with their facts, so their rows stay where they are; no other key can fill a task.
    """
    total = facts.agg(F.coalesce(F.sum(copies), F.lit(0))).first()[0]
    hot = F.col(copies) * HOT_SHARE > total
    marked = rows.join(F.broadcast(facts.where(hot).select(key, F.lit(True).alias("hot_"))), key, "left")
    many = marked.where("hot_").drop("hot_").join(F.broadcast(facts.where(hot)), key)
    few = marked.where("hot_ is null").drop("hot_").join(facts.where(~hot), key)
    return many.unionByName(few)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of some link; the root is the least node.

    Large-star and small-star steps: each sends a node's neighbours to the least one,
    by an aggregate and a join, so that no neighbourhood is gathered anywhere.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(lowest, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("low").alias("v")).where(F.col("u") != F.col("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("low").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct()
        edges = stored(small, "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
