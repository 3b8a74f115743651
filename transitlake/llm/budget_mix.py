"""Mixing sources to target weights by fitting subset sums.

A document's size is its words. Sources, by code point with null last, weigh 1, 2, 3 and
again; together their targets are all the corpus's words, none above three times its
source's words, the excess shared out by weight. The targets solve that at once: they are
min(3 x words, level x weight), and the level is the largest of
(words not yet capped) / (weight not yet capped) over the sources in order of words / weight.

A source takes whole passes over its documents, then documents for the remaining budget:
they are counted by exact size; a systematic share of each size comes near the budget
(within three times the largest size); and a bounded knapsack over the sizes left, whose reachable
sums are the bits of one long integer, closes the gap, exactly where any choice can. The
plan says how many documents of each size to take; which ones, a seeded hash decides.

A null text has size 0. Documents of size 0 take nothing. Repeated rows are documents of
their own. Reruns agree. Sources may be many, but their table, one row each, is ordered
in one place; a source's histogram has one row for each size of document.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.ranks import ranked
from transitlake.llm.tables import packed, prepare, stored, unit_hash

SEED = 17
REPEATS = 3
# documents of every size that a fixed share gives back where it leaves a budget out of reach
GIVEN_BACK = (1, 8, 64)


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Sources as text in which null differs from every source."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def targets(histogram: DataFrame) -> DataFrame:
    """``sk, source_size, target`` from ``sk, size, n``."""
    sources = histogram.groupBy("sk").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    by_name = Window.orderBy((F.col("sk") == "null").cast("int"), "sk")
    weighed = sources.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    everything = Window.partitionBy(F.lit(0))
    earlier = Window.partitionBy(F.lit(0)).orderBy(F.col("source_size") / F.col("weight"), "sk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    total, weights = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    capped = F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * REPEATS
    level = (total - capped) / (weights - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    levels = weighed.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return levels.select("sk", "source_size", F.least(
        (F.col("source_size") * REPEATS).cast("double"), F.col("level") * F.col("weight")).alias("target"))


def fit_subset(sizes: np.ndarray, counts: np.ndarray, budget: int, offset: float) -> np.ndarray:
    """How many documents of each size to take so that their sizes sum to ``budget``, or near it."""
    chosen = np.zeros(len(sizes), np.int64)
    usable = np.flatnonzero((sizes > 0) & (counts > 0))
    if budget <= 0 or not len(usable):
        return chosen
    largest, total = int(sizes[usable].max()), int((sizes[usable] * counts[usable]).sum())
    if budget >= total:
        chosen[usable] = counts[usable]
        return chosen
    if 2 * budget > total:  # rather choose what stays out
        left_out = fit_subset(sizes, np.where(sizes > 0, counts, 0), total - budget, offset)
        chosen[usable] = counts[usable] - left_out[usable]
        return chosen
    share = max(0, budget - 2 * largest) / total
    ends = np.floor(np.cumsum(counts[usable] * share) + offset).astype(np.int64)
    chosen[usable] = np.minimum(np.diff(np.concatenate([[0], ends])), counts[usable])
    rest = budget - int((sizes * chosen).sum())
    while rest < 0:  # rounding took a document too many
        most = usable[chosen[usable] > 0][-1]
        chosen[most] -= 1
        rest += int(sizes[most])

    # where the share leaves sums out of reach, some documents of every size are given back, then more
    found = chosen
    for back in (0, *GIVEN_BACK):
        less = np.maximum(chosen - back, 0)
        more, missed = reach(sizes, counts - less, budget - int((sizes * less).sum()), usable)
        found = less + more
        if not missed or not less.any():
            break
    return found


def reach(sizes: np.ndarray, counts: np.ndarray, budget: int, usable: np.ndarray) -> tuple[np.ndarray, int]:
    """Bounded knapsack: counts whose sizes sum to ``budget``, or as near below as can be, and what is missed.

    Reachable sums are bits of one number, and every sum remembers the item that reached it first, so memory
    is that of the budget whatever the number of items. An item is some documents of one size.
    """
    items: list[tuple[int, int]] = []
    sums, wanted, full = 1, 1 << budget, (1 << (budget + 1)) - 1
    last = np.full(budget + 1, -1, np.int32)
    for at in np.random.default_rng(SEED).permutation(usable):
        left, step = int(min(counts[at], budget // sizes[at])), 1
        while left > 0 and not sums & wanted:
            take = min(step, left)
            grown = (sums | sums << int(sizes[at]) * take) & full
            if grown != sums:
                fresh = np.frombuffer((grown ^ sums).to_bytes(budget // 8 + 1, "little"), np.uint8)
                last[np.flatnonzero(np.unpackbits(fresh, bitorder="little")[:budget + 1])] = len(items)
                items.append((int(at), take))
                sums = grown
            left, step = left - take, step * 2
        if sums & wanted:
            break
    chosen = np.zeros(len(sizes), np.int64)
    place = sums.bit_length() - 1
    missed = budget - place
    while place:
        size, take = items[last[place]]
        chosen[size] += take
        place -= int(sizes[size]) * take
    return chosen, missed


def plan(histogram: DataFrame) -> DataFrame:
    """``sk, size, n, source_size, target, passes, extra``: what each source takes of each size."""
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        words, target = int(rows.source_size[0]), float(rows.target[0])
        passes = min(REPEATS, int(target // words)) if words else 0
        budget = round(target - passes * words) if passes < REPEATS else 0
        extra = fit_subset(rows["size"].to_numpy(), rows["n"].to_numpy(), budget, 0.5)
        return rows.assign(passes=passes, extra=extra)

    return histogram.join(targets(histogram), "sk").groupBy("sk").applyInPandas(
        fit, "sk string, size long, n long, source_size long, target double, passes int, extra long")


def _mixed(rows: DataFrame, ties: list[str]) -> DataFrame:
    """``rows`` (with ``sk``, ``size``, ``order_``) and what each takes."""
    histogram = stored(rows.groupBy("sk", "size").agg(F.count("*").alias("n")), "sizes")
    plans = stored(plan(histogram), "mixplan")
    every = ranked(rows, ["sk", "size"], "order_", ties, plans)
    return every.withColumn("taken", F.col("size") * (F.col("passes") + (F.col("rank_") < F.col("extra")).cast("int")))


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """``key, size, source_size, target, taken`` for each row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).alias("id"), size_of(F.col(text)).alias("size"), _source_key(F.col(source)).alias("sk"))
    rows = stored(rows.withColumn("order_", unit_hash(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))), "sized")
    return _mixed(rows, ["id"]).select(F.col("id").alias(key), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it."""
    prepare(docs.sparkSession)
    name = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("k"), F.col("id").cast("string")), F.lit("")), F.lit("\n"),
                                  F.coalesce(F.concat(F.lit("t"), F.col("text_")), F.lit("")))))
    whole = packed(docs).select("row_", F.col(f"row_.{key}").alias("id"), F.col(f"row_.{text}").alias("text_"),
                                _source_key(F.col(f"row_.{source}")).alias("sk"))
    named = whole.select("row_", name.alias("name"), "sk", "text_", "id")
    rows = stored(named.select("name", "sk", size_of(F.col("text_")).alias("size"), unit_hash(
        F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("order_")), "sized")
    taken = _mixed(rows, ["name"]).where("taken > 0").groupBy("name", "sk").agg(
        F.sum(F.col("taken") / F.col("size")).cast("int").alias("copies"), F.count("*").alias("same"))
    counts = rows.groupBy("name", "sk").agg(F.count("*").alias("same"))
    taken = taken.drop("same").join(counts, ["name", "sk"])
    found = named.select("row_", "name", "sk").join(taken, ["name", "sk"])
    # rows that agree in key, text and source share their copies
    once = found.where("same = 1").unionByName(found.where("same > 1").dropDuplicates(["name", "sk"]))
    return once.select("row_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row_.*")
