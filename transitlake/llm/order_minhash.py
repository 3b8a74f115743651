"""Near duplicates by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles; a shingle that occurs again carries
its occurrence number. A sketch value is made of the few labelled shingles with the
least hash, *in text order*: two texts agree in it where they keep the same content in
the same order, as edit similarity asks. Texts that share sketch values are compared
by a banded alignment of their shingle sequences:

    similarity = LCS / (n1 + n2 - LCS) >= 0.8

Candidates come from buckets that adapt to density. Texts that agree in one sketch
value form a bucket. In a small one all are compared. A larger one is divided by further sketch
values until its parts are small, and in each part on the way a text is compared with one
member chosen by hash. That joins most of a large group in linear work; what it leaves apart is
then found by an exact join over all texts of larger buckets. Near texts share ``floor`` of the
longer one's labelled shingles at least, so they share one among the rarest rest of each, and so
early that what follows can still suffice. Pairs within one class are passed over there, as they
cannot change the classes; all others are compared. So only what small buckets hold rests on
the sketches alone. Exact copies count once; their text is named by 128 bits.

Null texts and texts without a word are near to nothing: each document of that kind is
a class of its own. Texts of fewer than five words have one shingle, all their words.
Repeated rows belong to one class. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm import text as T
from transitlake.llm.tables import connected_components, meeting, packed, prepare, stored, text_key

WIDTH = 5
SIMILARITY = 0.8
SKETCHES = 16
LEAST = 3          # labelled shingles in a sketch value
SMALL = 8          # buckets up to this size are compared throughout
SALTED = 256       # holders of one rare shingle that a task meets
BRANCHES = (1, 1, 1, 1, 1)   # further sketch values that divide a larger bucket, level by level


def _constants(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(7)
    return (random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            random.integers(0, 1 << 63, count, dtype=np.uint64))


def sketch(labelled: np.ndarray, multipliers: np.ndarray, masks: np.ndarray, least: int) -> np.ndarray:
    """One value for each hash function: the ``least`` minima, in text order."""
    n = len(labelled)
    if n > least:
        hashed = (labelled[None, :] ^ masks[:, None]) * multipliers[:, None]
        hashed ^= hashed >> np.uint64(32)
        chosen = np.argpartition(hashed, least - 1, axis=1)[:, :least]
        chosen.sort(axis=1)
        kept = labelled[chosen]
    else:
        kept = np.broadcast_to(labelled[None, :], (len(masks), n))
    total = masks.copy()
    for k in range(kept.shape[1]):
        total = T.mix(total * np.uint64(31) + kept[:, k])
    return total


def sketches(docs: DataFrame, text: str, width: int = WIDTH, count: int = SKETCHES, least: int = LEAST) -> DataFrame:
    """``tkey, sk``: a row for each distinct text with a word, its sketch values."""
    def run(batches):
        multipliers, masks = _constants(count)
        for batch in batches:
            keys, values = [], []
            column = batch.column(1)
            for block in T.blocks(column):
                hashes, bounds = block.word_hashes(), block.word_offsets
                for i in range(block.n):
                    own = hashes[bounds[i]:bounds[i + 1]]
                    if not len(own):
                        continue
                    runs = T.shingles(own, width)
                    labelled = T.mix(runs + T.occurrences(runs).astype(np.uint64) * T.BASE)
                    keys.append(block.first + i)
                    values.append(sketch(labelled, multipliers, masks, least))
            flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(keys, pa.int64())),
                pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * count), pa.array(flat)),
            ], names=["tkey", "sk"])

    per_row = docs.select(text_key(F.col(text)).alias("tkey"), F.col(text).alias("text")) \
        .where("text is not null").mapInArrow(run, "tkey binary, sk array<bigint>")
    return stored(per_row.groupBy("tkey").agg(F.first("sk").alias("sk")), "sketches")


def buckets(sketched: DataFrame, count: int = SKETCHES, small: int = SMALL, branches=BRANCHES) -> list[DataFrame]:
    """Tables of ``bucket, tkey, tree, size, hub``, level by level; a bucket has two texts or more."""
    entries = sketched.select("tkey", F.posexplode("sk").alias("tree", "value")) \
        .select("tkey", "tree", F.xxhash64("tree", "value").alias("bucket"))
    levels = []
    for level, fan in enumerate((*branches, 0)):
        # every bucket has its own member that the others are compared with
        hub = F.min(F.struct(F.xxhash64("tkey", "bucket").alias("h"), "tkey"))["tkey"].alias("hub")
        sizes = entries.groupBy("bucket").agg(F.count("*").alias("size"), hub).where("size > 1")
        levels.append(stored(entries.join(sizes, "bucket"), f"buckets{level}"))
        large = levels[-1].where(F.col("size") > small)
        if not fan or large.isEmpty():
            break
        # the next sketch values around the ring, a different stride for each branch
        at = lambda k: F.get("sk", F.pmod(F.col("tree") + (level + 1) * (2 * k + 1), F.lit(count)).cast("int"))
        entries = large.join(sketched, "tkey").select(
            "tkey", "tree", F.explode(F.array(*[F.xxhash64("bucket", F.lit(k), at(k)) for k in range(fan)])).alias("bucket"))
    return levels


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def first_pairs(levels: list[DataFrame], small: int = SMALL) -> DataFrame:
    """``a, b``: all pairs of small buckets, and each text of a larger one with its hub."""
    found = []
    for members in levels:
        few = members.where(F.col("size") <= small).groupBy("bucket").agg(F.sort_array(F.collect_set("tkey")).alias("all"))
        found += [members.where((F.col("size") > small) & (F.col("tkey") != F.col("hub")))
                  .select(F.least("tkey", "hub").alias("a"), F.greatest("tkey", "hub").alias("b")),
                  few.select("all", F.posexplode("all").alias("at", "a"))
                  .select("a", F.explode(F.slice("all", F.col("at") + 2, F.lit(small))).alias("b"))]
    return _union(found).distinct()


def labelled_shingles(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """``tkey, gram``: a row for each labelled shingle of each text."""
    def run(batches):
        for batch in batches:
            for block in T.blocks(batch.column(1)):
                hashes, bounds = block.word_hashes(), block.word_offsets
                runs = [T.shingles(hashes[bounds[i]:bounds[i + 1]], width) for i in range(block.n)]
                labelled = [T.mix(r + T.occurrences(r).astype(np.uint64) * T.BASE) for r in runs]
                owners = np.repeat(np.arange(block.first, block.first + block.n), [len(x) for x in labelled])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(owners, pa.int64())), pa.array(np.concatenate(labelled).view(np.int64))],
                    names=["tkey", "gram"])

    return texts.select("tkey", "text").mapInArrow(run, "tkey binary, gram bigint")


def exact_pairs(texts: DataFrame, links: DataFrame, width: int = WIDTH, floor: float = SIMILARITY,
                salted: int = SALTED) -> DataFrame:
    """``a, b``: every pair of ``texts`` that may reach ``floor`` and lies in two classes of ``links``.

    Near texts of n and m shingles have r = floor / (1 + floor) x (n + m) in common at least, which
    is floor x max(n, m) or more. Each text has its shingles sorted, the rarest first. The first
    that both have is then among the n - floor x n + 1 first ones, at a place behind which
    (itself included) both have r left. A pair of two classes has one text outside of the
    class that holds most of a shingle's texts: those meet all, instead of all meeting all.
    """
    roots = connected_components(links).select(F.col("node").alias("tkey"), "root")
    grams = stored(labelled_shingles(texts, width), "grams")
    ranked = grams.join(grams.groupBy("gram").agg(F.count("*").alias("held")), "gram") \
        .groupBy("tkey").agg(F.sort_array(F.collect_list(F.struct("held", "gram"))).alias("all"))  # of one text
    n = F.size("all")
    first = ranked.join(roots, "tkey", "left").select(
        "tkey", F.coalesce("root", "tkey").alias("root"), n.alias("n"),
        F.posexplode(F.slice("all", F.lit(1), (n - F.ceil(n * floor - 1e-6) + 1).cast("int"))).alias("at", "one")) \
        .where("one.held > 1").select("tkey", "root", "n", "at", F.col("one.gram").alias("gram"))
    first = stored(first, "prefixes")
    shared = first.groupBy("gram", "root").agg(F.count("*").alias("many")).groupBy("gram").agg(
        F.sum("many").alias("holders"), F.count("*").alias("roots"), F.max(F.struct("many", "root"))["root"].alias("main")) \
        .where("roots > 1").withColumn("salts", F.ceil(F.col("holders") / salted).cast("int")).drop("roots", "holders")
    held = stored(first.join(shared, "gram"), "shared")
    name = lambda side: [F.col(c).alias(f"{c}_{side}") for c in ("tkey", "root", "n", "at")]
    left = held.where(F.col("root") != F.col("main")).select(
        "gram", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *name("x"))
    right = held.select("gram", F.pmod(F.xxhash64("tkey"), F.col("salts")).cast("int").alias("salt"), *name("y"))
    common = (F.col("n_x") + F.col("n_y")) * (floor / (1 + floor)) - 1e-6
    met = left.join(right, ["gram", "salt"]).where(
        (F.col("root_x") != F.col("root_y")) & (F.col("n_x") - F.col("at_x") >= common) & (F.col("n_y") - F.col("at_y") >= common))
    return met.select(F.least("tkey_x", "tkey_y").alias("a"), F.greatest("tkey_x", "tkey_y").alias("b")).distinct()


def banded_similarity(x: list, y: list, floor: float) -> float:
    """LCS / (n1 + n2 - LCS) of two sequences, exact from ``floor`` upwards.

    Beyond the band that ``floor`` allows nothing is matched, so a result below the
    floor is a lower bound. The rows of the band are bit vectors (one long integer).
    """
    n, m = len(x), len(y)
    if not n or not m or min(n, m) < floor * max(n, m):
        return 0.0
    head = 0
    while head < min(n, m) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and x[n - 1 - tail] == y[m - 1 - tail]:
        tail += 1
    x, y = x[head:n - tail], y[head:m - tail]
    common = head + tail
    if x and y:
        band = int((n + m) * (1 - floor) / (1 + floor)) + 1  # insertions and deletions at most
        places: dict = {}
        for i, symbol in enumerate(x):
            places[symbol] = places.get(symbol, 0) | (1 << i)
        full = (1 << len(x)) - 1
        rows, window = full, (1 << (2 * band + 1)) - 1
        wide = 2 * band + 1 >= len(x) + len(y)
        for j, symbol in enumerate(y):
            hit = places.get(symbol)
            if hit is None:
                continue
            if not wide:
                hit &= window << (j - band) if j >= band else window >> (band - j)
            taken = rows & hit
            if taken:
                rows = ((rows + taken) | (rows - taken)) & full
        common += len(x) - rows.bit_count()
    return common / (n + m - common)


def whole_texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``tkey, text`` for the keys in ``wanted``. Copies are combined before the shuffle, so
    that a text in a third of all rows is a few rows by then."""
    texts = docs.select(text_key(F.col(text)).alias("tkey"), F.col(text).alias("text")).where("text is not null") \
        .groupBy("tkey").agg(F.first("text").alias("text"))
    # keys are distinct; a semi join would go below the aggregate
    return stored(texts.join(wanted.select("tkey").distinct(), "tkey"), "texts")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, floor: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity`` of the pairs that reach ``floor``. Whole texts are compared."""
    def run(batches):
        for batch in batches:
            lefts, rights = list(T.blocks(batch.column(2))), list(T.blocks(batch.column(3)))
            sequences = [_sequences(side, width) for side in (lefts, rights)]
            kept, scores = [], []
            for i, (x, y) in enumerate(zip(*sequences)):
                score = banded_similarity(x, y, floor)
                if score >= floor:
                    kept.append(i)
                    scores.append(score)
            chosen = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(chosen), batch.column(1).take(chosen), pa.array(scores, pa.float64())],
                names=["a", "b", "similarity"])

    joined = pairs.join(texts.select(F.col("tkey").alias("b"), F.col("text").alias("text_b")), "b") \
        .join(texts.select(F.col("tkey").alias("a"), F.col("text").alias("text_a")), "a")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary, similarity double")


def _sequences(side: list, width: int):
    for block in side:
        hashes, bounds = block.word_hashes(), block.word_offsets
        for i in range(block.n):
            yield T.shingles(hashes[bounds[i]:bounds[i + 1]], width).tolist()


def near_duplicate_links(docs: DataFrame, text: str = "text", width: int = WIDTH, floor: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity`` between the keys of different texts that are near; those of one
    class are not all there, but join it."""
    prepare(docs.sparkSession)
    levels = buckets(sketches(docs, text, width))
    texts = whole_texts(docs, text, _union([members.select("tkey") for members in levels]))
    first = stored(first_pairs(levels), "pairs")
    links = stored(verified(first, texts, width, floor), "near")
    if len(levels) > 1:  # there are larger buckets
        dense = levels[0].where(F.col("size") > SMALL).select("tkey").distinct()
        more = stored(exact_pairs(texts.join(dense, "tkey"), links, width, floor).join(first, ["a", "b"], "left_anti"), "pairs")
        links = links.union(stored(verified(more, texts, width, floor), "near"))
    return links


def text_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                 floor: float = SIMILARITY) -> DataFrame:
    """``tkey, root, class_id, class_size, rows, copies``: a row for each distinct text with a word.

    ``class_id`` is the least key of the class's documents (null if all are null), ``rows`` how many
    rows a text has, ``copies`` how many of them bear that key; only one text of a class has
    any copies, the one with the least name of those that bear it.
    """
    links = near_duplicate_links(docs, text, width, floor)
    roots = connected_components(links).select(F.col("node").alias("tkey"), "root")
    rows = docs.where(F.col(text).rlike(r"[^\x20\x09-\x0D]")).select(
        text_key(F.col(text)).alias("tkey"), F.col(key).alias("id"))
    texts = rows.groupBy("tkey", "id").count().groupBy("tkey").agg(
        F.sum("count").alias("rows"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tkey", "count")).alias("least"))
    texts = stored(texts.join(roots, "tkey", "left").select(
        "tkey", F.coalesce("root", "tkey").alias("root"), "rows", "least"), "classes")
    classes = stored(texts.groupBy("root").agg(F.sum("rows").alias("class_size"), F.min("least").alias("first")), "roots")
    return stored(meeting(texts, classes, "root", "class_size").select(
        "tkey", "root", F.col("first.id").alias("class_id"), "class_size", "rows",
        F.when(F.col("tkey") == F.col("first.tkey"), F.col("first.count")).otherwise(F.lit(0)).alias("copies")), "members")


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                           floor: float = SIMILARITY) -> DataFrame:
    """``key, class_id, class_size``: a row for each row of ``docs``."""
    classes = text_classes(docs, key, text, width, floor)
    rows = docs.select(F.col(key).alias("id"), F.when(
        F.col(text).rlike(r"[^\x20\x09-\x0D]"), text_key(F.col(text))).alias("tkey"))
    # rows without words meet nothing; spread them, for a null key would gather them
    worded = meeting(rows.where("tkey is not null"), classes, "tkey", "rows").select("id", "class_id", "class_size")
    bare = rows.where("tkey is null").select("id", F.col("id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return worded.union(bare).withColumnRenamed("id", key)


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH,
                         floor: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each class stays."""
    classes = text_classes(docs, key, text, width, floor)
    rows = packed(docs).select(
        "row_", F.col(f"row_.{key}").alias("id_"),
        F.when(F.col(f"row_.{text}").rlike(r"[^\x20\x09-\x0D]"), text_key(F.col(f"row_.{text}"))).alias("tkey"))
    chosen = meeting(rows.where("tkey is not null"), classes.where("copies > 0"), "tkey", "rows") \
        .where(F.col("id_").eqNullSafe(F.col("class_id")))
    single = chosen.where("copies = 1").select("row_.*")
    repeated = chosen.where("copies > 1").dropDuplicates(["root"]).select("row_.*")
    return single.union(repeated).union(rows.where("tkey is null").select("row_.*"))
