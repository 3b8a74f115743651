"""Document fingerprints: Merkle trees over spans, paragraphs and sections.

A text is a list of sections, a section of paragraphs (lines with their line end), a
paragraph of spans of words. Spans end where a word's hash says so (one word in eight),
sections after blank lines and where a paragraph's hash says so (one in four): boundaries
go with the content, so an insertion moves none behind it. A leaf is the hash of a
span's bytes, a node the hash of its children, the root that of the sections.

The fingerprint is text: the root, then the sections with their paragraphs and leaves,

    root|section:paragraph=leaf~bytes,leaf~bytes;paragraph=...|section:...

Equal texts have equal fingerprints and roots. ``differences`` compares two of them from
the top: equal branches are skipped, and the spans that differ are given as byte ranges.
``likeness`` is the share of bytes in leaves that both have (twice the common bytes over
both texts' bytes), 1 for equal roots.

Null texts count as empty; an empty text has a root of its own and no sections. The
likeness of two empty texts is 1. White space counts: it belongs to the span before it.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from transitlake.llm import text as T
from transitlake.llm.tables import prepare

SPAN, SECTION = 8, 4


def _hash(data: bytes, size: int) -> str:
    return hashlib.blake2b(data, digest_size=size).hexdigest()


def tree(data: bytes) -> tuple[str, Counter]:
    """The fingerprint of a text's UTF-8 bytes, and its leaves with their bytes."""
    if not data:
        return _hash(b"", 16), Counter()
    block = next(T.blocks(pa.array([data], pa.binary()).view(pa.string())))
    return tree_of(block, 0)


def tree_of(block: T.Block, i: int) -> tuple[str, Counter]:
    low, high = int(block.offsets[i]), int(block.offsets[i + 1])
    data = block.data[low:high]
    raw = data.tobytes()
    if not raw:
        return _hash(b"", 16), Counter()
    first, last = block.word_offsets[i], block.word_offsets[i + 1]
    hashes = block.range_hashes(block.starts[first:last], block.ends[first:last])
    chosen = np.flatnonzero(hashes % np.uint64(SPAN) == 0)
    # a span ends before the word after a chosen one; a paragraph after its line end
    follows = chosen[chosen + 1 < last - first] + 1
    lines = np.flatnonzero(data == 0x0A) + 1
    cuts = np.union1d(np.union1d(block.starts[first:last][follows] - low, lines), [0, len(raw)]).tolist()
    line_ends = set(lines.tolist())
    leaves: Counter = Counter()
    # nodes are hashed over the whole digests of their children; the names printed are these digests' first 32 bits
    sections, paragraphs, spans, blank = [], [], [], True
    of_sections, of_paragraphs, of_spans = [], [], []

    def close_section():
        nonlocal paragraphs, of_paragraphs
        if paragraphs:
            of_sections.append(_hash("".join(of_paragraphs).encode(), 16))
            sections.append(of_sections[-1][:8] + ":" + ";".join(paragraphs))
            paragraphs, of_paragraphs = [], []

    for start, end in zip(cuts, cuts[1:]):
        span = raw[start:end]
        of_spans.append(_hash(span, 16))
        name = of_spans[-1][:8]
        leaves[name, end - start] += end - start
        spans.append(f"{name}~{end - start:x}")
        blank = blank and not span.strip()
        if end in line_ends or end == len(raw):
            of_paragraphs.append(_hash("".join(of_spans).encode(), 16))
            node = of_paragraphs[-1][:8]
            paragraphs.append(f"{node}={','.join(spans)}")
            if blank or int(node, 16) % SECTION == 0:
                close_section()
            spans, of_spans, blank = [], [], True
    close_section()
    return _hash("".join(of_sections).encode(), 16) + "|" + "|".join(sections), leaves


def likeness(a: tuple[str, Counter], b: tuple[str, Counter]) -> float:
    if a[0] == b[0]:
        return 1.0
    small, large = sorted((a[1], b[1]), key=len)
    common = sum(min(n, large[leaf]) for leaf, n in small.items() if leaf in large)
    total = a[1].total() + b[1].total()
    return 2 * common / total if total else 0.0


def parsed(fingerprint: str) -> list[tuple[str, list[tuple[str, list[tuple[str, int]]]]]]:
    """Sections, their paragraphs and their leaves (hash, bytes) from a fingerprint."""
    out = []
    for section in fingerprint.split("|")[1:]:
        name, _, rest = section.partition(":")
        paragraphs = []
        for paragraph in rest.split(";"):
            node, _, spans = paragraph.partition("=")
            paragraphs.append((node, [(s.partition("~")[0], int(s.partition("~")[2], 16)) for s in spans.split(",")]))
        out.append((name, paragraphs))
    return out


def differences(a: str, b: str) -> list[tuple[int, int]]:
    """Byte ranges of the second text that are not, in this order of branches, in the first."""
    if a.partition("|")[0] == b.partition("|")[0]:
        return []
    old_sections = Counter(name for name, _ in parsed(a))
    old_paragraphs = Counter(node for _, ps in parsed(a) for node, _ in ps)
    old_leaves = Counter(leaf for _, ps in parsed(a) for _, ls in ps for leaf in ls)
    ranges: list[tuple[int, int]] = []
    at = 0
    for name, paragraphs in parsed(b):
        same_section = old_sections[name] > 0
        old_sections[name] -= same_section
        for node, spans in paragraphs:
            same = same_section or old_paragraphs[node] > 0
            old_paragraphs[node] -= same and not same_section
            for leaf in spans:
                if not same and not old_leaves[leaf]:
                    if ranges and ranges[-1][1] == at:
                        ranges[-1] = (ranges[-1][0], at + leaf[1])
                    else:
                        ranges.append((at, at + leaf[1]))
                at += leaf[1]
    return ranges


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` for each row."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [tree_of(block, i)[0] for block in T.blocks(batch.column(1)) for i in range(block.n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "fingerprint"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"id {dict(docs.dtypes)[key]}, fingerprint string").withColumnRenamed("id", key)


def edited(text: str, follower: str) -> str:
    """The last third of the code points replaced by the first as many of ``follower``."""
    third = len(text) // 3
    return text[:len(text) - third] + follower[:third]


def with_followers(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """``part, id, text, tail`` in partitions by part, sorted by descending key.

    The keys are cut into ranges at quantiles. Each range gets, as its ``tail``, a copy of the
    row that follows its last one: the first of the next range, or of all for the last.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = rows.agg(F.percentile_approx("id", [k / parts for k in range(1, parts)], 10 * parts).alias("q")).first()["q"]
    cuts = sorted(set(found or []))  # fewer than ``parts`` keys
    # a null key comes last
    part = F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - _below(cuts, F.col("id")))
    rows = rows.select(part.cast("int").alias("part"), "id", "text")
    heads = rows.groupBy("part").agg(F.max("id").alias("head")).orderBy("part").collect()  # a row for each range
    givers = spark.createDataFrame([(row["head"], heads[k - 1]["part"]) for k, row in enumerate(heads)],
                                   T_.StructType([T_.StructField("head", rows.schema["id"].dataType),
                                                  T_.StructField("given", T_.IntegerType())]))
    copies = rows.join(F.broadcast(givers), F.col("id").eqNullSafe(F.col("head"))) \
        .select(F.col("given").alias("part"), "id", "text", F.lit(True).alias("tail"))
    return rows.select("part", "id", "text", F.lit(False).alias("tail")).union(copies)


def _below(cuts: list, value: Column) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``: a coarse step, then a fine one."""
    if not cuts:
        return F.lit(0)
    width = int(len(cuts) ** 0.5) + 1
    every = lambda items: F.array(*[F.lit(c) for c in items])
    coarse = F.size(F.filter(every(cuts[::width]), lambda c: c < value))
    fine = F.size(F.filter(F.slice(every(cuts), F.greatest((coarse - 1) * width, F.lit(0)) + 1, F.lit(width)), lambda c: c < value))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * width + fine)


def followed(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Each document beside its edited text and the next document, by descending key.

    Gives ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. Among equal keys the order is by text; null keys come last.
    """
    spark = prepare(docs.sparkSession)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    dealt = with_followers(docs, key, text, parts).repartition(parts, "part") \
        .sortWithinPartitions("part", "tail", F.desc_nulls_last("id"), "text")
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = ("bigint", "string", "string", "string", "double", "double")

    def run(batches):
        last = None  # part, id, text, tree of the row before
        for batch in batches:
            out: list[list] = [[] for _ in names]
            at = 0
            for block in T.blocks(batch.column(2)):
                for i in range(block.n):
                    part, key_, tail = (batch.column(k)[at].as_py() for k in (0, 1, 3))
                    at += 1
                    own = block.text(i).decode()
                    if tail and (last is None or last[0] != part or last[4]):
                        continue  # the first of several rows with the same key is the one that follows
                    print_ = tree_of(block, i)
                    if last is not None and last[0] == part and not last[4]:
                        for column, value in zip(out, _compared(last, own, print_)):
                            column.append(value)
                    last = (part, key_, own, print_, tail)
            yield pa.RecordBatch.from_arrays([
                pa.array(out[0], batch.column(1).type), pa.array(out[1], pa.int64()),
                *(pa.array(c, pa.string()) for c in out[2:5]), *(pa.array(c, pa.float64()) for c in out[5:])], names=names)

    schema = f"id {dict(docs.dtypes)[key]}, " + ", ".join(f"{n} {t}" for n, t in zip(names[1:], types))
    return dealt.mapInArrow(run, schema).withColumnRenamed("id", key)


def _compared(row: tuple, follower: str, follower_tree: tuple) -> tuple:
    _, key, own, print_, _ = row
    changed = edited(own, follower).encode()
    changed_tree = tree(changed)
    return (key, len(own), hashlib.sha256(changed).hexdigest(), print_[0], changed_tree[0],
            likeness(print_, changed_tree), likeness(print_, follower_tree))
