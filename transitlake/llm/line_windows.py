"""Line deduplication by overlapping windows of three lines.

Every run of three consecutive lines is hashed. A window found more than once in the
corpus stays where it occurs first, by key and position, and each later occurrence
covers its three positions; the covered positions of a document are merged and removed.
The earliest occurrence of a line is never removed, so no line is lost from the corpus.

Texts of fewer than three lines have no window and stay as they are, as do null and
empty texts; windows without a word do not count. Rows that agree in key and text are
one document: they are cleaned alike. A null key comes first. An empty table stays empty; a very long
text is one row of windows a line. Extra columns pass through whatever their names; only a column with the name of a
result (``n_lines_``, ``n_removed_``) gives way to it. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transitlake.llm.tables import packed, prepare

LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _name(key: Column, text: Column) -> Column:
    """128 bits that name a document: its key and its text."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("")), F.lit("\n"), text)))


def windows(docs: DataFrame, key: str, text: str, size: int = LINES) -> DataFrame:
    """``id, name, at, window``: every window that has a word."""
    lined = docs.select(F.col(key).alias("id"), _name(F.col(key), F.col(text)).alias("name"), _lines(F.col(text)).alias("lines")) \
        .where(F.size("lines") >= size)
    joined = F.transform(F.sequence(F.lit(0), F.size("lines") - size),
                         lambda i: F.array_join(F.slice("lines", i + 1, F.lit(size)), "\n"))
    return lined.select("id", "name", F.posexplode(joined).alias("at", "joined")) \
        .where(F.col("joined").rlike(r"[^\x20\x09-\x0D]")) \
        .select("id", "name", "at", F.unhex(F.md5("joined")).alias("window"))


def covered_positions(docs: DataFrame, key: str, text: str, size: int = LINES) -> DataFrame:
    """``name, covered``: positions of lines that later occurrences cover."""
    found = windows(docs, key, text, size)
    place = F.struct("id", "name", "at")
    # counted before the shuffle: a window in a third of all documents is a few rows by then
    repeated = found.groupBy("window").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    later = found.join(repeated, "window").where(~place.eqNullSafe(F.col("first")))
    return later.select("name", F.explode(F.array(*[F.col("at") + k for k in range(size)])).alias("line")) \
        .groupBy("name").agg(F.collect_set("line").alias("covered"))  # at most the lines of one document


def deduplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = LINES) -> DataFrame:
    """``docs`` with cleaned texts, and ``n_lines_``, ``n_removed_``."""
    results = ("n_lines_", "n_removed_")
    return _cleaned(docs, key, text, size).select(*[F.col(f"row_.`{c}`") for c in docs.columns if c not in results], *results)


def _cleaned(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``row_`` with the cleaned text, ``n_lines_``, ``n_removed_``."""
    prepare(docs.sparkSession)
    covered = covered_positions(docs, key, text, size)
    rows = packed(docs).select("row_", _name(F.col(f"row_.{key}"), F.coalesce(F.col(f"row_.{text}"), F.lit(""))).alias("name"))
    lines = _lines(F.col(f"row_.{text}"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    cleaned = F.when(F.col("covered").isNull(), F.col(f"row_.{text}")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    return rows.join(covered, "name", "left").select(
        F.struct(*[(cleaned if c == text else F.col(f"row_.`{c}`")).alias(c) for c in docs.columns]).alias("row_"),
        F.when(F.col(f"row_.{text}").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines_"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed_"))


def lines_removed(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = LINES) -> DataFrame:
    """``docs`` with cleaned texts; a document that nothing is left of goes."""
    left = F.col(f"row_.`{text}`")
    emptied = (F.col("n_removed_") > 0) & ~left.rlike(r"[^\x20\x09-\x0D]")
    return _cleaned(docs, key, text, size).where(~emptied | left.isNull()).select("row_.*")
