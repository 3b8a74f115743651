"""Quality rules whose cutoffs come with a guarantee against false rejection.

Whole texts are measured (words are runs of ``[^\\x20\\x09-\\x0D]``). A *base* rule
rejects texts of fewer than 20 words, and texts of which more than 30 % of the words
lie in 8-word windows that the text repeats. Beside it stand ratio rules (symbols,
capitals, exclamation marks, repeated lines, repeated words), each with a fixed ladder
of cutoffs, loosest first.

On labelled holdout rows, per stratum (language, known ones apart and all others
together), every rule climbs down its ladder while an exact binomial test shows that
it rejects at most its share of ``risk`` of the good documents: with ``x`` of ``n`` good
rows rejected, a cutoff holds if P(Bin(n, share) <= x) <= ``error`` / (rules x strata).
Testing in a fixed order needs no correction along a ladder; rules and strata are
corrected by Bonferroni. So with probability 1 - ``error``, in every stratum all rules
together reject at most ``risk`` of the good documents. A stratum with too few labelled
rows certifies nothing, and its documents are kept unless the base rule rejects them.

Null and empty texts have zero words and fail the base rule. Rows are judged one by
one, so repeated rows get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types

from transitlake.llm import text as T
from transitlake.llm.tables import packed, prepare, stored

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclaims")
WINDOW = 8
RISK, ERROR = 0.03, 0.05
LADDER = (0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03, 0.02, 0.01)
RULES = {"symbols": ("n_symbols", "word_chars"), "capitals": ("n_capitals", "word_chars"),
         "exclaims": ("n_exclaims", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
         "repeats": ("n_repeat_words", "n_words")}
LANGUAGES = ("de", "en", "es", "fr")


def _flags(characters: str) -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[list(characters.encode())] = True
    return flags


SYMBOLS = _flags("#*$%&|<>")
CAPITALS = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
EXCLAIMS = _flags("!")


def _per_document(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])[offsets])


def measures(block: T.Block) -> np.ndarray:
    """One row of ``MEASURES`` for each document of a block."""
    data, offsets, n = block.data, block.offsets, block.n
    characters = (data & 0xC0) != 0x80
    out = {"n_words": np.diff(block.word_offsets), "word_chars": _per_document(characters & ~T.SPACE[data], offsets)}
    for name, flags in (("n_symbols", SYMBOLS), ("n_capitals", CAPITALS), ("n_exclaims", EXCLAIMS)):
        out[name] = _per_document(flags[data], offsets)

    # lines with a word: none crosses a document, and no word crosses a line
    breaks = np.flatnonzero(data == 0x0A)
    edges = np.unique(np.concatenate([offsets, breaks, breaks + 1]))
    starts, ends = edges[:-1], edges[1:]
    counts = np.diff(np.searchsorted(block.starts, edges))
    starts, ends = starts[counts > 0], ends[counts > 0]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    keys = T.mix(block.range_hashes(starts, ends) + owner.astype(np.uint64) * T.BASE)
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = np.bincount(owner[T.occurrences(keys) > 0], minlength=n)

    # windows of words found twice or more in their text
    owner, words = block.words_by_document(), block.word_hashes()
    count = len(words) - WINDOW + 1
    covered = np.zeros(len(words) + 1, np.int64)
    if count > 0:
        inside = owner[:count] == owner[WINDOW - 1:]
        keys = T.mix(T.shingles(words, WINDOW) + owner[:count].astype(np.uint64) * T.BASE)
        _, back, found = np.unique(keys, return_inverse=True, return_counts=True)
        at = np.flatnonzero(inside & (np.bincount(back, weights=inside, minlength=len(found))[back] > 1.5))
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
    out["n_repeat_words"] = np.bincount(owner[np.cumsum(covered)[:-1] > 0], minlength=n)
    return np.stack([out[name] for name in MEASURES], axis=1).astype(np.int64)


def measured(rows: DataFrame, text: str) -> DataFrame:
    """The rows with a struct ``m_`` of the measures of their texts."""
    prepare(rows.sparkSession)
    at = rows.columns.index(text)
    names = rows.columns

    def run(batches):
        for batch in batches:
            found = [measures(block) for block in T.blocks(batch.column(at))]
            values = np.concatenate(found) if found else np.zeros((0, len(MEASURES)), np.int64)
            struct = pa.StructArray.from_arrays([pa.array(values[:, k]) for k in range(len(MEASURES))], names=list(MEASURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*names, "m_"])

    longs = types.StructType([types.StructField(m, types.LongType()) for m in MEASURES])
    return rows.mapInArrow(run, types.StructType([*rows.schema.fields, types.StructField("m_", longs)]))


def base_failed(m: str = "m_") -> Column:
    return (F.col(f"{m}.n_words") < 20) | (100 * F.col(f"{m}.n_repeat_words") > 30 * F.col(f"{m}.n_words"))


def ratio(rule: str, m: str = "m_") -> Column:
    above, below = RULES[rule]
    return F.col(f"{m}.{above}") / F.greatest(F.col(f"{m}.{below}"), F.lit(1))


def stratum(language: Column) -> Column:
    return F.when(language.isin(*LANGUAGES), language).otherwise(F.lit("other"))


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= x), summed from its largest term on until terms no longer count: about sqrt(n) of them."""
    if x >= n:
        return 1.0
    largest = min(x, int((n + 1) * p))
    log = math.lgamma(n + 1) - math.lgamma(largest + 1) - math.lgamma(n - largest + 1) + largest * math.log(p) + (n - largest) * math.log1p(-p)
    odds, total = p / (1 - p), 0.0
    term, k = 1.0, largest
    while k >= 0 and term > 1e-18 * total:
        total += term
        term, k = term * k / ((n - k + 1) * odds), k - 1
    term, k = (n - largest) * odds / (largest + 1), largest + 1
    while k <= x and term > 1e-18 * total:
        total += term
        term, k = term * (n - k) * odds / (k + 1), k + 1
    return min(1.0, math.exp(log) * total)


def certify(rejected: list[int], n: int, share: float, error: float, ladder=LADDER) -> float | None:
    """The strictest cutoff reached down the ladder; ``rejected[i]`` good rows of ``n`` lie above ``ladder[i]``."""
    held = None
    for cutoff, x in zip(ladder, rejected):
        if not n or x > n * share or binomial_cdf(x, n, share) > error:
            break
        held = cutoff
    return held


def cutoffs(good: DataFrame, risk: float = RISK, error: float = ERROR) -> dict[tuple[str, str], float]:
    """``(stratum, rule) -> cutoff`` from good rows with ``stratum`` and ``m_``; absent where none is certified.

    One row of counts for each stratum comes back: five rows, whatever the corpus.
    """
    counts = [F.sum((ratio(rule) > cutoff).cast("long")).alias(f"{rule}_{i}")
              for rule in RULES for i, cutoff in enumerate(LADDER)]
    rows = good.groupBy("stratum").agg(F.count("*").alias("n"), *counts).collect()
    tests = len(RULES) * (len(LANGUAGES) + 1)
    found = {}
    for row in rows:
        for rule in RULES:
            held = certify([row[f"{rule}_{i}"] for i in range(len(LADDER))], row["n"], risk / len(RULES), error / tests)
            if held is not None:
                found[row["stratum"], rule] = held
    return found


def verdict(found: dict[tuple[str, str], float]) -> Column:
    """True where no certified cutoff is passed; needs ``stratum`` and ``m_``."""
    passed = F.lit(False)
    for (name, rule), cutoff in sorted(found.items()):
        passed = passed | ((F.col("stratum") == name) & (ratio(rule) > cutoff))
    return ~passed


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
          language: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``key``, the measures, ``base_failed`` and ``kept`` for each row."""
    rows = docs.select(F.col(key).alias("id"), stratum(F.col(language)).alias("stratum"), F.col(text).alias("text_"))
    table = stored(measured(rows, "text_").drop("text_"), "measures")
    found = cutoffs(good_rows(table, labels, label, key), risk, error)
    return table.select(F.col("id").alias(key), *[F.col(f"m_.{m}") for m in MEASURES], base_failed().alias("base_failed"),
                        (~base_failed() & verdict(found)).alias("kept"), "stratum")


def good_rows(table: DataFrame, labels: DataFrame, label: str, key: str) -> DataFrame:
    """Holdout rows labelled good that the base rule passes."""
    good = labels.where(F.col(label) == 1).select(F.col(key).alias("id")).distinct()
    return table.where(~base_failed()).join(good, "id", "left_semi")


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
              language: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that are kept. Good holdout rows are measured first, then every row."""
    rows = packed(docs).select("row_", F.col(f"row_.{key}").alias("id"), F.col(f"row_.{text}").alias("text_"),
                               stratum(F.col(f"row_.{language}")).alias("stratum"))
    plain = measured(docs.select(F.col(key).alias("id"), stratum(F.col(language)).alias("stratum"),
                                 F.col(text).alias("text_")), "text_").drop("text_")
    table = stored(plain, "measures")
    found = cutoffs(good_rows(table, labels, label, key), risk, error)
    return measured(rows, "text_").where(~base_failed() & verdict(found)).select("row_.*")
