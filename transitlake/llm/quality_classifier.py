"""A quality classifier: linear support vectors over naive Bayes features.

A text is a set of n-gram indicators, hashed to a fixed number of places: byte
4-grams, words, word pairs, and runs of word *shapes* (case, length, last character,
same word as before). An indicator is scaled by its class log-count ratio, and a
linear hinge loss is fitted by dual coordinate descent. A logistic curve fitted on a
part of the sample that the descent has not seen turns margins into probabilities.

The model is fitted on a bounded sample of labelled rows (``sample``, chosen by a hash
of the key); every row is scored over its whole text. A model has ``PLACES`` weights,
whatever the corpus. Null and empty texts have no indicators: they get the score of
the bias. Without labels, or with one class only, the score is the share of label 1
(0.5 without any). Rows with a null label are not used; of several labels for one key
the largest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm import text as T
from transitlake.llm.tables import prepare

BITS = 18
PLACES = 1 << BITS
SAMPLE = 6000

_SHAPE = np.zeros(256, dtype=np.uint64)  # classes of the bytes of a word
for _low, _high, _kind in ((0x30, 0x39, 1), (0x41, 0x5A, 2), (0x61, 0x7A, 3), (0x80, 0xFF, 3)):
    _SHAPE[_low:_high + 1] = _kind
for _byte in range(0x21, 0x7F):
    if not _SHAPE[_byte]:
        _SHAPE[_byte] = 4 + _byte


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def indicators(block: T.Block):
    """For each document of a block the sorted places of its indicators."""
    data, bounds = block.data, block.word_offsets
    grams = np.zeros(0, np.int64)
    if len(data) >= 4:
        count = len(data) - 3
        grams = np.zeros(count, np.uint64)
        for k in range(4):
            grams = (grams << np.uint64(8)) | data[k:k + count].astype(np.uint64)
        grams = _places(T.mix(grams))
    words = block.word_hashes()
    count = len(words)
    owner = block.words_by_document()
    follows = np.zeros(count, dtype=bool)
    follows[1:] = owner[1:] == owner[:-1]
    before = np.where(follows, np.roll(words, 1), np.uint64(1))
    lengths = block.ends - block.starts
    shape = np.zeros(0, np.uint64)
    if count:
        shape = (_SHAPE[data[block.starts]] + _SHAPE[data[block.ends - 1]] * np.uint64(131)
                 + _SHAPE[data[np.minimum(block.starts + 1, block.ends - 1)]] * np.uint64(17161)
                 + np.minimum(lengths // 4, 6).astype(np.uint64) * np.uint64(2248091)
                 + (words == before).astype(np.uint64) * np.uint64(294499921))
    shape_before = np.where(follows, np.roll(shape, 1), np.uint64(0))
    of_words = np.stack([_places(T.mix(words + np.uint64(1))), _places(T.mix(words + before * np.uint64(3))),
                         _places(T.mix(shape + np.uint64(2))),
                         _places(T.mix(shape * np.uint64(31) + shape_before + np.uint64(3)))]) \
        if count else np.zeros((4, 0), np.int64)
    seen = np.zeros(PLACES, dtype=bool)
    for i in range(block.n):
        low, high = block.offsets[i], block.offsets[i + 1]
        seen[grams[low:max(low, high - 3)]] = True
        seen[of_words[:, bounds[i]:bounds[i + 1]].ravel()] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


@dataclass
class Model:
    weights: np.ndarray  # of the indicators, log-count ratios included
    slope: float
    offset: float

    def score(self, found: np.ndarray) -> float:
        margin = float(self.weights[found].sum()) / np.sqrt(len(found)) if len(found) else 0.0
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with smoothed targets."""
    positive, negative = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    scale = float(np.abs(x).mean()) or 1.0
    design = np.stack([x / scale, np.ones(len(x))])
    beta = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -35, 35)))
        gradient = design @ (p - target) + 1e-3 * beta
        hessian = (design * (p * (1 - p) + 1e-9)) @ design.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
    return float(beta[0] / scale), float(beta[1])


def descend(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 12,
            smoothing: float = 1.0) -> np.ndarray:
    """Weights of the indicators from dual coordinate descent on the hinge loss."""
    counts = np.full((2, PLACES), smoothing)
    for found, label in zip(rows, labels):
        counts[label][found] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum()))
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.bincount(labels, minlength=2) / len(labels)
    bounds = cost * 0.5 / share[labels]  # both classes weigh the same
    values = [ratio[found] / np.sqrt(max(1, len(found))) for found in rows]
    norms = np.array([float(v @ v) + 1.0 for v in values])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(PLACES), 0.0
    random = np.random.default_rng(11)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            gradient = signs[i] * (float(weights[rows[i]] @ values[i]) + bias) - 1.0
            moved = min(max(alpha[i] - gradient / norms[i], 0.0), bounds[i])
            change = (moved - alpha[i]) * signs[i]
            if change:
                weights[rows[i]] += change * values[i]
                bias += change
                alpha[i] = moved
    return weights * ratio


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    labels = np.asarray(labels, dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(np.zeros(PLACES, np.float32), 0.0, float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -9, 9)))
    part = np.random.default_rng(5).permutation(len(rows)) % 4
    learn, rest = np.flatnonzero(part != 0), np.flatnonzero(part == 0)
    if len(set(labels[learn].tolist())) < 2 or len(set(labels[rest].tolist())) < 2:
        learn = rest = np.arange(len(rows))
    weights = descend([rows[i] for i in learn], labels[learn]).astype(np.float32)
    margins = np.array([weights[rows[i]].sum() / np.sqrt(max(1, len(rows[i]))) for i in rest])
    return Model(weights, *logistic(margins, labels[rest]))


def train(docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` of the rows of ``labels``, the first by a hash of the key."""
    prepare(docs.sparkSession)
    chosen = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")) \
        .agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(sample)

    def run(batches):
        for batch in batches:
            found = [x.astype(np.int32) for block in T.blocks(batch.column(1)) for x in indicators(block)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.zeros(0, np.int32)]))),
            ], names=["id", "label", "found"])

    # the chosen labels are at most ``sample`` rows of two numbers
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id") \
        .dropDuplicates(["id"]).mapInArrow(run, f"id {dict(docs.dtypes)[key]}, label int, found array<int>")
    table = rows.toArrow().sort_by("id")
    values = table["found"].combine_chunks()
    offsets, flat = values.offsets.to_numpy(), values.values.to_numpy()
    return fit([flat[a:b] for a, b in zip(offsets, offsets[1:])], table["label"].to_numpy())


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for each row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(x) for block in T.blocks(batch.column(1)) for x in indicators(block)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")) \
        .mapInArrow(run, f"id {dict(docs.dtypes)[key]}, score double").withColumnRenamed("id", key)
