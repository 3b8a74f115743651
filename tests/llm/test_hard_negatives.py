"""Hard negatives against all pairs; the bounds leave out work and nothing else."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from transitlake.llm import hard_negatives as H
from transitlake.llm.tables import prepare

SCHEMA = "vec_id long, label int, embedding array<float>"


def brute(rows, every, k=5, n=10, shares=(30, 90, 100)):
    part = []
    for at, (key, label, vector) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.append((at, key, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for at, key, label, v in part:
        if key is None or key % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), math.inf if other is None else other, other, tag)
                         for row, other, tag, w in part if row != at), key=lambda s: s[:2])
        for p in [s for s in scored if s[3] == label][:k]:
            pos = -p[0]
            window = [s for s in scored if s[3] != label and shares[0] * pos <= -s[0] * shares[2] <= shares[1] * pos][:n]
            out += [(key, p[2], r + 1, s[2], pos, -s[0]) for r, s in enumerate(window)]
    return sorted(out, key=repr)


def mined(spark, rows, every, group=H.GROUP, block=H.BLOCK):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS run", "2 AS anchor", "3 AS score", "4 AS rank", "5 AS `group`")
    prepare(spark)
    key = F.col("vec_id")
    part = H.taking_part(df, key, F.col("label"), F.col("embedding"), key % every == 0)
    return sorted(map(tuple, H.mine(part, group=group, block=block).collect()), key=repr)


def clustered(n, width, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width)) * 3
    which = rng.integers(0, 6, n)
    vectors = centres[which] + 0.3 * rng.standard_normal((n, width))
    return [(i, int(rng.integers(0, labels)), [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]


def test_equals_all_pairs_over_several_groups_and_runs(spark, monkeypatch):
    rows = clustered(300, 6, 1)
    assert mined(spark, rows, 5, group=90, block=16) == brute(rows, 5)


def test_awkward_rows(spark):
    rows = clustered(60, 4, 2, labels=2)
    rows += [(None, 0, [1.0, 1.0, 1.0, 1.0]), (100, None, [1.0]), (101, 0, None), (102, 1, [1.0, None]), (103, 0, [float("nan")]),
             (104, 0, [float("inf"), 1.0]), (105, 0, []), (106, 1, [0.5]), (107, 0, [3.0] * 9), (105, 0, []), (110, 1, [2.0, 2.0, 2.0, 2.0]),
             (111, 0, [2.0, 2.0, 2.0, 2.0]), (112, 0, [2.0, 2.0, 2.0, 2.0]), (-5, 0, [1.0, -1.0, 0.5, 0.25])]
    assert mined(spark, rows, 5, group=20, block=4) == brute(rows, 5)
    assert mined(spark, [], 5) == mined(spark, rows[:1], 5) == mined(spark, [(5, None, [1.0])], 5) == []


def test_equal_vectors_and_hot_label(spark):
    rng = random.Random(4)
    rows = [(i, 1 if i % 3 else 2, [0.5, 0.25] if i % 2 else [rng.uniform(-1, 1), 0.3]) for i in range(120)]
    assert mined(spark, rows, 10, group=25, block=4) == brute(rows, 10)


@pytest.mark.parametrize("size", [1e6, 1e15])
def test_large_components(spark, size):
    """Exact beyond 2^53; what does not fit a long counts as the nearest one, in the windows too."""
    rng = random.Random(5)
    rows = [(i, i % 2, [float(np.float32(rng.uniform(0.2, 1) * size)) for _ in range(3)]) for i in range(40)]
    got = mined(spark, rows, 10, group=15)
    if size == 1e6:
        assert got == brute(rows, 10) and max(r[4] for r in got) > 1 << 53
    else:
        assert all(r[4] == 2 ** 63 - 1 for r in got)


def test_bounds_hold_and_save_scores():
    """On clustered rows most pairs are never scored; what is found stays exact."""
    rows = clustered(3000, 8, 6)
    vectors = np.floor(256 * np.array([v for _, _, v in rows]))
    order, parents, edges = H.spanning(vectors[:100])
    assert sorted(order) == list(range(100)) and parents[0] == -1 and (parents[1:] < np.arange(1, 100)).all()
    placed = vectors[order]
    for k in range(1, 100):
        assert edges[k] == pytest.approx(np.linalg.norm(placed[k] - placed[parents[k]]))
    batch = pa.RecordBatch.from_pydict({"row": list(range(3000)), "vec_id": list(range(3000)), "label": [r[1] for r in rows],
                                        "vector": [list(v) for v in vectors]})
    candidates = H.Candidates([batch])
    anchors = {"row": order, "id": order, "label": np.array([rows[k][1] for k in order]), "parent": parents, "edge": edges, "vector": placed}
    found, counts = H.Found(100, 5), {}

    def offer(a, c, score):
        yield a, score, c

    H.sweep(candidates, placed[:1], anchors, np.full((100, 1), -np.inf), np.full((100, 1), np.inf), found, offer, counts)
    scores = placed @ vectors.T
    for a in range(100):
        scores[a, order[a]] = -np.inf
        wanted = sorted(range(3000), key=lambda c: (-scores[a, c], c))[:5]
        mine = found.list == a
        assert list(found.id[mine]) == wanted
    assert counts["scored"] < 0.9 * counts["pairs"]


def test_minimum_spanning_tree():
    rng = np.random.default_rng(8)
    points = rng.standard_normal((9, 2))
    length = H.spanning(points)[2].sum()
    distances = sorted((np.linalg.norm(points[i] - points[j]), i, j) for i in range(9) for j in range(i))
    root, total = list(range(9)), 0.0
    for d, i, j in distances:  # Kruskal's rule
        if root[i] != root[j]:
            total += d
            root = [root[i] if r == root[j] else r for r in root]
    assert length == pytest.approx(total)
