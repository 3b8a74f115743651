"""Hard negatives by bounds along a spanning tree of the anchors.

An anchor's *positives* are its first rows of the same label by inner product; for each
positive its *hard negatives* are the first rows of another label whose score lies in a window
of shares of the positive's. Higher scores come first, ties go to the smaller id.

**Tree.** Anchors are range-partitioned by the signs of seeded projections and cut into runs
of ``BLOCK``; a run is joined by its shortest edges (Prim), so an anchor hangs on a near one,
and the runs' roots hang on the root of all, the anchor that sorts first. The tree is a stored
table.

**Bounds.** A candidate c scores with a child anchor within ``edge length * norm(c)`` of its
score with the parent, as ``|<a, c> - <p, c>| <= |a - p| |c|``. Down the tree a task keeps such an
interval for each candidate, exact where it was scored, and scores again only candidates
whose interval meets a window that still has room: for positives what reaches the last of
the first five so far, for negatives what lies in a positive's window and reaches the last of
its first ten so far. Nothing else is left out, so results are exact.

**Layout.** Candidates are dealt by row number into groups of about ``GROUP`` rows, or ``GROUP_BYTES``, tree
runs into slices; a task streams a group's rows and then each anchor run of a slice, and
holds one group and one run. Every anchor is sent once to each group, every candidate
once to each slice; slices only spread the work where there are few groups. A
group's best few rows per anchor are merged by a window. Work grows with anchors times rows, as a
search of all rows for a hundredth of them must; memory and partial results do not.

Scores are sums of products of whole numbers: floats where they are exact, 64-bit or Python's
integers beyond; a score that does not fit a long is returned as the nearest long, and a positive's
window is that of its returned score.

Defined cases. Rows with a null label or vector, or a component that is null or not finite (once
multiplied), take no part. Vectors of other lengths count as padded with zeros, an empty one as zeros.
Repeated rows are rows of their own: each is anchor, positive and negative by itself, so their
results repeat; ties of equal ids are broken by an arbitrary, stored row number. A null id is no
anchor, sorts last and is never divisible. Anchors without positives and positives without
negatives have no row. An empty table gives no row. Extra columns are not read, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transitlake.llm.tables import stored

BLOCK = 128
GROUP = 65536
GROUP_BYTES = 64 << 20
CHUNK = 2048
PROJECTIONS = 24
LONGS = np.iinfo(np.int64)
NO_ID = LONGS.max

ROWS = "row long, vec_id long, label int, anchor boolean, vector array<double>"
TREE = "run long, place int, parent int, edge double, row long, vec_id long, label int, vector array<double>"
POSITIVES = "anchor_row long, anchor_id long, row long, vec_id long, score long"
NEGATIVES = "anchor_row long, anchor_id long, rank_of_positive int, positive_id long, positive_score long, row long, vec_id long, score long"


def taking_part(df: DataFrame, id: Column, label: Column, vector: Column, anchor: Column, scale: float = 256.0) -> DataFrame:
    """Stored rows with a number, and components ``floor(scale * x)``."""
    doubled = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(doubled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    rows = df.where(label.isNotNull() & vector.isNotNull() & ~bad)
    # floor() of a double is a long in Spark, too narrow here: whole numbers stay doubles
    scaled = F.transform(doubled, lambda x: F.when(F.abs(x * scale) < float(1 << 52), F.floor(x * scale).cast("double")).otherwise(x * scale))
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), id.cast("long").alias("vec_id"),
                              label.cast("int").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), scaled.alias("vector")), "vectors")


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of an array column, padded with zeros to the widest or to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.asarray(column.offsets)
    lengths = np.diff(offsets)
    wide = max(int(lengths.max(initial=0)), width or 0, 1)
    flat = np.asarray(column.values)[offsets[0]:offsets[-1]] if len(lengths) else np.zeros(0)
    if len(lengths) and (lengths == wide).all():
        return flat.reshape(len(lengths), wide).astype(np.float64)
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = flat
    return out


def _widened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, wide - m.shape[1]))) if m.shape[1] < wide else m for m in (a, b))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: floats below 2^53, else 64-bit or Python integers."""
    a, b = _widened(a, b)
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0 ** 53:
        return a @ b.T
    if bound < 2.0 ** 62 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    return whole[0] @ whole[1].T


# -- the tree --------------------------------------------------------------------------

def _sign_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = _matrix(batch.column("vector"))
        # a plane's components are made as far as a vector is wide; the first ones stay the same
        planes = np.stack([np.random.default_rng((7, k)).standard_normal(vectors.shape[1]) for k in range(PROJECTIONS)])
        with np.errstate(over="ignore", invalid="ignore"):
            signs = (vectors @ planes.T > 0).astype(np.int64)
        key = signs @ (1 << np.arange(PROJECTIONS, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(key), *batch.columns], names=["key", *batch.schema.names])


def spanning(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order, parents (as places in the order, -1 for the root) and edge lengths by Prim's rule."""
    n = len(vectors)
    order, parents, edges = [0], np.full(n, -1), np.zeros(n)
    near = np.full(n, np.inf)
    link = np.zeros(n, dtype=int)
    left = np.ones(n, dtype=bool)
    left[0] = False
    for k in range(1, n):
        newest = order[-1]
        with np.errstate(over="ignore"):
            away = np.sqrt(((vectors - vectors[newest]) ** 2).sum(axis=1))
        closer = left & (away < near)
        near[closer], link[closer] = away[closer], k - 1
        nearest = int(np.argmin(np.where(left, near, np.inf)))
        if not left[nearest]:  # only infinite edges are left
            nearest = int(np.flatnonzero(left)[0])
        left[nearest] = False
        order.append(nearest)
        parents[k], edges[k] = link[nearest], near[nearest]
    return np.array(order), parents, edges


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, run, held = TaskContext.get().partitionId(), 0, []

    def cut(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        order, parents, edges = spanning(_matrix(rows.column("vector")))
        rows = rows.take(pa.array(order))
        n = len(order)
        columns = [pa.array(np.full(n, (part << 32) + run)), pa.array(np.arange(n, dtype=np.int32)), pa.array(parents.astype(np.int32)),
                   pa.array(edges)] + [rows.column(c).combine_chunks() for c in ("row", "vec_id", "label", "vector")]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns],
                                          names=["run", "place", "parent", "edge", "row", "vec_id", "label", "vector"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK:
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= BLOCK:
                yield cut(rows.slice(0, BLOCK))
                run, rows = run + 1, rows.slice(BLOCK)
            held = rows.to_batches()
    rows = pa.Table.from_batches(held) if held else None
    if rows is not None and rows.num_rows:
        yield cut(rows)


def anchor_tree(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The anchors with their run, place in it, parent's place (-1: the root of all) and edge length."""
    anchors = rows.where("anchor").select("row", "vec_id", "label", "vector")
    count = anchors.count()
    keyed = anchors.mapInArrow(_sign_keys, "key long, row long, vec_id long, label int, vector array<double>")
    parts = max(1, count // (32 * block))
    cut = keyed.repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row").drop("key")
    return stored(cut.mapInArrow(_runs, TREE), "tree")


# -- the sweep -------------------------------------------------------------------------

class Found:
    """The first ``k`` of each list seen so far: score downwards, then id, then row."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.last = np.full(lists, -np.inf)  # what a list that is full asks at least
        self.list = np.zeros(0, np.int64)
        self.id, self.row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.score: np.ndarray = np.zeros(0, np.int64)

    def add(self, lists: np.ndarray, score: np.ndarray, id: np.ndarray, row: np.ndarray) -> None:
        if not len(lists):
            return
        score = np.concatenate([self.score, score])
        lists, id, row = np.concatenate([self.list, lists]), np.concatenate([self.id, id]), np.concatenate([self.row, row])
        down = -score if score.dtype != object else -np.unique(score, return_inverse=True)[1]
        order = np.lexsort((row, id, down, lists))
        at = lists[order]
        begins = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rank = np.arange(len(at)) - np.repeat(begins, np.diff(np.r_[begins, len(at)]))
        keep = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.list, self.score, self.id, self.row = lists[keep], score[keep], id[keep], row[keep]
        self.last[lists[full]] = [_down(s) for s in score[full]]


def _down(x) -> float:
    """A float not above a whole number of any size."""
    return float(x) if abs(x) < 1 << 53 else float(np.nextafter(float(x), -np.inf))


def _levels(parents: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parents), dtype=int)
    for k, p in enumerate(parents):
        depth[k] = depth[p] + 1 if p >= 0 else 0
    return [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]


class Candidates:
    """One group of rows, as a matrix with norms."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.row = np.asarray(table.column("row").combine_chunks())
        self.id = np.asarray(table.column("vec_id").combine_chunks().fill_null(NO_ID))
        self.label = np.asarray(table.column("label").combine_chunks())
        self.vectors = _matrix(table.column("vector"))
        with np.errstate(over="ignore"):
            self.norms = np.sqrt((self.vectors ** 2).sum(axis=1)) * (1 + 1e-9)


def sweep(candidates: Candidates, root: np.ndarray, anchors: dict, low: np.ndarray, high: np.ndarray, found: Found,
          offer, counts: dict | None = None) -> None:
    """Go down one run for all candidates, chunk by chunk.

    ``low``, ``high`` (anchors x windows) bound the scores that are of use; window w of anchor a is list
    ``a * windows + w`` of ``found``. ``offer(anchor indices, candidate indices, scores)`` yields what
    was scored as (list, score, candidate) arrays.
    """
    vectors, parents, edges, rows = anchors["vector"], anchors["parent"], anchors["edge"] * (1 + 1e-9), anchors["row"]
    windows = low.shape[1]
    levels = _levels(parents)
    from_root = np.sqrt(((np.subtract(*_widened(vectors[:1], root))) ** 2).sum(axis=1))[0] * (1 + 1e-9)
    for begin in range(0, len(candidates.row), CHUNK):
        part = slice(begin, min(begin + CHUNK, len(candidates.row)))
        here, norms = candidates.vectors[part], candidates.norms[part]
        least, most = np.empty((len(parents), len(norms))), np.empty((len(parents), len(norms)))
        at_root = products(root, here).astype(np.float64)
        for level in levels:
            if parents[level[0]] < 0:  # the run's root hangs on the root of all
                near = from_root * norms
                bottom, top = at_root - near, at_root + near
            else:
                near = edges[level][:, None] * norms
                bottom, top = least[parents[level]] - near, most[parents[level]] + near
            slack = 1e-6 + 1e-9 * np.maximum(np.abs(bottom), np.abs(top))
            bottom, top = bottom - slack, top + slack
            bottom[np.isnan(bottom)], top[np.isnan(top)] = -np.inf, np.inf
            last = found.last.reshape(-1, windows)[level]
            wanted = np.zeros(bottom.shape, dtype=bool)
            for w in range(windows):
                floor = np.maximum(low[level, w], last[:, w])[:, None]
                wanted |= (top >= floor) & (bottom <= high[level, w][:, None])
            wanted &= rows[level][:, None] != candidates.row[part][None, :]
            across = np.flatnonzero(wanted.any(axis=0))
            down = np.flatnonzero(wanted.any(axis=1))
            if counts is not None:
                counts["pairs"] = counts.get("pairs", 0) + wanted.size
                counts["scored"] = counts.get("scored", 0) + int(wanted.sum())
            if len(across):
                scores = products(vectors[level[down]], here[across])
                a, c = np.nonzero(wanted[np.ix_(down, across)])
                exact = scores[a, c] if scores.dtype == object else scores[a, c].astype(np.int64)
                bottom[down[a], across[c]] = top[down[a], across[c]] = exact.astype(np.float64)
                for lists, score, which in offer(level[down[a]], begin + across[c], exact):
                    found.add(lists, score, candidates.id[which], candidates.row[which])
            least[level], most[level] = bottom, top


def _longs(values: np.ndarray) -> np.ndarray:
    if values.dtype == object:
        return np.array([min(max(int(v), LONGS.min), LONGS.max) for v in values], dtype=np.int64)
    return values.astype(np.int64)


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, mask=values == NO_ID)


def _positives(candidates: Candidates, root: np.ndarray, run: pa.Table, k: int) -> pa.RecordBatch:
    anchors = _anchors(run)
    n = len(anchors["row"])
    found = Found(n, k)

    def offer(a, c, score):
        same = anchors["label"][a] == candidates.label[c]
        yield a[same], score[same], c[same]

    sweep(candidates, root, anchors, np.full((n, 1), -np.inf), np.full((n, 1), np.inf), found, offer)
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors["row"][found.list]), _ids(anchors["id"][found.list]), pa.array(found.row), _ids(found.id), pa.array(_longs(found.score))],
        names=["anchor_row", "anchor_id", "row", "vec_id", "score"])


def _anchors(run: pa.Table) -> dict:
    one = run.combine_chunks()
    return {"row": np.asarray(one.column("row").combine_chunks()), "id": np.asarray(one.column("vec_id").combine_chunks().fill_null(NO_ID)),
            "label": np.asarray(one.column("label").combine_chunks()), "parent": np.asarray(one.column("parent").combine_chunks()),
            "edge": np.asarray(one.column("edge").combine_chunks()), "vector": _matrix(one.column("vector"))}


def _negatives(candidates: Candidates, root: np.ndarray, run: pa.Table, k: int, shares: tuple[int, int, int]) -> pa.RecordBatch:
    anchors = _anchors(run)
    n = len(anchors["row"])
    lists = run.column("positives").combine_chunks()
    offsets, items = np.asarray(lists.offsets), lists.values
    sizes = np.diff(offsets)
    windows = max(int(sizes.max(initial=0)), 1)
    least_share, most_share, whole = shares
    scores = np.asarray(items.field("score"))
    ids = np.asarray(items.field("vec_id").fill_null(NO_ID))
    low, high = np.full((n, windows), np.inf), np.full((n, windows), -np.inf)
    stated = np.zeros((n, windows), dtype=object)
    for a in range(n):
        for w in range(sizes[a]):
            positive = int(scores[offsets[a] + w])
            stated[a, w] = positive
            # a window's ends as floats, a little wider; each offer is held against them exactly
            ends = float(least_share * positive) / whole, float(most_share * positive) / whole
            low[a, w], high[a, w] = ends[0] - 1 - abs(ends[0]) * 1e-12, ends[1] + 1 + abs(ends[1]) * 1e-12
    found = Found(n * windows, k)
    large = len(scores) > 0 and max(abs(int(scores.max())), abs(int(scores.min()))) > 1 << 50

    def offer(a, c, score):
        other = anchors["label"][a] != candidates.label[c]
        a, c, score = a[other], c[other], score[other]
        for w in range(windows):
            has = (score >= np.maximum(low[a, w], found.last[a * windows + w])) & (score <= high[a, w])
            if has.any():
                a_, c_, s_ = a[has], c[has], score[has]
                p_ = stated[a_, w] if s_.dtype == object or large or np.abs(s_).max() > 1 << 50 else stated[a_, w].astype(np.int64)
                s = s_.astype(object) if p_.dtype == object else s_
                exact = ((least_share * p_ <= whole * s) & (whole * s <= most_share * p_)).astype(bool)
                yield a_[exact] * windows + w, s_[exact], c_[exact]

    sweep(candidates, root, anchors, low, high, found, offer)
    a, w = found.list // windows, found.list % windows
    at = offsets[a] + w
    return pa.RecordBatch.from_arrays(
        [pa.array(anchors["row"][a]), _ids(anchors["id"][a]), pa.array(w.astype(np.int32)), _ids(ids[at]),
         pa.array(scores[at]), pa.array(found.row), _ids(found.id), pa.array(_longs(found.score))],
        names=["anchor_row", "anchor_id", "rank_of_positive", "positive_id", "positive_score", "row", "vec_id", "score"])


def _streamed(search):
    """Over rows sorted by (group, slice, run, place): candidates (run -2), the root (-1), then runs."""
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, candidates, root, run, held = None, None, None, None, []

        def finish():
            nonlocal candidates, root
            if run is None:
                return None
            if run == -2:
                candidates, root = Candidates(held), None
            elif run == -1:
                root = _matrix(held[0].column("vector"))
            elif candidates is not None:
                return search(candidates, root, pa.Table.from_batches(held))
            return None

        for batch in batches:
            keys = list(zip(batch.column("group").to_pylist(), batch.column("slice").to_pylist(), batch.column("run").to_pylist(), strict=True))
            begin = 0
            while begin < len(keys):
                end = begin + 1
                while end < len(keys) and keys[end] == keys[begin]:
                    end += 1
                if (cell, run) != (keys[begin][:2], keys[begin][2]):
                    result = finish()
                    if result is not None and result.num_rows:
                        yield result
                    if cell != keys[begin][:2]:
                        candidates = root = None
                    cell, run, held = keys[begin][:2], keys[begin][2], []
                held.append(batch.slice(begin, end - begin))
                begin = end
        result = finish()
        if result is not None and result.num_rows:
            yield result
    return go


def searched(rows: DataFrame, tree: DataFrame, search, schema: str, group: int = GROUP) -> DataFrame:
    """``search(candidates, root, run)`` for every group of rows and every run of the tree."""
    spark = rows.sparkSession
    total, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    runs = tree.select("run").distinct().count()
    fitting = max(CHUNK, GROUP_BYTES // (8 * max(width or 1, 1)))  # a group is a matrix in a task's memory
    groups = max(1, -(-total // min(group, fitting)))
    slices = max(1, min(runs, 4 * spark.sparkContext.defaultParallelism // groups))
    extra = [f for f in tree.columns if f not in ("run", "place", "parent", "edge", "row", "vec_id", "label", "vector")]
    nulls = [F.lit(None).cast(tree.schema[f].dataType).alias(f) for f in extra]
    shared = ["row", "vec_id", "label", "vector"]
    spread = rows.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
                         F.lit(-2).cast("long").alias("run"), F.lit(0).alias("place"), F.lit(0).alias("parent"), F.lit(0.0).alias("edge"),
                         *shared, *nulls)
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group")
    sent = tree.select(everywhere, F.pmod(F.xxhash64("run"), F.lit(slices)).cast("int").alias("slice"), "run", "place", "parent", "edge", *shared, *extra)
    top = tree.where("place = 0").orderBy("run").limit(1).select(*shared)  # the root of all
    rooted = top.select(everywhere, *shared).select(
        "group", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(-1).cast("long").alias("run"), F.lit(0).alias("place"),
        F.lit(0).alias("parent"), F.lit(0.0).alias("edge"), *shared, *nulls)
    cells = spread.unionByName(rooted).unionByName(sent).repartition(groups * slices, "group", "slice")
    return cells.sortWithinPartitions("group", "slice", "run", "place", "row").mapInArrow(_streamed(search), schema)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 10, shares: tuple[int, int, int] = (30, 90, 100),
         group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """Hard negatives for rows as of :func:`taking_part`.

    A negative's score lies between ``shares[0]`` and ``shares[1]`` parts of ``shares[2]`` of the positive's.
    """
    tree = anchor_tree(rows, block)
    found = searched(rows, tree, lambda c, r, run: _positives(c, r, run, positives), POSITIVES, group)
    nulls_last = F.coalesce("vec_id", F.lit(NO_ID))
    best = Window.partitionBy("anchor_row").orderBy(F.desc("score"), nulls_last, "row")
    first = stored(found.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= positives), "positives")
    listed = first.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score", "row"))).alias("positives"))
    aimed = stored(tree.join(listed, tree["row"] == listed["anchor_row"], "left").select(
        *tree.columns, F.coalesce("positives", F.array().cast("array<struct<rank:int,vec_id:bigint,score:bigint,row:bigint>>")).alias("positives")), "aimed")
    met = searched(rows, aimed, lambda c, r, run: _negatives(c, r, run, negatives, shares), NEGATIVES, group)
    best = Window.partitionBy("anchor_row", "rank_of_positive").orderBy(F.desc("score"), nulls_last, "row")
    ranked = met.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score"))
