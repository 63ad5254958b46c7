"""Hard negatives: for an anchor and each of its positives, the best-scoring
rows of other labels within a window of the positive's score.

Components are quantised to integers and a score is an integer inner product,
so results are exact.  The search uses cover trees over norm-augmented
candidates: with R the largest norm, a vector x becomes (x, sqrt(R^2 - |x|^2)) / R,
a unit vector, and for a query q the inner product q.x is |q| R times that of
unit vectors.  A tree node with centre c and covering radius rho then holds
only rows with scores within |q| R rho of q.c, so a node whose interval misses
the wanted window, or whose upper bound is below the k-th best score found, is
skipped with everything below it.  What is left is verified by exact scores,
best bound first.

The top level is spread over tasks.  Centres come from a bounded sample (at
most ``SAMPLE`` rows by hash; about the square root of the rows' number, so
nodes and centres both grow with the table); every row belongs to its nearest
centre, nodes above ``BLOCK`` rows are dealt into blocks by hash, and a block is
the unit of a task's tree.  Anchors are sent only to the nodes whose interval
can matter: the k-th best score within the sample is a lower bound of the
k-th best of all.  Positives are one such search (same label, no window), negatives
a second one with a window for each positive; a shuffle merges at most k rows
of each block.

Defined results: rows with a null label, a null vector or a null or non-finite
component take no part; vectors of different lengths are not compared; a row
without an id can be a positive or a negative (last among ties) and is no
anchor; repeated rows are rows of their own; an anchor without positives, or a
window without rows, gives no rows; an empty table gives no rows.  Scores
beyond the range of a long count as its nearest value.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearbox.llm.common import map_in_arrow, materialise
from gearbox.llm.embedding_dedup import CoverTree, farthest_points

SCALE = 256  # quantisation of the components
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # the window, in percent of the positive's score
SAMPLE = 1 << 12
MOST_CENTRES = 1 << 11
BLOCK = 4096
STRIP = 256  # anchors bounded at once, rows verified at once
SLACK = 1e-6  # rounding of distances, relative to the product of both norms
LONG = (1 << 63) - 1
EXACT = 1 << 53  # integers below it are exact as doubles

Windows = list[tuple[int, int]]


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``x`` with ``q``, within the range of a long."""
    if not x.size:
        return np.zeros(len(x), dtype=np.int64)
    largest = [max(1, -int(v.min()), int(v.max())) for v in (x, q)]
    if largest[0] * largest[1] * x.shape[1] < EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return np.clip(x.astype(object) @ q.astype(object), -LONG, LONG).astype(np.int64)


class Space:
    """Norm augmentation of the vectors of one length; ``norm`` is the largest norm R."""

    def __init__(self, dim: int, norm: float):
        self.dim, self.norm = dim, norm

    def augment(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64) / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", x, x)))
        return np.concatenate([x, rest[:, None]], axis=1)

    def interval(self, q: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest score of the rows of each node (augmented centre, covering
        radius) with each query: a row for a query, a column for a node."""
        size = np.sqrt(np.einsum("ij,ij->i", q, q)) * self.norm
        middle = (q @ centres[:, :-1].T) * self.norm
        reach = size[:, None] * (radius[None, :] + SLACK) + SLACK
        return np.maximum(np.minimum(middle - reach, LONG), -LONG), np.minimum(np.maximum(middle + reach, -LONG), LONG)


class Block:
    """A block's rows under their cover tree, searched for many anchors."""

    def __init__(self, space: Space, row: np.ndarray, ids: pa.Array, label: np.ndarray, x: np.ndarray):
        self.space, self.row, self.label, self.x = space, row, label, x
        self.ids = ids.to_pylist()
        self.rank = np.empty(len(row), dtype=np.int64)  # order among ties: id, null last, then row
        self.rank[np.lexsort((row, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(row))
        self.tree = CoverTree(space.augment(x))
        self.order = np.argsort(self.tree.leaf, kind="stable")
        leaves = len(self.tree.centre[-1]) if self.tree.centre else 1  # no levels: one leaf holds all rows
        self.start = np.searchsorted(self.tree.leaf[self.order], np.arange(leaves + 1))

    def leaves(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves that may hold scores within [low, high] of each query, and their upper bounds:
        level by level, what lies outside goes with everything below it."""
        tree, q = self.tree, q.astype(np.float64)
        alive, most = np.ones((len(q), 1), dtype=bool), np.full((len(q), 1), np.inf)
        for centre, parent, radius in zip(tree.centre, tree.parent, tree.radius):
            least, most = self.space.interval(q, tree.x[centre], radius)
            alive = alive[:, parent] & (most >= low[:, None]) & (least <= high[:, None])
        return alive, most

    def search(self, q: np.ndarray, leaves: np.ndarray, upper: np.ndarray, fits: np.ndarray, windows: Windows,
               k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the first k of the rows that fit, and their scores: leaves are verified
        best bound first, until no window can gain from the next one."""
        order = leaves[np.argsort(-upper[leaves], kind="stable")]
        stops = np.cumsum(self.start[order + 1] - self.start[order])
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
        at = 0
        while at < len(order):
            bound = upper[order[at]]
            if all(bound < low or (len(s) == k and bound < s[-1]) for (low, _), (_, s) in zip(windows, held)):
                break
            to = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + STRIP, side="right")))
            rows = np.concatenate([self.order[self.start[n]:self.start[n + 1]] for n in order[at:to]])
            rows = rows[fits[rows]]
            got = scores(self.x[rows], q)
            for w, (low, high) in enumerate(windows):
                inside = (got >= low) & (got <= high)
                if inside.any():
                    some, s = np.concatenate([held[w][0], rows[inside]]), np.concatenate([held[w][1], got[inside]])
                    first = np.lexsort((self.rank[some], -s))[:k]
                    held[w] = some[first], s[first]
            at = to
        return held

    def answer(self, asked: pa.RecordBatch, same_label: bool, k: int) -> Iterator[tuple]:
        """``(row, window, score, id, found)`` of the anchors of a batch."""
        q, windows = _matrix(asked["v"], self.space.dim), [_pairs(w) for w in asked["windows"].to_pylist()]
        low = np.array([float(min(a for a, _ in w)) for w in windows])
        high = np.array([float(max(z for _, z in w)) for w in windows])
        alive, upper = self.leaves(q, low, high)
        for i in np.flatnonzero(alive.any(axis=1)):
            me, mine = asked["row"][int(i)].as_py(), asked["label"][int(i)].as_py()
            fits = ((self.label == mine) == same_label) & (self.row != me)
            for w, (some, got) in enumerate(self.search(q[i], np.flatnonzero(alive[i]), upper[i], fits, windows[i], k)):
                for r, g in zip(some, got):
                    yield me, w, int(g), self.ids[r], int(self.row[r])


class Top:
    """The level above the blocks: centres out of a bounded sample, with the covering radius and
    the blocks of each one's node.  Small, and sent to the tasks."""

    def __init__(self, space: Space, sample: list, n_rows: int):
        self.space = space
        self.row = np.array([s["row"] for s in sample], dtype=np.int64)
        self.label = np.array([s["label"] for s in sample], dtype=np.int64)
        self.sample = np.array([s["v"] for s in sample], dtype=np.int64).reshape(len(sample), space.dim)
        self.centres = farthest_points(space.augment(self.sample), min(MOST_CENTRES, max(1, isqrt(n_rows) // 8)), 0.125)
        self.radius = np.full(len(self.centres), -10.0)
        self.blocks = np.zeros(len(self.centres), dtype=np.int64)
        self.first = np.zeros(len(self.centres) + 1, dtype=np.int64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = np.sqrt(np.maximum(0.0, 2 - 2 * (self.space.augment(x) @ self.centres.T)))
        return far.argmin(axis=1), far.min(axis=1)

    def measure(self, nodes: list) -> None:
        for s in nodes:
            self.radius[s["node"]], self.blocks[s["node"]] = s["radius"], -(-s["n"] // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(self.blocks)])

    def least(self, row: int, label: int, q: np.ndarray, windows: Windows, same_label: bool, k: int) -> float:
        """A score below which no row is among the first k of any window: the k-th best of the sample."""
        got = scores(self.sample, q)[((self.label == label) == same_label) & (self.row != row)]
        bounds = []
        for low, high in windows:
            inside = np.sort(got[(got >= low) & (got <= high)])
            bounds.append(max(low, int(inside[-k])) if len(inside) >= k else low)
        return float(min(bounds))

    def reached(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and the blocks that may hold scores within [low, high] of them."""
        least, most = self.space.interval(q.astype(np.float64), self.centres, self.radius)
        place, node = np.nonzero((most >= low[:, None]) & (least <= high[:, None]) & (self.blocks > 0)[None, :])
        times = self.blocks[node]
        start = np.cumsum(times) - times
        return np.repeat(place, times), np.arange(times.sum()) + np.repeat(self.first[node] - start, times)


def quantised(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """``row, id, label, v``: the rows that take part, with integer components."""
    v = F.col(vector_col)
    good = v.isNotNull() & F.col(label_col).isNotNull() & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.where(F.coalesce(good, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.col(label_col).cast("long").alias("label"),
                    F.transform(v, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _pairs(flat: list[int]) -> Windows:
    return list(zip(flat[::2], flat[1::2]))


def _top(rows: DataFrame, dim: int) -> Top:
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("s")).first()
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("row", "label", "v").collect()
    top = Top(Space(dim, max(1.0, float(seen["s"]) ** 0.5 * (1 + 1e-12))), sample, seen["n"])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                node, far = top.nearest(_matrix(b.column(0), dim))
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(far)], names=["node", "far"])

    top.measure(rows.select("v").transform(map_in_arrow, assign, "node int, far double").groupBy("node")
                .agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).collect())  # MOST_CENTRES at most
    return top


def _search(top: Top, rows: DataFrame, anchors: DataFrame, same_label: bool, k: int) -> DataFrame:
    """``row, window, score, id, rank`` for ``anchors (row, id, label, v, windows)``: the first k rows of every
    window (``windows`` holds low, high, low, high, ...) among those of the same or of other labels."""
    dim = top.space.dim
    names = ["block", "asks", "row", "id", "label", "v", "windows"]
    found_names = ["row", "window", "score", "id", "found"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                node, _ = top.nearest(_matrix(b.column(3), dim))
                block = top.first[node] + b.column(4).to_numpy() % top.blocks[node]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), pa.array(np.zeros(len(block), bool)), *b.columns[:4],
                     pa.array([None] * len(block), pa.list_(pa.int64()))], names=names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, STRIP):
                part = b.slice(s, STRIP)
                q, windows = _matrix(part.column(3), dim), [_pairs(w) for w in part.column(4).to_pylist()]
                low = np.array([top.least(part.column(0)[i].as_py(), part.column(2)[i].as_py(), q[i], windows[i], same_label, k)
                                for i in range(len(q))])
                high = np.array([float(max(z for _, z in w)) for w in windows])
                place, block = top.reached(q, low, high)
                for c in range(0, len(place), 4096):
                    at = pa.array(place[c:c + 4096])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block[c:c + 4096], pa.int64()), pa.array(np.ones(len(at), bool)),
                         *[column.take(at) for column in part.columns]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for b in batches:
            key, asks = b["block"].to_numpy(), b["asks"].to_numpy(zero_copy_only=False)
            changes = np.flatnonzero((np.diff(key) != 0) | (asks[1:] != asks[:-1])) + 1
            for s, e in zip([0, *changes], [*changes, len(key)]):
                if e == s:
                    continue
                if key[s] != at:
                    at, held, block = key[s], [], None
                if not asks[s]:
                    held.append(b.slice(s, e - s))
                    continue
                if block is None:
                    t = pa.Table.from_batches(held).combine_chunks()
                    held = []
                    block = Block(top.space, t["row"].to_numpy(), t["id"].combine_chunks(), t["label"].to_numpy(),
                                  _matrix(t["v"].combine_chunks(), dim))
                for c in range(s, e, STRIP):
                    out = list(block.answer(b.slice(c, min(STRIP, e - c)), same_label, k))
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
                                                     names=found_names)

    schema = "block bigint, asks boolean, row bigint, id bigint, label bigint, v array<bigint>, windows array<bigint>"
    candidates = rows.select("row", "id", "label", "v", F.pmod(F.xxhash64("row"), F.lit(1 << 30)).alias("h"))
    asked = anchors.select("row", "id", "label", "v", "windows")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (candidates.transform(map_in_arrow, deal, schema).union(asked.transform(map_in_arrow, route, schema))
             .repartition(max(parts, min(int(top.first[-1]), 4 * parts)), "block")
             .sortWithinPartitions("block", "asks", "row")
             .transform(map_in_arrow, run, "row bigint, window bigint, score bigint, id bigint, found bigint"))
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)  # k rows of a block at most come here


def mine(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         anchor: Column | None = None, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         lowest: int = LOWEST, highest: int = HIGHEST) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for every anchor and each of its
    first ``positives`` rows of its label, the first ``negatives`` rows of other labels with a score of
    ``lowest`` to ``highest`` percent of the positive's.

    ``anchor``: a condition on ``id`` (and ``label``) that marks the anchors; default: every row with an id."""
    rows = materialise(quantised(df, id_col, vector_col, label_col, scale), "negatives-rows")
    asks = F.col("id").isNotNull() if anchor is None else F.col("id").isNotNull() & F.coalesce(anchor, F.lit(False))
    out = None
    for dim in sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect()):  # lengths, not vectors
        of_dim = rows.where(F.size("v") == dim)
        top, anchors = _top(of_dim, dim), of_dim.where(asks)
        near = materialise(
            _search(top, of_dim, anchors.withColumn("windows", F.array(F.lit(-LONG), F.lit(LONG))), True, positives)
            .select("row", F.col("rank").cast("long").alias("nth"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
            "negatives-positives")
        score = F.col("positive_score").cast("decimal(20,0)")
        windowed = near.select("row", "nth", F.ceil(score * lowest / 100).cast("long").alias("low"),
                               F.floor(score * highest / 100).cast("long").alias("high"))
        asked = (windowed.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("nth", "low", "high"))).alias("w"))  # few each
                 .select("row", F.flatten(F.transform("w", lambda w: F.array(w["low"], w["high"]))).alias("windows")))
        far = _search(top, of_dim, anchors.join(asked, "row"), False, negatives)
        part = (far.select("row", (F.col("window") + 1).alias("nth"), F.col("rank").cast("int").alias("rank"),
                           F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
                .join(near, ["row", "nth"]).join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
                .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        out = part if out is None else out.union(part)
    if out is None:
        names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        return df.sparkSession.createDataFrame([], ", ".join(f"{c} {'int' if c == 'rank' else 'bigint'}" for c in names))
    return out
