"""Exact threshold pairs of embeddings by dual traversal of cover trees.

Vectors become unit vectors; cosine >= t is then Euclidean distance <= r with
r = sqrt(2 - 2t).  Equal vectors are one class, compared once.

The top of the tree is a farthest-point net over a bounded sample (at most
``SAMPLE`` classes by hash, ``TOP`` centres): every class of the table is
assigned to its nearest centre, and each top node gets its covering radius from
all its members.  A class meets another node only if its distance to the
node's centre is at most the node's radius plus r.  A node is dealt into groups
by hash, few enough that a class is sent about as often as the square root of
the tasks asks for, of at most ``GROUP`` classes; a task holds two groups however
large a node is.

Within a task the groups are cut into blocks of ``BLOCK``, and each block gets a cover
tree of nested levels with radii 1, 1/2, 1/4 and 1/8, as far down as a level still
gathers rows (``GATHERS`` rows a node).  Two blocks' trees are traversed together:
at each level, node pairs whose centres are further apart than r plus both covering
radii are dropped with everything below them.  What is left is compared
through a bound: with vectors turned so that the first coordinates hold the most of the
sample, the cosine is at most the product of the first ``LEADING`` coordinates plus
the product of the two remainders' lengths (Cauchy-Schwarz), one short
single-precision product with room for its rounding.  Only pairs that the bound
lets through are compared, in double precision.  A task reports sums of links and a spanning
forest, never all its pairs.

In data without structure (far apart points in many dimensions) no bound can
drop node pairs, and the work is that of all pairs of distinct vectors, by the
short product.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing (their component is their own id); vectors of
different lengths do not link; repeated rows are separate linked vectors; a
null id is never a component id of others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gearbox.llm.common import connected_components, map_in_arrow, materialise

THRESHOLD = 0.95
SAMPLE = 2048
TOP = 16
GROUP = 32768
BLOCK = 4096
STRIP = 512
GATHERS = 4  # rows a node on average below which a level is not worth its node pairs
HEAD = 256  # rows that may become centres at a time; where most of them do, the level is not worth it either
LEADING = 24
BOUND_SLACK = 1e-4  # rounding of the single-precision bound
LEVELS = (1.0, 0.5, 0.25, 0.125)
SLACK = 1e-6  # rounding of distances from inner products


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision (first by their largest component, against overflow)."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ y.T), 0.0))


def farthest_points(x: np.ndarray, most: int, radius: float) -> np.ndarray:
    """Centres, each the point farthest from those before, until all are within ``radius``."""
    chosen = [0]
    near = distances(x, x[:1])[:, 0]
    while len(chosen) < most and near.max() > radius:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def turned(x: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose first columns are the directions that hold the most of ``x``."""
    return np.linalg.eigh(x.T @ x)[1][:, ::-1]


def leading(x: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """``LEADING`` coordinates and the length of the rest (products bound the inner product from above), single precision."""
    if turn is not None:
        x = x @ turn
    if x.shape[1] <= LEADING + 1:
        return x.astype(np.float32)
    rest = np.sqrt((x[:, LEADING:] ** 2).sum(axis=1))
    return np.concatenate([x[:, :LEADING], rest[:, None]], axis=1).astype(np.float32)


class CoverTree:
    """Nested levels over unit vectors: ``centre[l]`` rows that are nodes of level
    l, ``parent[l]`` the place of each one's parent in level l - 1, ``radius[l]``
    covering radii, ``leaf`` the node of every row in the last level; ``first`` the coordinates of the bound.
    Levels end where one has too many nodes to gather rows."""

    def __init__(self, x: np.ndarray, turn: np.ndarray | None = None):
        self.x = x
        self.first = leading(x, turn)
        of = np.zeros(len(x), dtype=np.int64)  # node of every row in the level above
        n_above = 1
        self.centre, self.parent, self.radius = [], [], []
        for rho in LEVELS:
            level = self._level(of, n_above, rho)
            if level is None:
                break
            centre, node = level
            far = np.zeros(len(centre))
            np.maximum.at(far, node, np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x, x[centre[node]]), 0)))
            self.centre.append(centre)
            self.parent.append(of[centre])
            self.radius.append(far)
            of, n_above = node, len(centre)
        self.leaf = of

    def _level(self, of: np.ndarray, n_above: int, rho: float) -> tuple[np.ndarray, np.ndarray] | None:
        """Greedy net of radius rho within every node of the level above; None where it gathers too few rows."""
        x = self.x
        most = len(x) / GATHERS
        node = np.full(len(x), -1, dtype=np.int64)
        centre: list[int] = []
        alone = np.bincount(of, minlength=n_above)[of] == 1
        for i in np.flatnonzero(alone):
            node[i] = len(centre)
            centre.append(int(i))
        order = np.argsort(of[~alone], kind="stable")
        rows = np.flatnonzero(~alone)[order]
        bounds = np.flatnonzero(np.diff(of[rows])) + 1
        for members in np.split(rows, bounds):
            left = members
            while len(left):
                # the first rows left: those not within rho of an earlier one become centres
                head = left[:HEAD]
                close = distances(x[head], x[head]) <= rho
                picked: list[int] = []
                for k in range(len(head)):
                    if not close[k, picked].any():
                        picked.append(k)
                if len(centre) + len(picked) > most or (len(left) > HEAD * GATHERS and len(picked) * 4 > len(head) * 3):
                    return None
                d = distances(x[left], x[head[picked]])
                nearest = d.argmin(axis=1)
                got = d[np.arange(len(left)), nearest] <= rho + SLACK
                # a centre is its own, whatever rounding says
                got[picked], nearest[picked] = True, np.arange(len(picked))
                node[left[got]] = len(centre) + nearest[got]
                centre.extend(int(i) for i in head[picked])
                left = left[~got]
        return np.array(centre, dtype=np.int64), node

    def nodes(self, depth: int) -> np.ndarray:
        """The node of every row after ``depth`` levels."""
        node = self.leaf
        for level in range(len(self.centre) - 1, depth - 1, -1):
            node = self.parent[level][node]
        return node


def dual(a: CoverTree, b: CoverTree, threshold: float) -> np.ndarray:
    """Boolean matrix of the rows of ``a`` and ``b`` with cosine >= threshold."""
    r = np.sqrt(max(0.0, 2 - 2 * threshold))
    found = np.zeros((len(a.x), len(b.x)), dtype=bool)
    depth = min(len(a.centre), len(b.centre))
    alive = np.ones((1, 1), dtype=bool)
    for level in range(depth):
        ca, cb = a.x[a.centre[level]], b.x[b.centre[level]]
        pa_, pb_ = a.parent[level], b.parent[level]
        now = np.zeros((len(ca), len(cb)), dtype=bool)
        columns = np.flatnonzero(alive.any(axis=0)[pb_])
        rows = np.flatnonzero(alive.any(axis=1)[pa_])
        for s in range(0, len(rows), STRIP):
            i = rows[s:s + STRIP]
            bound = r + SLACK + a.radius[level][i][:, None] + b.radius[level][columns][None, :]
            now[np.ix_(i, columns)] = (distances(ca[i], cb[columns]) <= bound) & alive[np.ix_(pa_[i], pb_[columns])]
        alive = now
        if not alive.any():
            return found
    leaf_a, leaf_b = a.nodes(depth), b.nodes(depth)
    # the rows of a node lie together, so that a strip meets few columns
    order = np.argsort(leaf_a, kind="stable")
    order = order[alive.any(axis=1)[leaf_a[order]]]
    for s in range(0, len(order), STRIP):
        i = order[s:s + STRIP]
        columns = np.flatnonzero(alive[np.unique(leaf_a[i])].any(axis=0)[leaf_b])
        bound = a.first[i] @ b.first[columns].T >= np.float32(threshold - BOUND_SLACK)
        p, q = np.divmod(np.flatnonzero(bound), max(1, len(columns)))
        if len(p) * 8 > bound.size:  # most pairs: one product
            found[np.ix_(i, columns)] = bound & (a.x[i] @ b.x[columns].T >= threshold)
            continue
        for t in range(0, len(p), 1 << 16):
            one, other = i[p[t:t + (1 << 16)]], columns[q[t:t + (1 << 16)]]
            found[one, other] = np.einsum("ij,ij->i", a.x[one], b.x[other]) >= threshold
    return found


def linked(found: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that every class of either side links with, the classes standing for ``n_a`` and ``n_b`` rows."""
    of_a, of_b = np.zeros(len(n_a), dtype=np.int64), np.zeros(len(n_b), dtype=np.int64)
    for s in range(0, len(n_a), STRIP):
        p, q = np.divmod(np.flatnonzero(found[s:s + STRIP]), len(n_b))
        if len(p):
            of_a[s:s + STRIP] = np.bincount(p, weights=n_b[q], minlength=len(of_a[s:s + STRIP])).astype(np.int64)
            of_b += np.bincount(q, weights=n_a[s + p], minlength=len(n_b)).astype(np.int64)
    return of_a, of_b


def forest(found: np.ndarray) -> tuple[list[int], list[int]]:
    """Links (row of a, row of b as len(a) + row) that span the components of a two-sided relation."""
    n, m = found.shape
    seen_a, seen_b = np.zeros(n, dtype=bool), np.zeros(m, dtype=bool)
    one, other = [], []
    for start in np.flatnonzero(found.any(axis=1)):
        if seen_a[start]:
            continue
        seen_a[start] = True
        side_a = np.array([start])
        while len(side_a):
            side_b = np.flatnonzero(found[side_a].any(axis=0) & ~seen_b)
            seen_b[side_b] = True
            one += [int(start)] * len(side_b)
            other += (n + side_b).tolist()
            side_a = np.flatnonzero(found[:, side_b].any(axis=1) & ~seen_a) if len(side_b) else side_b
            seen_a[side_a] = True
            one += [int(start)] * len(side_a)
            other += side_a.tolist()
    return one, other


def _classes(df: DataFrame, vector_col: str) -> DataFrame:
    """Distinct vectors that can link: ``class, n, dim, v`` (the components as bytes)."""
    v = F.col(vector_col)
    good = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(v, lambda c: c != 0)
    return (df.where(F.coalesce(good, F.lit(False))).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
            .select(F.monotonically_increasing_id().alias("class"), "n", F.size("v").alias("dim"), "v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return unit(np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dim))


def _found(a: np.ndarray, links: np.ndarray, b: np.ndarray, edge: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(links, pa.int64()), pa.array(b, pa.int64()),
                                       pa.array(np.full(len(a), edge))], names=["a", "links", "b", "edge"])


def _links(classes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``class, links`` (linked vectors found in one task) and ``a, b`` forest edges, of the classes of one length."""
    r = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    mine = classes.where(F.col("dim") == dim)
    sample = mine.orderBy(F.xxhash64("v"), "class").limit(SAMPLE).select("v").collect()
    sample = unit(np.array([s["v"] for s in sample]))
    centres, turn = farthest_points(sample, TOP, LEVELS[0] / 2), turned(sample)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                d = distances(_matrix(b.column(0), dim), centres)
                yield pa.RecordBatch.from_arrays([pa.array(d.argmin(axis=1), pa.int32()), pa.array(d.min(axis=1))], names=["node", "d"])

    stats = {s["node"]: s for s in mine.select("v").transform(map_in_arrow, assign, "node int, d double").groupBy("node")
             .agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}  # TOP rows at most
    radius = np.array([stats[k]["radius"] if k in stats else -10.0 for k in range(len(centres))])
    # as many pairs of groups as keep all tasks busy, no more: a class is sent once for every group it meets
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sum(s["n"] for s in stats.values())
    most = min(GROUP, max(BLOCK // 4, -(-total // int(np.ceil(np.sqrt(4 * parts))))))
    blocks = np.array([-(-stats[k]["n"] // most) if k in stats else 0 for k in range(len(centres))])
    first = np.concatenate([[0], np.cumsum(blocks)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            d = distances(_matrix(b.column(2), dim), centres)
            home = d.argmin(axis=1)
            meets = d <= radius + r + SLACK
            meets[np.arange(len(home)), home] = True
            own = first[home] + b.column(3).to_numpy() % blocks[home]
            row, node = np.nonzero(meets)
            times = blocks[node]
            row = np.repeat(row, times)
            start = np.repeat(first[node], times)
            other = start + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            low, high = np.minimum(own[row], other), np.maximum(own[row], other)
            for s in range(0, len(row), 4096):
                k = pa.array(row[s:s + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((low[s:s + 4096] << 32) | high[s:s + 4096], pa.int64()), pa.array(own[row[s:s + 4096]], pa.int64()),
                     b.column(0).take(k), b.column(1).take(k), b.column(2).take(k)], names=["pair", "block", "class", "n", "v"])

    kind = classes.schema["v"].dataType.simpleString()
    dealt = (mine.select("class", "n", "v", F.pmod(F.xxhash64("class"), F.lit(1 << 30)).alias("h"))
             .transform(map_in_arrow, deal, f"pair bigint, block bigint, class bigint, n bigint, v {kind}"))

    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        pair = rows.column(0)[0].as_py()
        low, high = pair >> 32, pair & 0xFFFFFFFF
        block = rows.column(1).to_numpy()
        ids, n = rows.column(2).to_numpy(), rows.column(3).to_numpy()
        here = np.flatnonzero(block == low)
        there = np.flatnonzero(block == high) if low != high else here
        if not len(here) or not len(there):
            return
        x = _matrix(rows.column(4).combine_chunks(), dim)
        links = np.zeros(len(ids), dtype=np.int64)

        def cut(members: np.ndarray) -> list[tuple[np.ndarray, CoverTree]]:
            return [(m, CoverTree(x[m], turn)) for m in (members[s:s + BLOCK] for s in range(0, len(members), BLOCK))]

        ours = cut(here)
        theirs = ours if low == high else cut(there)
        for k, (i, a) in enumerate(ours):
            for j, b in theirs[k:] if low == high else theirs:
                found = dual(a, b, threshold)
                if i is j:
                    np.fill_diagonal(found, False)
                    links[i] += linked(found, n[i], n[i])[0]
                    names = np.concatenate([ids[i], ids[i]])
                else:
                    of_i, of_j = linked(found, n[i], n[j])
                    links[i] += of_i
                    links[j] += of_j
                    names = np.concatenate([ids[i], ids[j]])
                one, other = forest(found)
                if one:
                    yield _found(names[one], np.zeros(len(one), np.int64), names[other], True)
        some = np.flatnonzero(links)
        yield _found(ids[some], links[some], np.zeros(len(some), np.int64), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            pair = held.column(0).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(np.diff(pair)) + 1])
            for s, e in zip(starts[:-1], starts[1:]):
                yield from compare(held.slice(s, e - s))
            held = held.slice(starts[-1])
        if held is not None:
            yield from compare(held)

    n_pairs = int(first[-1]) * (int(first[-1]) + 1) // 2
    return (dealt.repartition(max(1, parts, min(n_pairs, 4 * parts)), "pair").sortWithinPartitions("pair", "block", "class")
            .transform(map_in_arrow, run, "a bigint, links bigint, b bigint, edge boolean"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``<id>, n_links, component_id, kept`` for every row."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    classes = materialise(_classes(rows, "vector"), "vectors")
    dims = [d["dim"] for d in classes.select("dim").distinct().collect()]  # lengths, not vectors
    found = None
    for dim in sorted(dims):
        part = _links(classes, dim, threshold)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = materialise(found, "vector-links")
    links = found.where(~F.col("edge")).groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("edge").select("a", "b")).withColumnRenamed("node", "class")
    named = (classes.select("class", "n", "v").join(links, "class", "left").join(roots, "class", "left")
             .select("v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "class").alias("component")))
    member = materialise(rows.join(named, rows["vector"] == named["v"], "left").select("id", "n_links", "component"), "vector-members")
    least = member.groupBy("component").agg(F.min("id").alias("least")).where(F.col("component").isNotNull())
    out = member.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
