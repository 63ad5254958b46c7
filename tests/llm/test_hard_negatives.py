"""Hard negatives against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearbox.llm import hard_negatives
from gearbox.llm.embedding_dedup import CoverTree, unit
from gearbox.llm.hard_negatives import LONG, mine, scores

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, scale=256, positives=5, negatives=10, lowest=30, highest=90):
    part = []
    for vec_id, v, label in rows:
        if v is not None and label is not None and all(c is not None and math.isfinite(c) for c in v):
            part.append((vec_id, [math.floor(scale * c) for c in v], label))
    out = []
    for i, (a, v, label) in enumerate(part):
        if a is None or not anchor(a):
            continue
        near = [(min(LONG, sum(x * y for x, y in zip(v, w))), b, other) for j, (b, w, other) in enumerate(part) if j != i and len(w) == len(v)]
        near.sort(key=lambda t: (-t[0], t[1] is None, t[1] or 0))
        for s, p, _ in [t for t in near if t[2] == label][:positives]:
            fits = [t for t in near if t[2] != label and lowest * s <= 100 * t[0] <= highest * s][:negatives]
            out += [(a, p, k + 1, n, s, t) for k, (t, n, _) in enumerate(fits)]
    return out


def found(df, **options):
    return sorted((tuple(r) for r in mine(df, **options).collect()), key=repr)


def clustered(n, seed, dim=8, copies=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dim))
    v = centres[draw.integers(0, 6, n)] + 0.2 * draw.normal(size=(n, dim))
    v[:copies] = v[0]
    return [(i, [float(c) for c in v[i]], int(draw.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("copies", [0, 150])
def test_equals_brute_force(spark, monkeypatch, copies):
    monkeypatch.setattr(hard_negatives, "BLOCK", 64)  # many blocks; a third of the rows are copies of one vector
    monkeypatch.setattr(hard_negatives, "SAMPLE", 200)
    rows = clustered(450, copies, copies=copies)
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df, anchor=F.col("id") % 9 == 0) == sorted(brute(rows, lambda a: a % 9 == 0), key=repr)


@pytest.mark.parametrize("n", [2, 3, 120])
def test_rows_that_no_level_gathers(spark, n):
    """Blocks whose tree has no level: a few rows, or rows that all lie apart."""
    draw = np.random.default_rng(n)
    rows = [(i, [float(c) for c in draw.normal(size=48)], i % 3 if n > 3 else 0) for i in range(n)]
    rows += [(200, [0.25 * c for c in rows[0][1]], 5)]
    assert not CoverTree(unit(np.array([v for _, v, _ in rows]))).centre
    df = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    want = brute(rows, lambda a: True, lowest=-500, highest=500)
    assert want and found(df, lowest=-500, highest=500) == sorted(want, key=repr)


def test_lengths_and_parameters(spark):
    rows = [(i, [float(c) for c in np.random.default_rng(i).normal(size=(3, 5, 0)[i % 3])], i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, SCHEMA)
    options = dict(scale=16, positives=3, negatives=4, lowest=10, highest=80)
    assert found(df, **options) == sorted(brute(rows, lambda a: True, **options), key=repr)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [1.0, 0.4], 0), (None, [1.0, 0.45], 0), (3, [0.5, 0.2], 1), (4, [0.5, 0.2], 1),
            (None, [0.5, 0.1], 1), (5, None, 1), (6, [1.0, None], 1), (7, [inf, 0.0], 1), (8, [nan, 0.0], 0), (9, [0.4, 0.2], None),
            (10, [0.0, 0.0], 1), (11, [-1.0, -0.5], 2), (12, [1.0, 0.0, 0.0], 0), (13, [1e12, 3e12], 3), (14, [2e12, 1e12], 3),
            (15, [1e12, 0.5e12], 4)]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in ("row", "id", "v", "n", "block")])
    got = found(df, lowest=1)
    want = brute(rows, lambda a: True, lowest=1)
    assert got == sorted(want, key=repr)
    assert mine(df.limit(0)).collect() == []
    assert mine(df.where("vec_id = 12")).collect() == []


def test_large_scores_are_exact():
    x = np.array([[1 << 40, 1], [1 << 40, 2]], dtype=np.int64)
    assert list(scores(x, np.array([1 << 20, 1], dtype=np.int64))) == [(1 << 60) + 1, (1 << 60) + 2]
