"""op11 against brute force: pruning on vectors of unlike lengths, windows of scores, ties, copies and odd values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraflux.llm import hard_negatives


def expected(rows, anchors, positives=5, negatives=3):
    own = [(i, y, [int(x) * 256 if abs(x) >= 2**52 else math.floor(256 * x) for x in v]) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False))))
    out, seen = [], {}
    for i, y, v in sorted((r for r in own if anchors(r[0])), key=lambda r: (r[2], r[1])):
        seen.setdefault(i, (v, y))
    for i, (v, y) in seen.items():
        scored = sorted((-dot(v, w), j, z) for j, z, w in own if j != i)
        for s, j, _ in [r for r in scored if r[2] == y][:positives]:
            fit = [(t, m) for t, m, z in scored if z != y and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(i, j, k, m, -s, -t) for k, (t, m) in enumerate(fit, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 5 == 0).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


SCHEMA = "vec_id long, embedding array<double>, label int, score long, g int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA)


def test_brute_force(spark):
    """Clustered vectors of very unlike lengths, negative scores included."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[rng.integers(12)] * rng.choice([0.01, 1, 5]) + rng.normal(size=16) * 0.3).tolist(), int(rng.integers(4))) for i in range(700)]
    assert got(frame(spark, rows)) == expected(rows, lambda i: i % 5 == 0)


def test_pruning(spark, monkeypatch):
    """Small buckets and blocks change nothing, and lists do prune."""
    rng = np.random.default_rng(4)
    rows = [(i, (np.eye(8)[rng.integers(8)] * (1 + rng.random()) + rng.normal(size=8) * 0.05).tolist(), int(rng.integers(3))) for i in range(400)]
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows])
    bucket = hard_negatives.Bucket.of(np.arange(400), np.zeros(400, np.int64), x)
    unit = x[0] / np.linalg.norm(x[0])
    near = bucket.feasible(np.argsort(-np.abs(unit))[:4], unit, 0.9)
    cosines = x @ unit / np.linalg.norm(x, axis=1)
    assert near is not None and len(near) < 150 and set(np.flatnonzero(cosines >= 0.9)) <= set(near.tolist())
    monkeypatch.setattr(hard_negatives, "BUCKET", 32)
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    assert got(frame(spark, rows)) == expected(rows, lambda i: i % 5 == 0)


@pytest.mark.parametrize("cosine", [0.05, 0.5, 0.99])
def test_ranges_lose_nothing(cosine):
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(3000, 6)) ** 3 * 300).astype(np.int64)
    bucket = hard_negatives.Bucket.of(np.arange(3000), np.zeros(3000, np.int64), x)
    for q in x[:40]:
        unit = q / max(np.linalg.norm(q), 1)
        near = bucket.feasible(np.argsort(-np.abs(unit))[:3], unit, cosine)
        cosines = x @ unit / np.maximum(np.linalg.norm(x, axis=1), 1)
        assert near is None or set(np.flatnonzero(cosines >= cosine)) <= set(near.tolist())


def test_edges(spark):
    """Nulls, odd components, zero vectors, copies, repeated ids, unlike lengths, huge values."""
    rows = [
        (None, [1.0, 0.0], 1), (0, None, 1), (5, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (15, [float("inf"), 1.0], 1), (20, [1.0, 1.0], None), (25, [], 1), (30, [0.0, 0.0], 2), (35, [0.0], 1),
        *[(i, [1.0, 0.5], i % 3) for i in range(100, 160)], *[(i, [0.8, 0.4, 0.1], i % 3) for i in range(160, 200)], (200, [1.0, 0.5], 1), (200, [1.0, 0.5], 1), (200, [0.9, 0.5], 0), (201, [0.7, 0.4], 2), (201, [0.7, 0.4], 2),
    ]
    assert got(frame(spark, rows)) == expected(rows, lambda i: i % 5 == 0)
    huge = [*rows, (205, [1e300, 1.0], 0), (206, [2e18, 5.0], 0), (207, [1.5e18, 5.0], 1), (210, [1e12, 1e12], 1), (211, [8e11, 7e11], 2), (212, [9e11, 1e12], 1)]
    assert got(frame(spark, huge)) == expected(huge, lambda i: i % 5 == 0)
    assert got(frame(spark, [])) == [] and got(frame(spark, rows[:1])) == []


def test_one_label(spark):
    rows = [(i, [float(i % 7), 1.0], 1) for i in range(40)]
    assert got(frame(spark, rows)) == []
