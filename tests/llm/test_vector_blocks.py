"""Exact search over several stored blocks and several query blocks, with copies and near copies."""

from collections import defaultdict

import numpy as np
import pytest

from terraflux.llm import vafile


@pytest.mark.parametrize(("scale", "copies"), [(1.0, 0), (1.0, 900), (0.002, 300), (900.0, 300)])
def test_blocks_of_vectors_and_queries(spark, monkeypatch, scale, copies):
    monkeypatch.setattr(vafile, "BLOCK_BYTES", 8 * 12 * 150)
    monkeypatch.setattr(vafile, "QUERY_BYTES", 8 * 12 * 7)
    rng = np.random.default_rng(4)
    rows = rng.normal(0, scale, (2400, 12)).astype(np.float32)
    rows[1000 : 1000 + copies] = rows[1000]
    rows[2000:2200] = rows[2000] + rng.normal(0, scale / 5000, (200, 12))  # cells do not tell these apart
    ids = rng.permutation(len(rows)).tolist()
    df = spark.createDataFrame(list(zip(ids, rows.tolist(), strict=True)), "vec_id long, embedding array<float>").repartition(3)
    x = np.floor(1024 * rows.astype(float)).astype(np.int64)
    got = defaultdict(list)
    for r in vafile.top_k(df, df.filter("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert len(got) == 24
    for at, q in enumerate(ids):
        if q % 100 == 0:
            best = sorted((-int(s), i) for s, i in zip(x @ x[at], ids, strict=True) if i != q)[:10]
            assert got[q] == [(i, -s) for s, i in best]


def test_the_plan_does_not_grow_with_the_queries(spark, monkeypatch):
    """Ten and more blocks of queries, many groups of vectors: one branch, and all rows right."""
    monkeypatch.setattr(vafile, "BLOCK_BYTES", 8 * 4 * 64)
    monkeypatch.setattr(vafile, "GROUP_BYTES", 600)
    df = spark.range(0, 1500, 1, 3).selectExpr("id AS vec_id", "array(cast(id % 37 as float), cast(id % 11 as float), 1f, cast(id / 1000 as float)) AS embedding")
    plans = []
    for size in (1 << 20, 8 * 4 * 2):
        monkeypatch.setattr(vafile, "QUERY_BYTES", size)
        found = vafile.top_k(df, df.filter("vec_id % 50 = 0"), 3)
        plans.append((found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow"), sorted(map(tuple, found.collect()))))
    assert plans[0] == plans[1] and plans[0][0] == 1 and len(plans[0][1]) == 90


def test_bounds_hold_and_are_narrow():
    rng = np.random.default_rng(5)
    x, q = rng.integers(-3000, 3000, (500, 9)), rng.integers(-3000, 3000, (6, 9))
    low, high = vafile.Block.of(np.arange(500), x).bounds(q)
    exact = q @ x.T
    assert (low <= exact).all() and (exact <= high).all() and (high - low).max() < 0.05 * (np.abs(exact).max())


def test_a_block_survives_packing():
    for x in (np.array([[1, -128], [127, 0]]), np.array([[70000, -5]]), np.zeros((3, 0), np.int64), np.array([[2**70, -1]], object)):
        a = vafile.Block.of(np.arange(len(x)), x)
        b = vafile.Block.unpacked(a.packed())
        assert b.ids.tolist() == a.ids.tolist() and b.x.tolist() == x.tolist() and (a.cells is None) == (b.cells is None)
