"""Ramp fits of curves that are made on the spot, which no join may broadcast."""

import numpy as np
import pytest

from terraflux.operators import ramp
from terraflux.plans import queries as q

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def made(spark):
    """(site, t, e_ref) of three sites; the last has no year of the ramp."""
    rng = np.random.default_rng(5)
    rows = [(s, t, float(x)) for s in (1, 2) for t, x in enumerate(60 * rng.random(60), 1)] + [(3, t, 40.0) for t in range(30, 61)]
    return rows, spark.createDataFrame(rows, "site long, t int, e_ref double")


def test_fit(spark):
    rows, curves = made(spark)
    assert "Join" not in plan(q.QUERIES["ramp_fit"](spark, SF))
    got = {r["site"]: (r["p_luc"], r["rmse"]) for r in ramp.fit(curves, 37.3).collect()}
    assert got.keys() == {1, 2}
    for site, (height, rmse) in got.items():
        e, w = np.array([x for s, t, x in rows if s == site and t <= 20]), (21 - np.arange(1, 21)) / 210
        p = np.sum((e - 37.3) * w) / np.sum(w * w)
        assert height == pytest.approx(p) and rmse == pytest.approx(np.sqrt(np.mean((p * w + 37.3 - e) ** 2)))


def test_cumulative(spark):
    rows, curves = made(spark)
    assert "Broadcast" not in plan(q.QUERIES["cumulative_profile"](spark, SF))
    heights = spark.createDataFrame([(1, 50.0), (2, None), (3, 10.0)], "site long, p_luc double")
    got = {(r["site"], r["t"]): (r["ref"], r["model"]) for r in ramp.cumulative(curves, heights, 37.3, (10, 40)).collect()}
    expected = {}
    for site, p in ((1, 50.0), (2, None), (3, 10.0)):
        for at in (10, 40):
            own = [(t, x) for s, t, x in rows if s == site and t <= at]
            model = [37.3 + (0 if t > 20 else p * (21 - t) / 210) for t, _ in own if t > 20 or p is not None]
            if any(t == at for t, _ in own):
                expected[site, at] = sum(x for _, x in own), sum(model) if model else None
    assert got.keys() == expected.keys()
    for k, (ref, model) in expected.items():
        assert got[k][0] == pytest.approx(ref) and (got[k][1] is None if model is None else got[k][1] == pytest.approx(model))
