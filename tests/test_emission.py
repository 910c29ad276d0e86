"""Hand-computed values of the per-pixel rules, no-data included."""

import math

import pytest
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.functions import emissions as e
from terraflux.functions import nulls, tiles
from terraflux.operators.emit import emit, with_source_totals


def values(spark, schema, rows, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_constants():
    assert sum(k.SPAN_WEIGHTS.values()) == pytest.approx(0.2)
    assert len(k.STATISTICAL_CROPS) == 32 and len(k.SHARED) == 13
    assert set(k.group_of()) | set(k.SHARED) == set(k.STATISTICAL_CROPS.values())


def test_land_class(spark):
    codes = [250, 244, 25, 48, 125, 148, 0, 24, 100, 124, 254, 241, 200, 207, -1, 255, 1024, 60, None]
    expected = [1, 2, 3, 3, 3, 3, 4, 4, 4, 4, 5, 6, 7, 7, 0, 0, 0, 0, 0]
    assert values(spark, "x int", [(v,) for v in codes], e.land_class(F.col("x"))) == expected


def test_belowground_carbon(spark):
    rows = [(0.0, 2.0), (1.0, 1.0), (2.0, 0.0), (2.0, None), (None, 0.0), (None, 1.0)]
    got = values(spark, "agb double, bgb double", rows, e.belowground_carbon(F.col("agb"), F.col("bgb")))
    assert got[:4] == pytest.approx([0.94, 0.47, 0.5 * 0.47, 0.0])
    assert got[4] is None and got[5] == pytest.approx(0.47)


def test_dead_organic_carbon(spark):
    rows = [(10.0, 1), (10.0, None), (None, None), (None, 1), (10.0, 11), (10.0, -1)]
    got = values(spark, "agb double, zone int", rows, e.dead_organic_carbon(F.col("agb"), F.col("zone")))
    assert got[0] == pytest.approx(10 * (0.5 * 0.07 + 0.37 * 0.01))
    assert got[1:3] == [0.0, 0.0] and got[3] is None and got[4:] == [0.0, 0.0]


def test_grassland_carbon(spark):
    assert values(spark, "zone int", [(2,), (10,), (-1,), (None,)], e.grassland_carbon(F.col("zone"))) == [18, 3, 0, 0]


def test_vegetation_emissions(spark):
    rows = [(None, 1.0), (2.0, 1.0), (1.0, 2.0), (1.0, None)]
    got = values(spark, "b double, a double", rows, e.vegetation_emissions(F.col("b"), F.col("a")))
    assert got[0] is None and got[1:3] == pytest.approx([44 / 12, 0]) and got[3] is None


def test_soil_emissions(spark):
    soil = e.soil_emissions(F.col("b"), F.col("a"), F.col("peat"), e.mineral_soil_emissions(F.col("zone"), F.col("soc")))
    rows = [(2, 3, 0, 2, 3.0), (3, 4, 0, 2, 3.0), (3, 2, 0, 2, 3.0), (4, 2, 1, 2, 3.0), (3, 2, None, 2, 3.0), (3, 2, 0, None, 3.0), (3, 2, 0, 2, None)]
    got = values(spark, "b int, a int, peat int, zone int, soc double", rows, soil)
    assert got[:6] == pytest.approx([0, 0, 0.17 * 44 / 12 * 3, 621, 0, 0]) and got[6] is None


def test_peat_occupation(spark):
    rows = [(1, c) for c in (1, 2, 3, 4, 5, 6, 7, 0)] + [(0, 2), (None, 2), (None, 3)]
    got = values(spark, "peat int, cls int", rows, e.peat_occupation(F.col("peat"), F.col("cls")))
    assert got == [37.3, 37.3, 0, 0, 0, 0, 0, 37.3, 0, None, 0]


def test_discount(spark):
    spans = {span: F.lit(float(i)) for i, span in enumerate(k.SPAN_WEIGHTS, 1)}
    assert values(spark, "x int", [(0,)], e.discounted(spans)) == pytest.approx([0.625])


def test_hectares(spark):
    got = values(spark, "lat double", [(0.0,), (1.0,)], tiles.hectares(F.col("lat"), 1.0))
    assert got == pytest.approx([1237126.381, 1237126.381 * math.cos(math.radians(1))], rel=1e-6)


def test_clean(spark):
    rows = [(float("nan"),), (float("inf"),), (float("-inf"),), (-1e30,), (7.0,), (1.5,), (None,)]
    assert values(spark, "x double", rows, nulls.clean(F.col("x"), 7.0)) == [None] * 5 + [1.5, None]


def test_unknown_peat_keeps_forest_part(spark):
    """A pixel of unknown total still has its forest part."""
    row = [("50N_100W", 0, 0, 25, 244, 244, 244, 244, 100.0, 10.0, 50.0, 2, None)]
    schema = "tile_id string, row int, col int, lc_2000 int, lc_2005 int, lc_2010 int, lc_2015 int, lc_2020 int, agb double, bgb double, soc double, zone int, peat int"
    got = with_source_totals(emit(spark.createDataFrame(row, schema), 1000)).first()
    assert got["per_ha"] is None and got["occupation"] is None and got["forest_per_ha"] > 0 and got["peat_conversion_per_ha"] == 0
