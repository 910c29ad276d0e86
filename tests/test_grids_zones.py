"""Tiles, grids, resampling weights and point in polygon."""

import pytest
from pyspark.sql import functions as F

from terraflux.functions import tiles
from terraflux.operators import grids, resample, zones
from terraflux.plans import fixtures as fx


def test_round_trip_of_all_corners(spark):
    rows = spark.range(19).selectExpr("cast((id - 9) * 10 as int) as lat").crossJoin(spark.range(36).selectExpr("cast((id - 18) * 10 as int) as lon"))
    back = rows.withColumn("t", tiles.tile_of(F.col("lat"), F.col("lon"))).filter((tiles.lat_of(F.col("t")) != F.col("lat")) | (tiles.lon_of(F.col("t")) != F.col("lon")) | ~tiles.is_valid(F.col("t"), "TEN_DEGREE"))
    assert back.count() == 0


@pytest.mark.parametrize(("name", "kind"), [("12N_034E", "ONE_DEGREE"), ("10S_030W", "TEN_DEGREE"), ("world", "WHOLE_WORLD"), ("001X_002Y_03Z", "XYZ_MERCATOR")])
def test_validity(spark, name, kind):
    row = grids.validity(spark.createDataFrame([(name,), (name + "x",)], "tile_id string")).collect()
    assert row[0][f"is_{kind.lower()}"] and not row[1][f"is_{kind.lower()}"]


def test_grid_and_offsets(spark):
    own = spark.createDataFrame([(1, "50N_100W"), (1, "40N_090W"), (1, "40N_100W")], "g int, tile_id string")
    grid = grids.grid_of(own, 120, ["g"])
    assert grid.first().asDict() == {"g": 1, "x0": -100, "y0": 50, "tiles_x": 2, "tiles_y": 2, "width": 240, "height": 240, "pixel": 10 / 120}
    got = {r["tile_id"]: (r["offset_x"], r["offset_y"]) for r in grids.tile_offsets(own, grid, 120, ["g"]).collect()}
    assert got == {"50N_100W": (0, 0), "40N_090W": (120, 120), "40N_100W": (0, 120)}
    with pytest.raises(Exception, match="negative offset"):
        grids.tile_offsets(spark.createDataFrame([(1, "60N_100W")], own.schema), grid, 120, ["g"]).collect()
    assert grids.world_window(grid, 4320, 2160).select("window_x", "window_y", "window_w", "window_h").first()[:] == (80 * 12, 40 * 12, 240, 240)


def test_kernels():
    same, fine, coarse = (10, 10), (20, 20), (5, 5)
    assert resample.kernel("EXTENSIVE", same, same) == "nearest"
    assert [resample.kernel(b, same, s) for b in ("CATEGORICAL", "INTENSIVE") for s in (fine, coarse, (20, 5))] == ["mode", "nearest", "nearest", "average", "bilinear", "bilinear"]
    for src in (fine, coarse):
        with pytest.raises(NotImplementedError):
            resample.kernel("EXTENSIVE", same, src)


@pytest.mark.parametrize(("n", "m"), [(40000, 120), (1000, 30), (10, 5), (7, 3)])
def test_overlap_weights(spark, n, m):
    rows = spark.range(n).select(F.explode(resample.overlaps(F.col("id"), n, m)).alias("o")).groupBy("o.k").agg(F.sum("o.w").alias("w"))
    got = {r["k"]: r["w"] for r in rows.collect()}
    assert got == dict.fromkeys(range(m), float(n))


def test_average_and_mode_skip_unknown(spark):
    rows = [("t", r, c, v) for r, c, v in [(0, 0, 1), (0, 1, 3), (1, 0, None), (1, 1, 3), (2, 2, None), (2, 3, None), (0, 2, 5), (0, 3, 4)]]
    df = spark.createDataFrame(rows, "tile_id string, row int, col int, v int")
    mean = {(r["crow"], r["ccol"]): r["v"] for r in resample.average(df, 4, 2, ["v"]).collect()}
    assert mean == {(0, 0): pytest.approx(7 / 3), (0, 1): 4.5, (1, 1): None}
    mode = {(r["crow"], r["ccol"]): r["v"] for r in resample.mode(df, 4, 2, "v").collect()}
    assert mode == {(0, 0): 3, (0, 1): 4, (1, 1): None}


def test_bilinear_stops_at_edges(spark):
    src = spark.createDataFrame([("t", r, c, float(10 * r + c)) for r in range(2) for c in range(2)], "tile_id string, row int, col int, v double")
    dest = spark.createDataFrame([("t", r, c) for r in range(4) for c in range(4)], "tile_id string, row int, col int")
    got = {(r["row"], r["col"]): r["v"] for r in resample.bilinear(src, dest, 2, 4, "v").collect()}
    assert got[0, 0] == 0 and got[3, 3] == 11 and got[1, 1] == pytest.approx(2.75) and got[0, 1] == pytest.approx(0.25)


def test_albers_origin(spark):
    x, y = resample.albers(F.col("lon"), F.col("lat"))
    got = spark.createDataFrame([(-96.0, 23.0), (-96.0, 24.0)], "lon double, lat double").select(x.alias("x"), y.alias("y")).collect()
    assert got[0][:] == pytest.approx((0, 0), abs=1e-6) and got[1]["y"] == pytest.approx(110_000, rel=0.02)


def inside(edges, x, y):
    return sum((min(y1, y2) <= y < max(y1, y2)) and x1 + (y - y1) / (y2 - y1) * (x2 - x1) > x for x1, y1, x2, y2 in edges) % 2 == 1


SHAPES = {
    "triangle": [[(0.13, 9.9), (6.3, 9.1), (2.2, 3.3)]],
    "concave": [[(0.2, 9.8), (8.1, 9.8), (8.1, 6.1), (3.3, 6.1), (3.3, 1.2), (0.2, 1.2)]],
    "holed": [[(0.3, 9.7), (9.3, 9.7), (9.3, 0.4), (0.3, 0.4)], [(3.1, 7.1), (3.1, 3.1), (7.1, 3.1), (7.1, 7.1)]],
    "outside": [[(20.1, 40.1), (21.1, 40.1), (21.1, 41.1)]],
    "two_tiles": [[(5.5, 8.3), (15.5, 8.3), (15.5, 2.3), (5.5, 2.3)]],
}


def test_spans_equal_brute_force(spark):
    n = 10
    rows = [(name, 0, [{"x": x, "y": y} for x, y in ring]) for name, rings in SHAPES.items() for ring in rings]
    edges = zones.edges_of(spark.createDataFrame(rows, "zone_id string, part int, ring array<struct<x:double,y:double>>"))
    pixels = spark.createDataFrame([(t, r, c) for t in ("10N_000E", "10N_010E") for r in range(n) for c in range(n)], "tile_id string, row int, col int")
    got = {tuple(r) for r in zones.pixels_in_zones(pixels, zones.spans(edges, n)).select("zone_id", "tile_id", "row", "col").collect()}
    expected = set()
    for name, rings in SHAPES.items():
        lines = [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
        expected |= {(name, t, r, c) for t, x0 in (("10N_000E", 0), ("10N_010E", 10)) for r in range(n) for c in range(n) if inside(lines, x0 + c + 0.5, 10 - r - 0.5)}
    assert got == expected and expected


def test_tiles_touching(spark):
    shapes = [("inner", [(12.0, 12.0), (18.0, 12.0), (15.0, 18.0)]), ("around", [(-5.0, -5.0), (35.0, -5.0), (35.0, 35.0), (-5.0, 35.0)]), ("strip", [(1.0, 1.0), (25.0, 2.0), (1.0, 3.0)])]
    rows = [(z, 0, [{"x": x, "y": y} for x, y in ring]) for z, ring in shapes]
    edges = zones.edges_of(spark.createDataFrame(rows, "zone_id string, part int, ring array<struct<x:double,y:double>>"))
    got = {}
    for r in zones.tiles_touching(edges).collect():
        got.setdefault(r["zone_id"], set()).add(r["tile_id"])
    assert got["inner"] == {"20N_010E"} and len(got["around"]) == 25 and got["strip"] == {"10N_000E", "10N_010E", "10N_020E"}


def test_edge_through_centres(spark):
    """Centres that an edge of the derived polygons runs through, inside by the SQL's test of each pixel."""
    places = [("50N_100W", 443, 41), ("50N_100W", 667, 55), ("50N_100W", 843, 66)]
    own = zones.spans(fx.zone_edges(spark).filter("zone_id = 'two_parts' AND part = 1"), fx.N)
    got = zones.pixels_in_zones(spark.createDataFrame(places, "tile_id string, row int, col int"), own)
    assert sorted((r["tile_id"], r["row"], r["col"]) for r in got.collect()) == places
