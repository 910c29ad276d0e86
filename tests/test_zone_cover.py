"""Zone covers, polygons in the roll-ups, and what is read for them."""

import re

import pytest
from pyspark.sql import functions as F

from terraflux.operators import zones
from terraflux.plans import fixtures as fx
from terraflux.plans import queries as q
from terraflux.sources import ingest

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(node):
    """File scans of an executed plan, those of stages that ran included."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(node.plan())
    if name == "FileSourceScanExec":
        return [node]
    children = node.children()
    return [x for i in range(children.size()) for x in scans(children.apply(i))]


def partitions_read(df, column):
    """How many partitions the scan that has ``column`` read."""
    own = [s for s in scans(df._jdf.queryExecution().executedPlan()) if column in s.output().mkString(",")]
    assert len(own) == 1
    return own[0].metrics().apply("numPartitions").value()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("zones"))
    zones.cover(fx.nation_edges(spark, SF), fx.WIDE_N, fx.WIDE_BLOCK).write.parquet(f"{root}/whole-cover")
    return q._stored_wide(spark, SF, root), spark.read.parquet(f"{root}/whole-cover")


def test_only_the_tiles_of_the_zones_are_read(spark, stored):
    pixels, cover = stored
    assert pixels.select("tile_id").distinct().count() == 4
    met = zones.pixels_in_cover(pixels, cover.filter(F.col("zone_id") == "RG0000"), fx.WIDE_BLOCK)
    assert "dynamicpruning" in plan_of(met)
    touched = {r[0] for r in cover.filter(F.col("zone_id") == "RG0000").select("tile_id").distinct().collect()}
    assert touched == {"50N_100W"} and met.count() > 0
    rows = met.select("zone_id", "tile_id", "row", "col", "agb")
    rows.collect()
    assert partitions_read(rows, "agb") == 1
    country = zones.pixels_in_cover(pixels, cover.filter(F.col("zone_id").startswith("RG1")), fx.WIDE_BLOCK).select("zone_id", "tile_id", "row", "col", "agb")
    country.collect()
    touched = {r[0] for r in cover.filter(F.col("zone_id").startswith("RG1")).select("tile_id").distinct().collect()}
    assert partitions_read(country, "agb") == len(touched & {r[0] for r in pixels.select("tile_id").distinct().collect()})


def test_a_stored_quadtree_prunes_too(spark, stored, tmp_path):
    own = q._stored_cover(spark, SF, str(tmp_path), F.col("zone_id") == "RG0000")
    met = zones.pixels_in_cover(stored[0], own, fx.WIDE_BLOCK).select("zone_id", "tile_id", "row", "col", "agb")
    assert "dynamicpruning" in plan_of(met) and met.count() > 0
    met.collect()
    assert partitions_read(met, "agb") == 1


def test_pixels_do_not_move(stored):
    """Neither before nor after a join with a small cover are pixels exchanged; the roll-up's exchange has sums."""
    pixels, cover = stored
    met = zones.pixels_in_cover(pixels, cover, fx.WIDE_BLOCK).select("zone_id", "tile_id", "row", "col")
    met.collect()
    final = re.split("== Initial Plan ==", plan_of(met))[0]
    assert "BroadcastHashJoin" in final and not re.search(r"(?<!Broadcast)Exchange", final)


def test_a_large_cover_is_joined_by_a_shuffle(stored):
    """Beyond the bound the tiles are a filter of the scan; the rows are the same."""
    pixels, cover = stored
    own = cover.filter(F.col("zone_id") == "RG0000")
    large, small = (zones.pixels_in_cover(pixels, own, fx.WIDE_BLOCK, most).select("zone_id", "tile_id", "row", "col") for most in (0, zones.COVER_BYTES))
    assert "PartitionFilters: [isnotnull(tile_id" in plan_of(large) and "50N_100W" in plan_of(large) and "dynamicpruning" not in plan_of(large).split("50N_100W")[0]
    assert large.exceptAll(small).count() == small.exceptAll(large).count() == 0


def test_cover_and_runs_agree(spark, stored):
    pixels, cover = stored
    by_blocks = zones.pixels_in_cover(pixels, cover, fx.WIDE_BLOCK).select("zone_id", "tile_id", "row", "col")
    by_runs = zones.pixels_in_zones(pixels, zones.spans(fx.nation_edges(spark, SF), fx.WIDE_N)).select("zone_id", "tile_id", "row", "col")
    assert by_blocks.count() == by_runs.count() == by_runs.distinct().count() > 1000
    assert by_blocks.exceptAll(by_runs).count() == 0
    assert 0 < cover.filter("whole").count() < cover.count() and cover.filter("whole AND runs IS NOT NULL OR NOT whole AND size(runs) <> 50").count() == 0


@pytest.mark.parametrize("block", [1, 3, 7, 10, 16])
def test_blocks_of_any_size(spark, block):
    """Blocks that do not divide a tile, too; a square whose sides are on block borders has whole blocks only."""
    ring = [{"x": x, "y": y} for x, y in [(0.0, 10.0), (12.0, 10.0), (12.0, 4.0), (0.0, 4.0)]]
    edges = zones.edges_of(spark.createDataFrame([("z", 0, ring)], "zone_id string, part int, ring array<struct<x:double,y:double>>"))
    pixels = spark.createDataFrame([(t, r, c) for t in ("10N_000E", "10N_010E") for r in range(10) for c in range(10)], "tile_id string, row int, col int")
    blocked = pixels.withColumn("block_id", zones.block_of(F.col("row"), F.col("col"), block))
    got = zones.pixels_in_cover(blocked, zones.cover(edges, 10, block), block)
    assert {(r["tile_id"], r["row"], r["col"]) for r in got.collect()} == {("10N_000E", r, c) for r in range(6) for c in range(10)} | {("10N_010E", r, c) for r in range(6) for c in range(2)}
    if block in (1,):
        assert zones.cover(edges, 10, block).filter("NOT whole").count() == 0


@pytest.mark.parametrize("block", [2, 5])
def test_quadtree_round_trip(spark, tmp_path, block):
    """Squares are as large as they can be, and their blocks are the whole ones; the border is stored beside them."""
    ring = [{"x": x, "y": y} for x, y in [(0.0, 10.0), (8.0, 10.0), (8.0, 4.0), (1.2, 1.3)]]
    edges = zones.edges_of(spark.createDataFrame([("z", 0, ring)], "zone_id string, part int, ring array<struct<x:double,y:double>>"))
    own = zones.cover(edges, 40, block).select("zone_id", "tile_id", "block_id", "whole", "runs")
    nodes = zones.quadtree(own, 40 // block)
    assert sorted(map(tuple, zones.blocks_of(nodes).collect())) == sorted(map(tuple, own.filter("whole").select("zone_id", "tile_id", "block_id").collect()))
    families = nodes.groupBy("zone_id", "tile_id", "level", F.shiftright("a", 1), F.shiftright("b", 1)).count()
    assert families.filter("count = 4").count() == 0 and nodes.filter("level > 0").count() > 0
    assert nodes.count() < own.filter("whole").count()
    zones.write_cover(own, str(tmp_path / "c"), 40 // block)
    back = zones.read_cover(spark, str(tmp_path / "c"))
    assert sorted(map(str, back.collect())) == sorted(map(str, own.select(*back.columns).collect()))
    assert zones.read_cover(spark, str(tmp_path / "c"), F.col("zone_id") == "y").count() == 0


def test_runs_are_united(spark):
    rows = [("z", p, "t", 0, a, b) for p, a, b in [(0, 0, 4), (1, 3, 6), (2, 7, 9), (3, 20, 22), (3, 21, 21), (4, 1, 2)]] + [("y", 0, "t", 0, 5, 6)]
    own = zones.united(spark.createDataFrame(rows, "zone_id string, part int, tile_id string, row int, col_first int, col_last int"))
    assert sorted(map(tuple, own.collect())) == [("y", "t", 0, 5, 6), ("z", "t", 0, 0, 9), ("z", "t", 0, 20, 22)]


def test_an_empty_tile_list_reads_nothing(spark, tmp_path):
    from terraflux.sources import catalog

    source = catalog.SOURCES["aboveground-biomass"]
    ingest.write_pixels(spark.createDataFrame([("50N_100W", 0, 0, 1.0)], "tile_id string, row int, col int, agb double"), source.path(str(tmp_path)))
    assert catalog.scan(spark, str(tmp_path), source.name, []).count() == 0 and catalog.scan(spark, str(tmp_path), source.name).count() == 1
    assert spark.read.parquet(source.path(str(tmp_path))).select("tile_lat", "block_id").first()[:] == (50, 0)
