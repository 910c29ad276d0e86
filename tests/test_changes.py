"""What a rerun does again and what it leaves alone: manifests, gridded stages, partial sums; merges, grouping sets, observations."""

import re

import pytest
from pyspark.sql import functions as F

from terraflux.operators import direct, partials, trace
from terraflux.plans import fixtures as fx
from terraflux.plans import queries as q
from terraflux.sources import catalog, ingest, stages

SF = "/root/testdata/sf0.001"
SOURCE = catalog.SOURCES["aboveground-biomass"]
PIXELS = "tile_id string, row int, col int, agb double"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def wanted(spark, *tiles):
    return spark.createDataFrame([(t,) for t in tiles], "tile_id string")


def states(df):
    return sorted((r["tile_id"], r["status"], r["reason"], r["n_rows"], r["run"]) for r in df.collect())


def test_manifest(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("50N_100W", 0, 0, 1.0), ("50N_100W", 3, 9, 2.0), ("40N_100W", 2, 3, 4.0), ("20N_100W", 1, 1, 1.0)], PIXELS)
    bad = good.unionAll(spark.createDataFrame([("40N_100W", 10, 0, 1.0), ("30N_100W", None, 0, 1.0)], PIXELS))
    ids = wanted(spark, "50N_100W", "40N_100W", "30N_100W", "00N_100W", "55N_100W", "50N_100W")
    first = ingest.ingest_missing(spark, SOURCE, root, ids, bad, 10)
    assert states(first) == [
        ("00N_100W", "failed", "no pixels", None, 1), ("30N_100W", "failed", "no place", None, 1), ("40N_100W", "failed", "outside of its tile", None, 1),
        ("50N_100W", "done", None, 2, 1), ("55N_100W", "failed", "invalid tile id", None, 1),
    ]
    # a failed tile has nothing published, a tile that nobody asked for neither
    assert sorted(map(tuple, catalog.scan(spark, root, SOURCE.name).collect())) == [("50N_100W", 0, 0, 1.0), ("50N_100W", 3, 9, 2.0)]
    second = ingest.ingest_missing(spark, SOURCE, root, ids, good.filter("tile_id <> '50N_100W'"), 10)
    assert states(second) == [("00N_100W", "failed", "no pixels", None, 2), ("30N_100W", "failed", "no pixels", None, 2), ("40N_100W", "done", None, 1, 2), ("55N_100W", "failed", "invalid tile id", None, 2)]
    assert states(ingest.read_manifest(spark, SOURCE, root)) == sorted([*states(first), *states(second)])
    assert catalog.scan(spark, root, SOURCE.name).count() == 3
    # nothing is left to do; with overwrite a tile is replaced whole
    assert {r[1] for r in states(ingest.ingest_missing(spark, SOURCE, root, wanted(spark, "50N_100W", "40N_100W"), bad, 10))} == set()
    again = ingest.ingest_missing(spark, SOURCE, root, wanted(spark, "50N_100W"), good.filter("row = 3"), 10, overwrite=True)
    assert states(again) == [("50N_100W", "done", None, 1, 3)] and catalog.scan(spark, root, SOURCE.name, ["50N_100W"]).first()[:] == ("50N_100W", 3, 9, 2.0)


def test_a_failed_overwrite_keeps_the_tile(spark, tmp_path):
    root = str(tmp_path)
    ingest.ingest_missing(spark, SOURCE, root, wanted(spark, "50N_100W"), spark.createDataFrame([("50N_100W", 0, 0, 1.0)], PIXELS), 10)
    failed = ingest.ingest_missing(spark, SOURCE, root, wanted(spark, "50N_100W"), spark.createDataFrame([("50N_100W", -1, 0, 9.0)], PIXELS), 10, overwrite=True)
    assert states(failed) == [("50N_100W", "failed", "outside of its tile", None, 2)]
    assert catalog.scan(spark, root, SOURCE.name).first()[:] == ("50N_100W", 0, 0, 1.0)


def test_a_source_of_the_whole_world(spark, tmp_path):
    """Whatever tiles are asked for, it is the one tile ``world``."""
    world, root = catalog.SOURCES["climate-zones"], str(tmp_path)
    rows = spark.createDataFrame([("world", 3, 4, 7)], "tile_id string, row int, col int, zone int")
    assert states(ingest.ingest_missing(spark, world, root, wanted(spark, "50N_100W", "40N_100W"), rows, 10)) == [("world", "done", None, 1, 1)]
    assert [tuple(r) for r in catalog.scan(spark, root, world.name).collect()] == [("world", 3, 4, 7)]
    assert states(ingest.ingest_missing(spark, world, root, wanted(spark, "world"), rows, 10)) == []


def test_the_source_is_read_once(spark, tmp_path):
    """However many tiles are asked for, rows of the source are computed once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(0, 400, 1, 2).selectExpr("concat(lpad(cast(10 * (id % 4 + 1) as string), 2, '0'), 'N_100W') AS tile_id", "cast(floor(id / 40) as int) AS row", "cast(id % 40 as int) AS col", "cast(id as double) AS agb")
    ingest.ingest_missing(spark, SOURCE, str(tmp_path), wanted(spark, "10N_100W", "20N_100W", "30N_100W", "40N_100W"), rows.mapInArrow(counted, PIXELS), 40)
    assert seen.value == 400 and catalog.scan(spark, str(tmp_path), SOURCE.name).count() == 400


def test_gridded_stage(spark, tmp_path):
    root, calls = str(tmp_path), []
    px = spark.createDataFrame([("50N_100W", 0, 0, 1.0), ("40N_100W", 2, 3, 4.0), ("30N_100W", 1, 1, 5.0)], PIXELS)

    def make(tiles):
        calls.append(tiles)
        return px

    at = lambda *tiles, **k: sorted(r["tile_id"] for r in stages.gridded_stage(spark, root, "s", list(tiles), make, **k).collect())
    assert at("50N_100W") == ["50N_100W"] and at("50N_100W", "40N_100W", "10N_100W") == ["40N_100W", "50N_100W"] and at("10N_100W") == [] and at() == []
    assert calls == [["50N_100W"], ["10N_100W", "40N_100W"]]
    assert at("30N_100W", version=1) == ["30N_100W"] and at("30N_100W", year=3) == ["30N_100W"] and len(calls) == 4
    one = stages.gridded_stage(spark, root, "s", ["40N_100W"], make)
    assert "PartitionFilters: [isnotnull(tile_id" in plan_of(one) and one.select("row", "col", "agb", "tile_lat").first()[:] == (2, 3, 4.0, 40)


def test_a_tile_without_its_mark_is_made_again(spark, tmp_path):
    root, calls = str(tmp_path), []
    px = spark.createDataFrame([("50N_100W", 0, 0, 1.0)], PIXELS)

    def make(tiles):
        calls.append(tiles)
        if len(calls) == 1:
            ingest.write_pixels(px.withColumn("agb", F.lit(9.0)), stages.stage_path(root, "s", 0, {}))  # a run that was lost before its marks
            raise OSError("lost")
        return px

    with pytest.raises(OSError, match="lost"):
        stages.gridded_stage(spark, root, "s", ["50N_100W"], make)
    assert [r["agb"] for r in stages.gridded_stage(spark, root, "s", ["50N_100W"], make).collect()] == [1.0] and len(calls) == 2


def test_partial_sums_follow_changes(spark, tmp_path):
    rows = spark.createDataFrame([("a", "Z1", "MAIZE", 1.0), ("a", "Z2", "MAIZE", 2.0), ("b", "Z1", "MAIZE", 4.0), ("c", "Z3", "WHEAT", None)], "tile_id string, admin_id string, crop_name string, x double")
    every = spark.createDataFrame([("Z1", "MAIZE"), ("Z2", "MAIZE"), ("Z3", "WHEAT")], "admin_id string, crop_name string")
    asked = []

    def run(versions, table):
        def sums_of(tiles):
            asked.append(tiles)
            return table.filter(F.col("tile_id").isin(tiles))

        own, made = partials.refresh(spark, str(tmp_path / "sums"), spark.createDataFrame(list(versions.items()), "tile_id string, version long"), sums_of, ["x"])
        return {r["admin_id"]: r["x"] for r in partials.totals(own, every, ["x"]).collect()}, made

    assert run({"a": 1, "b": 1, "c": 1, "d": 1}, rows) == ({"Z1": 5.0, "Z2": 2.0, "Z3": 0.0}, ["a", "b", "c", "d"])
    changed = rows.withColumn("x", F.when(F.col("tile_id") == "b", 40.0).otherwise(F.col("x")))
    assert run({"a": 1, "b": 2, "c": 1, "d": 1}, changed) == ({"Z1": 41.0, "Z2": 2.0, "Z3": 0.0}, ["b"])
    assert run({"a": 1, "b": 2, "c": 1, "d": 1}, changed)[1] == []
    assert run({"b": 2, "d": 1}, changed) == ({"Z1": 40.0, "Z2": 0.0, "Z3": 0.0}, [])  # a tile that is gone does not count
    assert asked == [["a", "b", "c", "d"], ["b"]]


def test_incremental_equals_full(spark):
    whole = q.emitted_in_zones(q._stored_wide(spark, SF, q._scratch(spark, "t")), q._stored_cover(spark, SF, q._scratch(spark, "t")))
    full = q.rounded(direct.direct_roll_up(whole, fx.provinces(spark, SF)), 3, *direct.MEASURES)
    got = q.QUERIES["incremental_rollup"](spark, SF)
    assert got.select("tiles_made").distinct().first()[0] == 1
    assert sorted(map(tuple, got.drop("tiles_made").collect())) == sorted(map(tuple, full.collect()))


def test_five_layers_one_exchange(spark):
    px = fx.pixels(spark, SF)
    layers = [px.select("tile_id", "row", "col", band) for band in ("agb", "bgb", "soc", "peat", "crop_code")]
    merged = ingest.merge_layers(layers)
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(merged))) == 1 and "Join" not in plan_of(merged)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, px.select(*merged.columns).collect()), key=str)
    for other in (layers[1].filter("row > 0"), layers[1].unionAll(layers[1].limit(1)), layers[1].withColumn("col", F.col("col") + 1)):
        with pytest.raises(Exception, match="grids differ"):
            ingest.merge_layers([layers[0], other]).collect()
    with pytest.raises(ValueError, match="one name"):
        ingest.merge_layers([layers[0], layers[0]])


PROVINCES = "admin_level string, crop_name string, jurisdiction_name string, methodology string, admin_id string, crop_hectares double, forest_emissions_mt double, peatland_crop_hectares double, peatland_conversion_emissions_mt double, peatland_occupation_emissions_mt double, emissions_mt double, production_kg double"


def provinces(spark, *rows):
    own = spark.createDataFrame([(level, crop, f"N | {i}", "M", i, ha, 1.0, 1.0, 1.0, 1.0, mt, kg) for level, crop, i, ha, mt, kg in rows], PROVINCES)
    return trace.attach_ratios(own)


def test_one_roll_up_for_all_levels(spark):
    own = provinces(spark, ("PROVINCIAL", "MAIZE", "AAA001", 2.0, 4.0, 10.0), ("PROVINCIAL", "MAIZE", "AAA002", 2.0, 4.0, None), ("PROVINCIAL", "MAIZE", "BBB001", 0.0, 1.0, 0.0), ("PROVINCIAL", "WHEAT", "CCC001", 1.0, 1.0, 5.0))
    countries = spark.createDataFrame([("AAA", "A"), ("BBB", "B")], "iso string, national_name string")
    regions = spark.createDataFrame([("AAA", "R"), ("BBB", "R")], "iso string, region string")
    table = trace.factor_table(own, countries, regions)
    got = {(r["admin_level"], r["admin_id"], r["crop_name"]): (r["jurisdiction_name"], r["crop_hectares"], r["production_kg"], r["yield_kg_per_ha"], r["emissions_factor_kgco2e_per_kg"]) for r in table.collect()}
    assert got == {
        ("PROVINCIAL", "AAA001", "MAIZE"): ("N | AAA001", 2.0, 10.0, 5.0, 400.0), ("PROVINCIAL", "AAA002", "MAIZE"): ("N | AAA002", 2.0, None, None, None),
        ("PROVINCIAL", "BBB001", "MAIZE"): ("N | BBB001", 0.0, 0.0, None, None), ("PROVINCIAL", "CCC001", "WHEAT"): ("N | CCC001", 1.0, 5.0, 5.0, 200.0),
        ("NATIONAL", "AAA", "MAIZE"): ("A", 4.0, 10.0, 2.5, 800.0), ("NATIONAL", "BBB", "MAIZE"): ("B", 0.0, 0.0, None, None), ("REGIONAL", "R", "MAIZE"): ("R", 4.0, 10.0, 2.5, 900.0),
    }
    assert sorted(map(tuple, trace.factor_table(own, countries).filter("admin_level = 'NATIONAL'").collect())) == sorted(map(tuple, trace.national(own, countries).collect()))


def test_the_provincial_rows_are_made_once(spark):
    plan = plan_of(q.QUERIES["factor_table"](spark, SF))
    assert "Expand" in plan and len(re.findall(r"FileScan.*orders\.parquet", plan)) == 1


def test_rows_that_are_not_provincial_are_an_error(spark):
    own = provinces(spark, ("NATIONAL", "MAIZE", "AAA001", 2.0, 4.0, 10.0))
    with pytest.raises(Exception, match="must be provincial"):
        trace.factor_table(own, spark.createDataFrame([("AAA", "A")], "iso string, national_name string")).collect()


def test_observed_while_writing(spark, tmp_path):
    """The counts come from the write's own pass: its rows are computed once."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    own = provinces(spark, ("PROVINCIAL", "MAIZE", "AAA001", 2.0, 4.0, 10.0), ("PROVINCIAL", "MAIZE", "AAA002", 2.0, 4.0, None))
    countries = spark.createDataFrame([("AAA", "A")], "iso string, national_name string")
    assert trace.write_factors(own.mapInArrow(counted, own.schema), countries, str(tmp_path / "f")) == {"rows": 2, "unmatched": 1, "not_provincial": 0}
    assert seen.value == 2 and spark.read.parquet(str(tmp_path / "f")).count() == 3
