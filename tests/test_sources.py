"""Ingest decisions, stage tables, exports and the stream."""

import re

import pytest
from pyspark.sql import functions as F

from terraflux.operators.emit import emit
from terraflux.plans import fixtures as fx
from terraflux.sources import catalog, export, ingest, stages
from terraflux.streaming.emission_stream import emit_new_files

SF = "/root/testdata/sf0.001"


def test_states():
    states = dict(ingest.us_states())
    assert len(states) == 51 and states[1] == "USA001" and states[11] == "USA009" and states[56] == "USA051" and 3 not in states


def test_yields(spark):
    raw = spark.createDataFrame([(1, 2017, "CORN", "1,234.5"), (1, 2018, "CORN", "(D)"), (99, 2017, "WHEAT", "3")], "state_fips_code int, year int, commodity_desc string, value string")
    rows = ingest.parse_yields(raw, spark.createDataFrame(ingest.us_states(), "state_fips_code int, admin_id string")).collect()
    assert len(rows) == 1 and rows[0]["yield_kg_per_ha"] == pytest.approx(1234.5 * 56 * 0.45359237 / 0.40468564)


def test_exact_merge(spark):
    a = spark.createDataFrame([("t", 0, 0, 1.0)], "tile_id string, row int, col int, a double")
    b = spark.createDataFrame([("t", 0, 0, 2.0)], "tile_id string, row int, col int, b double")
    assert ingest.exact_merge(a, b).first()[:] == ("t", 0, 0, 1.0, 2.0)
    with pytest.raises(Exception, match="grids differ"):
        ingest.exact_merge(a, b.withColumn("col", F.lit(1))).collect()


def test_quarantine(spark):
    rows = spark.createDataFrame([("a", "50N_100W"), ("a", "55N_100W"), ("w", "50N_100W"), ("x", "world")], "dataset string, tile_id string")
    got = {(r["dataset"], r["tile_id"]): r["reason"] for r in ingest.sort_out(rows, {"a": "TEN_DEGREE", "w": "WHOLE_WORLD"}).collect()}
    assert got == {("a", "50N_100W"): None, ("a", "55N_100W"): "invalid tile id", ("w", "world"): None, ("x", "world"): "unknown dataset"}


def test_missing_tiles(spark):
    need = spark.createDataFrame([("a", "50N_100W")], "dataset string, tile_id string")
    assert ingest.refuse_missing(need, need.limit(0), True).count() == 1
    with pytest.raises(FileNotFoundError):
        ingest.refuse_missing(need, need.limit(0), False)


def test_stage_runs_once(spark, tmp_path):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    for version in (0, 0, 1):
        assert stages.stage(spark, str(tmp_path), "s", make, version, tiles=["a"]).count() == 3
    assert len(calls) == 2


def partition_filters(df):
    """What the scan of ``df`` prunes partitions by, without expression ids."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+", "", re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1))


def test_scan_prunes_and_cleans(spark, tmp_path):
    source = catalog.SOURCES["aboveground-biomass"]
    df = spark.createDataFrame([("50N_100W", 0, 0, 65535.0), ("50N_100W", 0, 1, 3.0), ("40N_100W", 0, 0, 1.0)], "tile_id string, row int, col int, agb double")
    ingest.write_pixels(df, source.path(str(tmp_path)))
    got = catalog.scan(spark, str(tmp_path), source.name, ["50N_100W"])
    assert sorted((r["col"], r["agb"]) for r in got.collect()) == [(0, None), (1, 3.0)]
    assert partition_filters(got) == "isnotnull(tile_id), (tile_id = 50N_100W)"
    both = catalog.scan(spark, str(tmp_path), source.name, ["50N_100W", "40N_100W"])
    assert both.count() == 3 and partition_filters(both) == "tile_id IN (50N_100W,40N_100W)"
    assert source.only_band == "aboveground-biomass:density:agb" and source.only_band in catalog.qualified(got, source).columns


def test_export(spark, tmp_path):
    schema = "admin_level string, crop_name string, jurisdiction_name string, production_kg double, emissions_factor_kgco2e_per_kg double"
    rows = [("NATIONAL", "MAIZE", "X", 10.0, 2.0), ("PROVINCIAL", "MAIZE", "X | P", 4.0, 1.0), ("PROVINCIAL", "MAIZE", "X | Gone", 4.0, 1.0), ("PROVINCIAL", "MAIZE", "Y | P", 4.0, 1.0)]
    records = export.payload(spark.createDataFrame(rows, schema), spark.createDataFrame([("X | Gone",)], "jurisdiction_name string"))
    assert {(r["country"], r["province"], r["emissions_kgco2e"]) for r in records.collect()} == {("X", "", 20.0), ("X", "P", 4.0)}
    export.write_payload(records, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).filter("identifier is not null").count() == 2


def test_stream_equals_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    pixels = fx.pixels(spark, SF)
    for part in (0, 1):
        pixels.filter(F.col("o") % 2 == part).write.mode("append").parquet(source)
        emit_new_files(spark, source, pixels.schema, target, str(tmp_path / "check"), fx.N).awaitTermination()
    batch = emit(pixels, fx.N).agg(F.count("*"), F.round(F.sum("per_ha"), 3)).first()
    assert spark.read.parquet(target).agg(F.count("*"), F.round(F.sum("per_ha"), 3)).first() == batch


def test_ingest_tile_by_tile(spark, tmp_path):
    source = catalog.SOURCES["aboveground-biomass"]
    rows = spark.createDataFrame([("50N_100W", 0, 0, 1.0), ("40N_100W", 2, 3, 4.0)], "tile_id string, row int, col int, agb double")
    asked = []

    def read(tile):
        asked.append(tile)
        if tile == "30N_100W":
            raise OSError("no such file")
        return rows

    ids = ["50N_100W", "30N_100W", "20N_100W", "40N_100W", "50N_100W"]
    got = ingest.ingest_tiles(spark, source, str(tmp_path), ids, read)
    assert [t for t in got if isinstance(got[t], str)] == ["50N_100W", "40N_100W"] and "no such file" in str(got["30N_100W"]) and "no pixels" in str(got["20N_100W"])
    assert sorted(map(tuple, catalog.scan(spark, str(tmp_path), source.name).collect())) == [("40N_100W", 2, 3, 4.0), ("50N_100W", 0, 0, 1.0)]
    asked.clear()
    ingest.ingest_tiles(spark, source, str(tmp_path), ids, read)
    assert asked == ["30N_100W", "20N_100W"]
    with pytest.raises(ValueError, match="invalid tile ids 55N_100W"):
        ingest.ingest_tiles(spark, source, str(tmp_path), ["50N_100W", "55N_100W"], read)
    world = catalog.SOURCES["climate-zones"]
    whole = spark.createDataFrame([("world", 0, 0, 3)], "tile_id string, row int, col int, zone int")
    assert list(ingest.ingest_tiles(spark, world, str(tmp_path), ids, lambda tile: whole)) == ["world"]
    assert [tuple(r) for r in catalog.scan(spark, str(tmp_path), "climate-zones").collect()] == [("world", 0, 0, 3)]


def test_cached_stage(spark, tmp_path):
    made = []

    @stages.cached(version=3, ignored=("note",))
    def numbers(spark, root, n, step=1, note=""):
        made.append((n, step, note))
        return spark.range(0, n, step)

    at = lambda *a, **k: numbers(spark, str(tmp_path), *a, **k).count()
    assert [at(10), at(10, note="x"), at(n=10, step=1), at(10, step=2), at(4)] == [10, 10, 10, 5, 4]
    assert made == [(10, 1, ""), (10, 2, ""), (4, 1, "")]
    with pytest.raises(ValueError, match="no argument other"):
        stages.cached(version=1, ignored=("other",))(lambda spark, root: None)


def test_tables_are_checked(spark, tmp_path):
    table = catalog.TABLES["survey-yields"]
    rows = spark.createDataFrame([("USA002", "CORN", 2018, 1.0, "x"), ("USA001", "WHEAT", 2017, 2.0, "y")], "admin_id string, crop_name string, year long, yield_kg_per_ha float, other string")
    ingest.write_table(table.checked(rows), table.path(str(tmp_path)), list(table.keys))
    back = spark.read.parquet(table.path(str(tmp_path)))
    assert back.dtypes == [("admin_id", "string"), ("crop_name", "string"), ("year", "int"), ("yield_kg_per_ha", "double")]
    assert [r["admin_id"] for r in back.collect()] == ["USA001", "USA002"]
    with pytest.raises(ValueError, match="no column year"):
        table.checked(rows.drop("year"))
    with pytest.raises(Exception, match="null in admin_id, crop_name, year"):
        table.checked(rows.withColumn("year", F.lit(None).cast("int"))).collect()
    assert len(catalog.SOURCES) + len(catalog.TABLES) == 20


def test_global_grid_is_clipped_filled_and_flipped(spark):
    rows = spark.createDataFrame([(50.0, -100.0, 1.0), (40.0, -90.0, 2.0), (45.0, -95.0, float("nan")), (39.0, -95.0, 9.0), (50.0, -89.0, 9.0), (49.0, -100.0, None)], "lat double, lon double, roots double")
    got = {(r["row"], r["col"]): r["roots"] for r in catalog.clip_global(rows, "50N_100W", 1.0, "roots").collect()}
    assert len(got) == 121 and {k: v for k, v in got.items() if v} == {(0, 0): 1.0, (10, 10): 2.0}
    centres = spark.createDataFrame([(49.5, -99.5, 1.0), (40.5, -90.5, 2.0), (50.5, -99.5, 9.0)], "lat double, lon double, roots double")
    got = {(r["row"], r["col"]): r["roots"] for r in catalog.clip_global(centres, "50N_100W", 1.0, "roots", (0.5, 0.5)).collect()}
    assert len(got) == 100 and {k: v for k, v in got.items() if v} == {(0, 0): 1.0, (9, 9): 2.0}


def test_pasted_cells_move(spark):
    rows = spark.createDataFrame([(1, 2, 5.0)], "row int, col int, z double")
    assert catalog.paste(rows, 10, 20).first()[:] == (11, 22, 5.0)


def test_bucketed_layers_merge_without_a_shuffle(spark, tmp_path):
    px = fx.pixels(spark, SF)
    left, right = (ingest.write_for_merges(px.select("tile_id", "row", "col", band), f"layer_{band}", str(tmp_path / band), 4) for band in ("agb", "soc"))
    merged = ingest.exact_merge(left, right)
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, px.select("tile_id", "row", "col", "agb", "soc").collect()), key=str)
    finally:
        for band in ("agb", "soc"):
            spark.sql(f"DROP TABLE layer_{band}")


def test_years_meet_before_they_are_added_up(spark):
    """A row a pixel of any year, by one shuffle, before which nothing is aggregated."""
    rows = {2000: [("a", 0, 0, 1), ("a", 0, 1, None)], 2005: [("a", 0, 0, 3), ("b", 2, 0, 4)]}
    years = {y: spark.createDataFrame(own, "tile_id string, row int, col int, lc int") for y, own in rows.items()}
    stacked = catalog.stack_years(years, "lc")
    assert stacked.columns == ["tile_id", "row", "col", "lc_2000", "lc_2005"]
    plan = stacked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" in plan and "Aggregate" not in plan[plan.index("Exchange") :]
    assert sorted(map(tuple, stacked.collect())) == [("a", 0, 0, 1, 3), ("a", 0, 1, None, None), ("b", 2, 0, None, 4)]
