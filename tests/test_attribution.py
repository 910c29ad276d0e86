"""Crop shares, roll-ups and the factor table on small tables with known answers."""

import pytest
from pyspark.sql import functions as F

from terraflux.operators import direct, statistical, trace

STATS = "cell int, year int, crop string, area_ha double, production_mt double"


def stats(spark, areas, production=()):
    values = {}
    for i, table in enumerate((areas, dict(production))):
        for (year, crop), v in table.items():
            values.setdefault((year, crop), [0.0, 0.0])[i] = float(v)
    return spark.createDataFrame([(1, y, c, *v) for (y, c), v in values.items()], STATS)


def shares(spark, areas, before, after):
    rows = statistical.expansion_shares(stats(spark, areas)).filter((F.col("before") == before) & (F.col("after") == after)).collect()
    return {r["crop"]: r["share"] for r in rows}


def test_composition(spark):
    got = shares(spark, {(2005, "MAIZ"): 0, (2010, "MAIZ"): 100, (2010, "SOYB"): 50, (2010, "REST"): 50}, 2005, 2010)
    assert got["MAIZE"] == 0.5 and got["SOYBEAN"] == 0.25 and got["WHEAT"] == 0


def test_relabelling_makes_no_expansion(spark):
    got = shares(spark, {(2010, "MAIZ"): 10, (2020, "MAIZ"): 20, (2010, "REST"): 100, (2020, "CITR"): 60, (2020, "TOMA"): 40}, 2010, 2020)
    assert got["MAIZE"] == 1


def test_nothing_expands(spark):
    assert set(shares(spark, {(2005, "MAIZ"): 100, (2010, "MAIZ"): 50}, 2005, 2010).values()) == {0}


def test_group_is_split_by_reference_area(spark):
    got = shares(spark, {(2000, "BANP"): 100, (2005, "BANA"): 30, (2005, "PLNT"): 10, (2020, "BANA"): 175, (2020, "PLNT"): 25}, 2000, 2020)
    assert got["BANANA"] == pytest.approx(1) and got["PLANTAIN"] == 0


def test_group_is_split_evenly_without_reference(spark):
    got = shares(spark, {(2000, "BANP"): 100, (2020, "BANA"): 80, (2020, "PLNT"): 120}, 2000, 2020)
    assert got["BANANA"] == pytest.approx(0.3) and got["PLANTAIN"] == pytest.approx(0.7)


def test_production_is_split_by_area(spark):
    df = stats(spark, {(2005, "BANA"): 30, (2005, "PLNT"): 10, (2000, "BANP"): 1}, {(2000, "BANP"): 200})
    got = {r["crop"]: r["production_mt"] for r in statistical.harmonized(df).filter("year = 2000").collect()}
    assert got["BANANA"] == pytest.approx(150) and got["PLANTAIN"] == pytest.approx(50)


def test_production_weights():
    assert statistical.production_weights() == pytest.approx({2000: 0.03125, 2005: 0.125, 2010: 0.46875, 2020: 0.375})


PIXELS = "admin_id string, crop_code int, class_2020 int, ha double, peat int, occupation double, per_ha double, forest_per_ha double, peat_conversion_per_ha double"


def test_direct_masks_and_zero_rows(spark):
    rows = [("A", 1, 2, 10.0, 0, 1.0, 2.0, 1.0, 0.5), ("A", 1, 2, 20.0, 1, 1.0, None, 1.0, 0.5), ("A", 1, 3, 40.0, 1, 1.0, 2.0, 1.0, 0.5), ("A", 5, 2, 5.0, None, 1.0, 2.0, 1.0, 0.5)]
    got = direct.direct_roll_up(spark.createDataFrame(rows, PIXELS), spark.createDataFrame([("A",), ("B",)], "admin_id string"), ["MAIZE", "SOYBEAN"])
    got = {(r["admin_id"], r["crop_name"]): r for r in got.collect()}
    assert len(got) == 4
    maize = got["A", "MAIZE"]
    assert [maize[m] for m in direct.MEASURES] == [30, 20, 30, 20, 30, 15]
    assert all(got["B", c][m] == 0 for c in ("MAIZE", "SOYBEAN") for m in direct.MEASURES)
    free = direct.direct_roll_up(spark.createDataFrame(rows, PIXELS), spark.createDataFrame([("A",)], "admin_id string"), ["MAIZE"], True).first()
    assert free["crop_hectares"] == 70


ROLLED = "admin_level string, crop_name string, jurisdiction_name string, methodology string, admin_id string, crop_hectares double, forest_emissions_mt double, peatland_crop_hectares double, peatland_conversion_emissions_mt double, peatland_occupation_emissions_mt double, emissions_mt double"


def rolled(spark):
    rows = [("PROVINCIAL", "MAIZE", "X | P", "D", "XXX001", 10.0, 1.0, 2.0, 3.0, 4.0, 8.0), ("PROVINCIAL", "MAIZE", "X | Q", "D", "XXX002", 30.0, 1.0, 2.0, 3.0, 0.0, 0.0), ("PROVINCIAL", "RICE", "X | P", "D", "XXX001", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0)]
    return spark.createDataFrame(rows, ROLLED)


def test_factor_table(spark):
    yields = spark.createDataFrame([("XXX001", "CORN", y, v) for y, v in ((2016, 900.0), (2017, 100.0), (2018, 200.0))], "admin_id string, crop_name string, year int, yield_kg_per_ha double")
    made = trace.direct_production(rolled(spark), yields)
    assert trace.unmatched_yields(made).first()[0] == 2
    provincial = trace.attach_ratios(made)
    table = trace.factor_table(provincial, spark.createDataFrame([("XXX", "X")], "iso string, national_name string"))
    assert table.columns == trace.COLUMNS
    got = {(r["admin_level"], r["crop_name"], r["jurisdiction_name"]): r for r in table.collect()}
    p = got["PROVINCIAL", "MAIZE", "X | P"]
    assert p["production_kg"] == 1500 and p["emissions_factor_kgco2e_per_kg"] == pytest.approx(8000 / 1500) and p["peatland_occupation_fraction"] == 0.5
    q = got["PROVINCIAL", "MAIZE", "X | Q"]
    assert q["production_kg"] is None and q["emissions_factor_kgco2e_per_kg"] is None and q["peatland_occupation_fraction"] is None
    n = got["NATIONAL", "MAIZE", "X"]
    assert n["crop_hectares"] == 40 and n["production_kg"] == 1500 and n["yield_kg_per_ha"] == 37.5 and n["admin_id"] == "XXX"
    assert got["NATIONAL", "RICE", "X"]["yield_kg_per_ha"] is None


def test_national_is_the_sum_of_provinces(spark):
    provincial = trace.attach_ratios(trace.statistical_production(rolled(spark).withColumn("production_mt", F.lit(2.0))))
    national = trace.national(provincial, spark.createDataFrame([("XXX", "X")], "iso string, national_name string"))
    for m in trace.SUMS:
        assert national.agg(F.sum(m)).first()[0] == pytest.approx(provincial.agg(F.sum(m)).first()[0])


def test_rows_must_be_provincial(spark):
    bad = trace.attach_ratios(trace.statistical_production(rolled(spark).withColumn("production_mt", F.lit(2.0)).withColumn("admin_level", F.lit("NATIONAL"))))
    with pytest.raises(Exception, match="provincial"):
        trace.factor_table(bad, spark.createDataFrame([("XXX", "X")], "iso string, national_name string")).collect()


def test_repeated_statistics_add_up(spark):
    schema = "cell int, year int, crop string, area_ha double, production_mt double"
    whole = [(1, 2005, "MAIZ", 30.0, 3.0), (1, 2020, "MAIZ", 80.0, 9.0), (1, 2020, "SOYB", 5.0, 1.0)]
    parts = [(1, 2005, "MAIZ", 10.0, 1.0), (1, 2005, "MAIZ", 20.0, 2.0), (1, 2020, "MAIZ", 80.0, 9.0), (1, 2020, "SOYB", 5.0, 1.0), (1, 2020, None, 7.0, 1.0)]
    got = [sorted(map(tuple, statistical.crop_cells(spark.createDataFrame(rows, schema)).collect())) for rows in (whole, parts)]
    assert got[0] == got[1] and len(got[0]) == 32
