"""Attribution to crops by each crop's share of local crop expansion, from long crop statistics (cell, year, crop, area_ha, production_mt)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.factors import SPANS
from terraflux.functions import emissions as e
from terraflux.functions.nulls import or_zero
from terraflux.operators import resample
from terraflux.operators.emit import split_sources

LAYERS = ["occupation", *[f"{s}_{a}_{b}" for s in ("emissions", "forest", "peat_conversion") for a, b in SPANS]]


def coarse_layers(emitted: DataFrame, n: int, m: int, skip_crop_filter: bool = False, last: int | None = None) -> DataFrame:
    """Mean of every layer and the peat fraction per coarse cell (tile_id, crow, ccol), ``last`` the last index; layers are 0 off current cropland."""
    own = split_sources(emitted)
    if not skip_crop_filter:
        crop = F.col(f"class_{k.YEARS[-1]}") == k.CROPLAND
        own = own.select("tile_id", "row", "col", "peat", *[or_zero(crop, F.col(x)).alias(x) for x in LAYERS])
    own = own.withColumn("peat", F.col("peat").cast("double"))
    return resample.average(own, n, m, ["peat", *LAYERS], last).withColumnRenamed("peat", "peat_fraction")


_CROP_FIELDS = ["crop", "code_2005", "code_2000", "code_2010", "code_2020", "grp", "siblings"]


def _crops() -> list[tuple]:
    groups = k.group_of()
    return [(name, code, groups.get(code, (code, 0))[0], code, k.RENAMED_2020.get(code, code), *groups.get(code, (None, None))) for name, code in k.STATISTICAL_CROPS.items()]


def crop_table(spark: SparkSession) -> DataFrame:
    """(crop, code_<year>, grp, siblings) of the 32 attributed crops; code_2000 of a constituent is its group's."""
    return spark.createDataFrame(_crops(), "crop string, code_2005 string, code_2000 string, code_2010 string, code_2020 string, grp string, siblings int")


def crop_taxonomy(spark: SparkSession) -> DataFrame:
    """(year, code, label) of all crops of all statistics years."""
    return spark.createDataFrame(k.taxonomy(), "year int, code string, label string")


def codes_in_year(rows: DataFrame, year: int) -> DataFrame:
    """``rows`` (year, crop) with the label of each crop and its code in another year through that label, NULL where that year has none."""
    known = F.broadcast(crop_taxonomy(rows.sparkSession))  # 151 rows
    labels = known.select("year", F.col("code").alias("crop"), "label")
    there = known.filter(F.col("year") == year).select("label", F.col("code").alias("crop_there"))
    return rows.join(labels, ["year", "crop"], "left").join(there, "label", "left")


SHARE_SPANS = [(2000, 2005), (2005, 2010), (2010, 2020), (2000, 2020)]


def crop_cells(stats: DataFrame) -> DataFrame:
    """One row per cell and attributed crop: area_<year> and production_<year> harmonised, total_<span>, crop_area.

    A group of 2000 is split by the areas of its constituents in 2005, evenly where none had any; the
    area share splits production, too. total_<span> is the cell's expansion: of each shared crop, and net
    of all others as one pool, so that re-labelling makes none. Missing statistics are 0, but for crop_area, the
    area in 2020 as given.

    A cell has a few dozen crops a year, so all of it is one aggregate by cell and then arithmetic
    within the row; the fixed list of crops is a literal of the plan. Repeated rows of a cell, year and crop add up; rows
    without a crop count for nothing.
    """
    # dealt by cell once, for both aggregates
    stats = stats.filter(F.col("crop").isNotNull()).repartition("cell").groupBy("cell", "year", "crop").agg(F.sum("area_ha").alias("area_ha"), F.sum("production_mt").alias("production_mt"))
    text = lambda v: "NULL" if v is None else repr(v)
    struct = lambda row: ", ".join(f"'{f}', CAST({text(v)} AS {'INT' if f == 'siblings' else 'STRING'})" for f, v in zip(_CROP_FIELDS, row, strict=True))
    # one text for the parser, as a call for each literal takes the driver seconds
    literals = F.expr("array(" + ", ".join(f"named_struct({struct(row)})" for row in _crops()) + ")")
    strings = lambda values: F.expr("array(" + ", ".join(map(repr, values)) + ")")
    shared = F.col("crop").isin(k.SHARED)
    value = lambda year, q: F.map_from_entries(F.collect_list(F.when(F.col("year") == year, F.struct("crop", q))))
    maps = [value(y, q).alias(f"{q}_{y}") for y in k.STATISTICS_YEARS for q in ("area_ha", "production_mt")]
    pools = [F.coalesce(F.sum(F.when((F.col("year") == y) & ~shared, F.col("area_ha"))), F.lit(0.0)).alias(f"pool_{y}") for y in k.STATISTICS_YEARS]
    cells = stats.groupBy("cell").agg(*maps, *pools)
    at = lambda y, q, code: F.coalesce(F.try_element_at(F.col(f"{q}_{y}"), code), F.lit(0.0))
    grown = lambda before, after: F.greatest(after - before, F.lit(0.0))
    codes = strings(k.SHARED)
    common = lambda a, b: F.aggregate(codes, F.lit(0.0), lambda total, x: total + grown(at(a, "area_ha", x), at(b, "area_ha", x)))
    groups = F.create_map(*[x for g, parts in k.GROUPS.items() for x in (F.lit(g), F.aggregate(strings(parts), F.lit(0.0), lambda total, x: total + at(2005, "area_ha", x)))])
    cells = cells.select("*", groups.alias("references"), *[(common(a, b) + grown(F.col(f"pool_{a}"), F.col(f"pool_{b}"))).alias(f"total_{a}_{b}") for a, b in SHARE_SPANS])
    rows = cells.select("*", F.explode(literals).alias("k")).select("*", "k.*")
    reference = F.try_element_at("references", F.col("grp"))
    share = F.when(F.col("grp").isNull(), 1.0).when(reference > 0, at(2005, "area_ha", F.col("code_2005")) / reference).otherwise(1 / F.col("siblings"))
    rows = rows.withColumn("part", share)
    own = [(at(y, q, F.col(f"code_{y}")) * (F.col("part") if y == 2000 else F.lit(1.0))).alias(f"{name}_{y}") for y in k.STATISTICS_YEARS for q, name in (("area_ha", "area"), ("production_mt", "production"))]
    return rows.select("cell", "crop", *own, *[f"total_{a}_{b}" for a, b in SHARE_SPANS], F.try_element_at("area_ha_2020", F.col("code_2020")).alias("crop_area"))


def harmonized(stats: DataFrame) -> DataFrame:
    """(cell, year, crop, area_ha, production_mt) for every cell and attributed crop."""
    years = F.array(*[F.struct(F.lit(y).alias("year"), F.col(f"area_{y}").alias("area_ha"), F.col(f"production_{y}").alias("production_mt")) for y in k.STATISTICS_YEARS])
    return crop_cells(stats).select("cell", "crop", F.explode(years).alias("v")).select("cell", "v.year", "crop", "v.area_ha", "v.production_mt")


def _expansion(a: int, b: int) -> Column:
    return F.greatest(F.col(f"area_{b}") - F.col(f"area_{a}"), F.lit(0.0))


def _share(a: int, b: int) -> Column:
    total = F.col(f"total_{a}_{b}")
    return F.when(total > 0, _expansion(a, b) / total).otherwise(0.0)


def expansion_shares(stats: DataFrame) -> DataFrame:
    """(cell, crop, before, after, expansion, total, share) for three spans and the whole period.

    The share is 0 where nothing expands, and is not capped.
    """
    spans = F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("after"), _expansion(a, b).alias("expansion"), F.col(f"total_{a}_{b}").alias("total"), _share(a, b).alias("share")) for a, b in SHARE_SPANS])
    return crop_cells(stats).select("cell", "crop", F.explode(spans).alias("s")).select("cell", "crop", "s.*")


def production_weights() -> dict[int, float]:
    """Weight of each statistics year in the discounted production: half of its spans' weights."""
    total, out = sum(k.SPAN_WEIGHTS.values()), dict.fromkeys(k.STATISTICS_YEARS, 0.0)
    for span, weight in k.SPAN_WEIGHTS.items():
        for year in k.STATISTICS_SPAN[span]:
            out[year] += weight / 2 / total
    return out


def _production() -> Column:
    return sum((F.col(f"production_{y}") * w for y, w in production_weights().items()), F.lit(0.0))


def windowed_production(stats: DataFrame) -> DataFrame:
    """(cell, crop, production_mt): production discounted over the spans."""
    return crop_cells(stats).select("cell", "crop", _production().alias("production_mt"))


MEASURES = ["crop_hectares", "forest_emissions_mt", "peatland_conversion_emissions_mt", "peatland_crop_hectares", "peatland_occupation_emissions_mt", "emissions_mt", "production_mt"]


def roll_up(layers: DataFrame, stats: DataFrame, zones: DataFrame, crops: list[str] | None = None) -> DataFrame:
    """Seven measures per (admin_id, crop).

    ``layers``: cell, ha and coarse layers; ``zones``: (cell, admin_id). Shares are made per cell once, whatever
    the number of zones. A zone's crop without any value has 0.
    """
    rows = crop_cells(stats)
    if crops:
        rows = rows.filter(F.col("crop").isin(crops))
    rows = rows.select("cell", "crop", "crop_area", _production().alias("production_mt"), *[_share(a, b).alias(f"share_{a}_{b}") for a, b in SHARE_SPANS])
    rows = rows.join(layers.join(zones, "cell"), "cell")
    of = lambda source: e.discounted({(a, b): F.col(f"{source}_{a}_{b}") * F.col("ha") * F.col("share_{}_{}".format(*k.STATISTICS_SPAN[a, b])) for a, b in SPANS})
    occupation = F.col("occupation") * F.col("ha") * F.col("share_2000_2020")
    values = {
        "crop_hectares": F.col("crop_area"),
        "forest_emissions_mt": of("forest"),
        "peatland_conversion_emissions_mt": of("peat_conversion"),
        "peatland_crop_hectares": F.col("crop_area") * F.col("peat_fraction"),
        "peatland_occupation_emissions_mt": occupation,
        "emissions_mt": of("emissions") + occupation,
        "production_mt": F.col("production_mt"),
    }
    return rows.groupBy("admin_id", F.col("crop").alias("crop_name")).agg(*[F.coalesce(F.sum(x), F.lit(0.0)).alias(name) for name, x in values.items()])
