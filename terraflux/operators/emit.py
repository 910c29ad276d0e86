"""The emission stage: one projection over pixels, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.factors import SPANS, YEARS
from terraflux.functions import emissions as e
from terraflux.functions import tiles

KEY = ["tile_id", "row", "col"]

#: Published names of the stage's columns: prefix, units, suffix.
PUBLISHED = {
    **{f"class_{y}": f"land-class:{y}" for y in YEARS},
    **{f"{ours}_{a}_{b}": f"{theirs}:tco2e-per-ha:{a}-{b}" for ours, theirs in (("vegetation", "vegetation-emissions"), ("soil", "soil-emissions"), ("emissions", "emissions")) for a, b in SPANS},
    "occupation": "peatland-occupation:tco2e-per-ha",
    "per_ha": "emissions-per-hectare:tco2e-per-ha",
    "ha": "hectares-per-pixel:ha",
}


def published(emitted: DataFrame) -> DataFrame:
    """Key and emission columns under their published names."""
    return emitted.select(*KEY, *[F.col(ours).alias(theirs) for ours, theirs in PUBLISHED.items()])


def emit(pixels: DataFrame, n: int) -> DataFrame:
    """Emission columns beside ``pixels`` (tile_id, row, col, lc_<year>, agb, bgb, soc, zone, peat), ``n`` pixels a tile side.

    Steps are projections on top of each other, so that classes and carbon stocks, which several
    years and spans share, are computed once. A stored pixel table has the latitude of its tile as a number; where that is
    absent it is read out of the tile's name.
    """
    c = F.col
    stocks = [e.forest_carbon(c("agb"), c("bgb"), c("zone")).alias("forest_stock"), e.grassland_carbon(c("zone")).alias("grass_stock"), e.mineral_soil_emissions(c("zone"), c("soc")).alias("mineral")]
    out = pixels.select("*", *[e.land_class(c(f"lc_{y}")).alias(f"class_{y}") for y in YEARS], *stocks)
    out = out.select("*", *[e.vegetation_carbon(c(f"class_{y}"), c("forest_stock"), c("grass_stock")).alias(f"carbon_{y}") for y in YEARS])
    vegetation = [e.vegetation_emissions(c(f"carbon_{a}"), c(f"carbon_{b}")).alias(f"vegetation_{a}_{b}") for a, b in SPANS]
    soil = [e.soil_emissions(c(f"class_{a}"), c(f"class_{b}"), c("peat"), c("mineral")).alias(f"soil_{a}_{b}") for a, b in SPANS]
    out = out.select("*", *vegetation, *soil).drop("forest_stock", "grass_stock", "mineral", *[f"carbon_{y}" for y in YEARS])
    span = {(a, b): c(f"vegetation_{a}_{b}") + c(f"soil_{a}_{b}") for a, b in SPANS}
    occupation = e.peat_occupation(c("peat"), c(f"class_{YEARS[-1]}"))
    top = c(tiles.LAT) if tiles.LAT in pixels.columns else tiles.lat_of(c("tile_id"))
    area = tiles.hectares(tiles.row_lat(top, c("row"), n), tiles.SPAN / n)
    out = out.select("*", *[x.alias(f"emissions_{a}_{b}") for (a, b), x in span.items()], occupation.alias("occupation"), area.alias("ha"))
    return out.withColumn("per_ha", e.discounted({(a, b): c(f"emissions_{a}_{b}") for a, b in SPANS}) + c("occupation"))


def split_sources(emitted: DataFrame) -> DataFrame:
    """forest_<span> and peat_conversion_<span> beside an emitted table."""
    c = F.col
    forest = [e.forest_part(c(f"class_{a}"), c("peat"), c(f"vegetation_{a}_{b}"), c(f"soil_{a}_{b}")).alias(f"forest_{a}_{b}") for a, b in SPANS]
    peat = [e.peat_conversion_part(c("peat"), c(f"soil_{a}_{b}")).alias(f"peat_conversion_{a}_{b}") for a, b in SPANS]
    return emitted.select("*", *forest, *peat)


def with_source_totals(emitted: DataFrame) -> DataFrame:
    """Discounted forest_per_ha and peat_conversion_per_ha."""
    out = split_sources(emitted)
    return out.select("*", *[e.discounted({(a, b): F.col(f"{s}_{a}_{b}") for a, b in SPANS}).alias(f"{s}_per_ha") for s in ("forest", "peat_conversion")])
