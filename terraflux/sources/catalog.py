"""Registered source tables and their bands."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.factors import STATISTICS_YEARS, YEARS
from terraflux.functions.nulls import clean
from terraflux.functions.tiles import SPAN
from terraflux.operators.resample import CATEGORICAL, EXTENSIVE, INTENSIVE


@dataclass(frozen=True)
class Source:
    """A gridded table (tile_id, row, col, <bands>) with one band type, no-data value and partitioning."""

    name: str
    product: str
    bands: tuple[str, ...]
    band_type: str
    no_data: float | None
    partitioning: str

    def qualified(self, band: str) -> str:
        """Published name of a band."""
        return f"{self.name}:{self.product}:{band}"

    @property
    def only_band(self) -> str:
        if len(self.bands) != 1:
            raise ValueError(f"{self.name} has {len(self.bands)} bands")
        return self.qualified(self.bands[0])

    def path(self, root: str) -> str:
        return f"{root}/{self.name}/{self.product}"


_TEN, _WORLD = "TEN_DEGREE", "WHOLE_WORLD"
# Band type, no-data value and partitioning of each source.
SOURCES = {
    s.name: s
    for s in [
        Source("peatlands", "extent", ("peat",), CATEGORICAL, 255, _TEN),
        Source("aboveground-biomass", "density", ("agb",), INTENSIVE, 65535, _TEN),
        Source("tree-cover-loss", "year", ("loss",), CATEGORICAL, None, _TEN),
        Source("land-cover", "class", tuple(f"lc_{y}" for y in YEARS), CATEGORICAL, 255, _TEN),
        Source("root-biomass", "density", ("bgb",), INTENSIVE, None, _TEN),
        Source("climate-zones", "zone", ("zone",), CATEGORICAL, 255, _WORLD),
        Source("soil-carbon", "stock", ("soc",), INTENSIVE, 32767, _TEN),
        Source("crop-map", "class", ("crop_code",), CATEGORICAL, 0, _TEN),
        *[Source(f"crop-{what}-{y}", unit, (what,), EXTENSIVE, -1 if y in (2000, 2010) else None, _WORLD) for y in STATISTICS_YEARS for what, unit in (("area", "ha"), ("production", "mt"))],
    ]
}


@dataclass(frozen=True)
class Table:
    """A tabular source of the whole world: its columns, and the ones that it is sorted by."""

    name: str
    product: str
    schema: str
    keys: tuple[str, ...]

    def path(self, root: str) -> str:
        return f"{root}/{self.name}/{self.product}"

    def checked(self, df: DataFrame) -> DataFrame:
        """The table's columns in order and of their types; a missing one or a null key is an error."""
        names = [f.split()[0] for f in self.schema.split(", ")]
        if missing := [n for n in names if n not in df.columns]:
            raise ValueError(f"{self.name}: no column {', '.join(missing)}")
        columns = [F.col(n).cast(f.split(maxsplit=1)[1]).alias(n) for n, f in zip(names, self.schema.split(", "), strict=True)]
        whole = F.when(F.greatest(*[F.isnull(k).cast("int") for k in self.keys], F.lit(0)) == 0, True).otherwise(F.raise_error(F.lit(f"{self.name}: null in {', '.join(self.keys)}")))
        return df.select(*columns).filter(whole)


# Tabular sources.
TABLES = {
    t.name: t
    for t in [
        Table("survey-yields", "yield", "admin_id string, crop_name string, year int, yield_kg_per_ha double", ("admin_id", "crop_name", "year")),
        Table("jurisdictions-national", "admin-0", "admin_id string, jurisdiction_name string", ("admin_id",)),
        Table("jurisdictions-provincial", "admin-1", "admin_id string, jurisdiction_name string", ("admin_id",)),
        Table("jurisdictions-district", "admin-2", "admin_id string, jurisdiction_name string", ("admin_id",)),
    ]
}


def scan(spark: SparkSession, root: str, name: str, tile_ids: list[str] | None = None) -> DataFrame:
    """Bands of a source with no data as NULL; tiles prune partitions of the table. No list means all tiles, an empty one none."""
    source = SOURCES[name]
    df = spark.read.parquet(source.path(root))
    if tile_ids is not None:
        df = df.filter(F.col("tile_id").isin(tile_ids))
    return df.select("tile_id", "row", "col", *[clean(F.col(b).cast("double"), source.no_data).cast(df.schema[b].dataType).alias(b) for b in source.bands])


def qualified(df: DataFrame, source: Source) -> DataFrame:
    """Bands under their published names."""
    return df.select(*[c for c in df.columns if c not in source.bands], *[F.col(b).alias(source.qualified(b)) for b in source.bands])


def loss_year(code: Column) -> Column:
    """Year of tree-cover loss from its code; 0 is no loss."""
    return F.when(code > 0, code + 2000).otherwise(0)


def stack_years(per_year: dict[int, DataFrame], band: str) -> DataFrame:
    """One table with a column <band>_<year> from single-year tables (tile_id, row, col, band): one shuffle for all years.

    Rows go to their pixels before they are added up: no two rows of a year meet in a map task, so sums there would hold every row of its
    input. A pixel is one entry with a value a year, the first known one.
    """
    rows = None
    for year, df in per_year.items():
        own = df.select("tile_id", "row", "col", F.lit(year).alias("year"), F.col(band).alias("v"))
        rows = own if rows is None else rows.unionByName(own)
    value = lambda y: F.first(F.when(F.col("year") == y, F.col("v")), ignorenulls=True).alias(f"{band}_{y}")
    return rows.repartition("tile_id", "row", "col").groupBy("tile_id", "row", "col").agg(*map(value, per_year))


def paste(df: DataFrame, row_offset: int, col_offset: int) -> DataFrame:
    """A partial-extent source on the canvas of the whole world; cells it lacks stay absent."""
    return df.withColumn("row", F.col("row") + row_offset).withColumn("col", F.col("col") + col_offset)


def clip_global(df: DataFrame, tile_id: str, step: float, band: str, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """(tile_id, row, col, band): the cells of a global grid inside a tile, both borders included, row 0 in the north.

    ``df``: (lat, lon, band), labels at ``origin`` + k ``step``, latitude rising. Every cell of the tile has a row; unknown
    and absent ones are 0.
    """
    up, right = int(tile_id[:2]) * (1 if tile_id[2] == "N" else -1), int(tile_id[4:7]) * (1 if tile_id[7] == "E" else -1)
    first = lambda low, at: math.ceil((low - at) / step - 1e-9)
    last = lambda high, at: math.floor((high - at) / step + 1e-9)
    south, north = first(up - SPAN, origin[0]), last(up, origin[0])
    west, east = first(right, origin[1]), last(right + SPAN, origin[1])
    width = east - west + 1
    place = F.col("id")
    cells = df.sparkSession.range((north - south + 1) * width).select(F.floor(place / width).cast("int").alias("row"), (place % width).cast("int").alias("col"))
    k = lambda c, at: F.round((F.col(c) - at) / step).cast("int")
    own = df.select((north - k("lat", origin[0])).alias("row"), (k("lon", origin[1]) - west).alias("col"), band)
    own = own.filter(F.col("row").between(0, north - south) & F.col("col").between(0, width - 1))
    return cells.join(own, ["row", "col"], "left").select(F.lit(tile_id).alias("tile_id"), "row", "col", F.coalesce(F.when(~F.isnan(band), F.col(band)), F.lit(0.0)).alias(band))
