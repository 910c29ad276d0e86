"""Tiles, grids and the countries of continents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraflux.functions import tiles


def parse(tile_ids: DataFrame) -> DataFrame:
    """lat, lon and box of each tile beside it, and the name formatted back from them."""
    lat, lon = tiles.lat_of(F.col("tile_id")), tiles.lon_of(F.col("tile_id"))
    out = tile_ids.select("*", lat.alias("lat"), lon.alias("lon"))
    box = [F.col("lon").alias("west"), (F.col("lon") + tiles.SPAN).alias("east"), (F.col("lat") - tiles.SPAN).alias("south"), F.col("lat").alias("north")]
    return out.select("*", *box, tiles.tile_of(F.col("lat"), F.col("lon")).alias("formatted"))


def validity(tile_ids: DataFrame) -> DataFrame:
    return tile_ids.select("tile_id", *[tiles.is_valid(F.col("tile_id"), p).alias(f"is_{p.lower()}") for p in tiles.PATTERNS])


def grid_of(tile_ids: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """Origin, tiles and pixels of the grid that covers the tiles, per ``keys``; ``n`` pixels a tile side."""
    lat, lon = tiles.lat_of(F.col("tile_id")), tiles.lon_of(F.col("tile_id"))
    own = tile_ids.select(*(keys or []), lat.alias("lat"), lon.alias("lon"))
    out = own.groupBy(*(keys or [])).agg(F.min("lon").alias("x0"), F.max("lat").alias("y0"), F.max("lon").alias("x1"), F.min("lat").alias("y1"))
    across = lambda low, high: (F.floor((F.col(high) - F.col(low)) / tiles.SPAN) + 1).cast("int")
    out = out.select(*(keys or []), "x0", "y0", across("x0", "x1").alias("tiles_x"), across("y1", "y0").alias("tiles_y"))
    return out.select("*", (F.col("tiles_x") * n).alias("width"), (F.col("tiles_y") * n).alias("height"), F.lit(tiles.SPAN / n).alias("pixel"))


def _validated(x: Column, what: str) -> Column:
    return F.when(x < 0, F.raise_error(F.lit(f"negative {what}"))).otherwise(x)


def tile_offsets(tile_ids: DataFrame, grid: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """Pixel offset of each tile in the grid of its ``keys``; a negative one is an error."""
    lat, lon = tiles.lat_of(F.col("tile_id")), tiles.lon_of(F.col("tile_id"))
    out = tile_ids.join(grid.select(*keys, "x0", "y0"), keys)
    x, y = F.floor((lon - F.col("x0")) / tiles.SPAN) * n, F.floor((F.col("y0") - lat) / tiles.SPAN) * n
    return out.select(*tile_ids.columns, _validated(x, "offset").alias("offset_x"), _validated(y, "offset").alias("offset_y"))


def world_window(grid: DataFrame, width: int, height: int, span_x: int = 360, span_y: int = 180) -> DataFrame:
    """Offset and size of the grid inside a whole-world source of ``width`` x ``height`` pixels."""
    x = (F.col("x0") + span_x // 2) * (width // span_x)
    y = (span_y // 2 - F.col("y0")) * (height // span_y)
    size = [(F.col("tiles_x") * (width * 10 // span_x)).alias("window_w"), (F.col("tiles_y") * (height * 10 // span_y)).alias("window_h")]
    return grid.select("*", _validated(x, "offset").alias("window_x"), _validated(y, "offset").alias("window_y"), *size)


def clusters(countries: DataFrame, tile_ids: DataFrame) -> DataFrame:
    """Countries (iso, continent) by continent with the continent's tiles (continent, tile_id), both as sorted lists."""
    isos = countries.groupBy("continent").agg(F.array_sort(F.collect_set("iso")).alias("isos"))
    own = tile_ids.groupBy("continent").agg(F.array_sort(F.collect_set("tile_id")).alias("tiles"))
    return isos.join(own, "continent", "left").select("continent", "isos", F.coalesce("tiles", F.array().cast("array<string>")).alias("tiles"))


def per_continent(countries: DataFrame, tile_ids: DataFrame) -> DataFrame:
    c = clusters(countries, tile_ids)
    return c.select("continent", F.size("isos").alias("n_countries"), F.size("tiles").alias("n_tiles"))


def classified(countries: DataFrame) -> DataFrame:
    """Countries that belong to a continent: all of them run in one job."""
    return countries.filter("continent <> 'UNCLASSIFIED'")


def backfill(countries: DataFrame, factors: DataFrame) -> DataFrame:
    """(iso, continent, n_rows, failed) of every classified country after one job over all: those without factor rows have failed."""
    done = factors.groupBy(F.substring("admin_id", 1, 3).alias("iso")).agg(F.count("*").alias("n_rows"))
    own = classified(countries).join(done, "iso", "left")
    return own.select("iso", "continent", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.col("n_rows").isNull().alias("failed"))


def coverage(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Each tile of two sets with where it is: both, missing (wanted only) or extra (found only)."""
    a, b = found.select("tile_id").distinct(), wanted.select("tile_id").distinct()
    rows = [(a.intersect(b), "both"), (b.subtract(a), "missing"), (a.subtract(b), "extra")]
    parts = [df.select("tile_id", F.lit(name).alias("status")) for df, name in rows]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
