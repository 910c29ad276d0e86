"""Resampling between pixel grids as joins and aggregates; no task needs a whole tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraflux.functions import tiles

CATEGORICAL, INTENSIVE, EXTENSIVE = "CATEGORICAL", "INTENSIVE", "EXTENSIVE"


def kernel(band_type: str, dest: tuple[int, int], src: tuple[int, int]) -> str:
    """Equal sizes: nearest; source finer on both axes: mode or average; otherwise nearest or bilinear. Extensive bands are copied only."""
    if src == dest:
        return "nearest"
    down = src[0] > dest[0] and src[1] > dest[1]
    if band_type == EXTENSIVE:
        raise NotImplementedError("sum resampling of extensive bands" if down else "distribution resampling of extensive bands")
    if band_type not in (CATEGORICAL, INTENSIVE):
        raise ValueError(band_type)
    return {(CATEGORICAL, True): "mode", (INTENSIVE, True): "average", (CATEGORICAL, False): "nearest", (INTENSIVE, False): "bilinear"}[band_type, down]


def kernel_of(band_type: Column, dest_x: Column, dest_y: Column, src_x: Column, src_y: Column) -> Column:
    """``kernel`` of tables of bands; where that is an error, a text that begins with ``refused``."""
    same, down = (src_x == dest_x) & (src_y == dest_y), (src_x > dest_x) & (src_y > dest_y)
    extensive = F.when(down, "refused: sum resampling").otherwise("refused: distribution resampling")
    chosen = F.when(same, "nearest").when(band_type == EXTENSIVE, extensive)
    chosen = chosen.when(band_type == CATEGORICAL, F.when(down, "mode").otherwise("nearest")).when(band_type == INTENSIVE, F.when(down, "average").otherwise("bilinear"))
    return chosen.otherwise("refused: band type")


def band_type_of(name: Column) -> Column:
    """Band type from a variable's name."""
    return F.when(name.contains("-per-ha"), INTENSIVE).when(name.endswith(":ha") | name.endswith(":tco2e"), EXTENSIVE).otherwise(CATEGORICAL)


def nearest(source: DataFrame, dest: DataFrame, s: int, n: int, bands: list[str]) -> DataFrame:
    """Value at each (tile_id, row, col) of ``dest`` (``n`` a side) of the source pixel (``s`` a side) around its centre; gaps are NULL."""
    at = lambda c: F.floor((F.col(c) + 0.5) * s / n).cast("int")
    own = dest.select("tile_id", "row", "col", at("row").alias("_r"), at("col").alias("_c"))
    src = source.select("tile_id", F.col("row").alias("_r"), F.col("col").alias("_c"), *bands)
    return own.join(src, ["tile_id", "_r", "_c"], "left").select("tile_id", "row", "col", *bands)


def from_world(world: DataFrame, pixels: DataFrame, n: int, width: int, height: int, bands: list[str]) -> DataFrame:
    """Nearest value of a whole-world layer (row, col, bands; ``width`` x ``height``) at the centre of each pixel; gaps are NULL.

    An equi-join on indices of the layer; a layer that is small is broadcast by the optimiser.
    """
    lat, lon = tiles.pixel_lat(F.col("tile_id"), F.col("row"), n), tiles.pixel_lon(F.col("tile_id"), F.col("col"), n)
    own = pixels.select("tile_id", "row", "col", F.floor((90 - lat) * height / 180).cast("int").alias("_r"), F.floor((lon + 180) * width / 360).cast("int").alias("_c"))
    layer = world.select(F.col("row").alias("_r"), F.col("col").alias("_c"), *bands)
    return own.join(layer, ["_r", "_c"], "left").select("tile_id", "row", "col", *bands)


def overlaps(index: Column, n: int, m: int) -> Column:
    """Array of (k, w): coarse indices (``m`` a side) that a fine index (``n`` a side) meets, with integer overlaps of 1 / (n m)."""
    q = index.cast("long")
    first, last = F.floor(q * m / n), F.floor(((q + 1) * m - 1) / n)
    weight = lambda k: F.least((q + 1) * m, (k + 1) * n) - F.greatest(q * m, k * n)
    return F.transform(F.sequence(first, last), lambda k: F.struct(k.cast("int").alias("k"), weight(k).cast("double").alias("w")))


def _met(source: DataFrame, n: int, m: int) -> DataFrame:
    """``source`` with the first and last coarse row and column of each pixel (r0, r1, c0, c1)."""
    q = lambda c: F.col(c).cast("long")
    first, last = lambda c: F.floor(q(c) * m / n).cast("int"), lambda c: F.floor(((q(c) + 1) * m - 1) / n).cast("int")
    return source.withColumns({"r0": first("row"), "r1": last("row"), "c0": first("col"), "c1": last("col")})


def _shares(first: str, last: str, n: int, m: int) -> Column:
    """Array of (k, w): the coarse indices that pixels between these meet, with the integer overlap of each.

    Between two neighbouring indices lies one fine index only, so its overlaps follow from them. NULL for pixels without a place.
    """
    a, b = F.col(first).cast("long"), F.col(last).cast("long")
    q = F.floor((a + 1) * n / m)
    cell = lambda k, w: F.struct(k.cast("int").alias("k"), w.cast("double").alias("w"))
    return F.when(a == b, F.array(cell(a, F.lit(m)))).when(a < b, F.array(cell(a, (a + 1) * n - q * m), cell(b, (q + 1) * m - b * n)))


def _on_grid(rows: DataFrame, row: str, col: str, last: int | None) -> DataFrame:
    """Rows whose coarse indices are at most ``last``; all rows where it is None."""
    return rows if last is None else rows.filter((F.col(row) <= last) & (F.col(col) <= last))


def _spread(sums: DataFrame, n: int, m: int) -> DataFrame:
    """Rows by (r0, r1, c0, c1) as rows of the coarse cells (crow, ccol) that they contribute to, with the weight w of a pixel."""
    rest = [c for c in sums.columns if c not in ("r0", "r1", "c0", "c1")]
    out = sums.select(*rest, "c0", "c1", F.explode(_shares("r0", "r1", n, m)).alias("r")).select(*rest, "r", F.explode(_shares("c0", "c1", n, m)).alias("c"))
    return out.select(*rest, F.col("r.k").alias("crow"), F.col("c.k").alias("ccol"), (F.col("r.w") * F.col("c.w")).alias("w"))


def _finer(n: int, m: int) -> None:
    if n < m:
        raise ValueError(f"{n} pixels are not finer than {m} cells")


def average(source: DataFrame, n: int, m: int, bands: list[str], last: int | None = None) -> DataFrame:
    """Overlap-weighted mean of the known values in each coarse cell; one pass over the pixels with map-side partial sums, tiny output.

    Pixels that meet the same cells weigh alike, so they are added up before the cells are told apart: no pixel is exploded.
    ``last``: the grid's last coarse row and column, where the source has rows beyond it; the cells of a tile end at m - 1.
    """
    _finer(n, m)
    met = _on_grid(_met(source, n, m), "r0", "c0", last)
    sums = met.groupBy("tile_id", "r0", "r1", "c0", "c1").agg(*[x for b in bands for x in (F.sum(b).alias(f"{b}_s"), F.count(b).alias(f"{b}_n"))])
    rows = _on_grid(_spread(sums, n, m), "crow", "ccol", last).groupBy("tile_id", "crow", "ccol")
    both = rows.agg(*[x for b in bands for x in (F.sum(F.col(f"{b}_s") * F.col("w")).alias(f"{b}_s"), F.sum(F.col(f"{b}_n") * F.col("w")).alias(f"{b}_w"))])
    return both.select("tile_id", "crow", "ccol", *[F.when(F.col(f"{b}_w") > 0, F.col(f"{b}_s") / F.col(f"{b}_w")).alias(b) for b in bands])


def mode(source: DataFrame, n: int, m: int, band: str) -> DataFrame:
    """The value with most area in each coarse cell, ties to the smaller; NULL only where all is unknown. One pass over the pixels."""
    _finer(n, m)
    counts = _met(source, n, m).groupBy("tile_id", "r0", "r1", "c0", "c1", band).agg(F.count("*").alias("pixels"))
    rows = _spread(counts, n, m).groupBy("tile_id", "crow", "ccol", band).agg(F.sum(F.col("w") * F.col("pixels")).alias("w"))
    known = F.when(F.col(band).isNotNull(), F.struct(F.col("w"), (-F.col(band)).alias("v")))
    return rows.groupBy("tile_id", "crow", "ccol").agg((-F.max(known)["v"]).alias(band))


def corners(source: DataFrame, keys: list[str], band: str) -> DataFrame:
    """(keys, row, col, v00, v01, v10, v11): each source cell with its neighbours to the east, south and south-east.

    Made on the source, which is the smaller side of an interpolation: four rows a source cell, combined map-side.
    """
    step = lambda c, d: (F.col(c) - F.col(d)).cast("int").alias(c)
    known = source.filter(F.col(band).isNotNull())
    each = known.select(*keys, "row", "col", band, F.explode(F.array(F.lit(0), F.lit(1))).alias("dr")).withColumn("dc", F.explode(F.array(F.lit(0), F.lit(1))))
    value = lambda dr, dc: F.max(F.when((F.col("dr") == dr) & (F.col("dc") == dc), F.col(band))).alias(f"v{dr}{dc}")
    placed = each.select(*keys, step("row", "dr"), step("col", "dc"), "dr", "dc", band)
    return placed.groupBy(*keys, "row", "col").agg(value(0, 0), value(0, 1), value(1, 0), value(1, 1))


def _between(x: Column, first: Column | int, last: Column | int) -> tuple[Column, Column]:
    """Cell at or before a place, and how far it is from there to the next cell; neighbours stop at ``first`` and ``last``."""
    low = F.floor(x)
    inside = (low >= first) & (low < last)
    base = F.greatest(F.lit(first), F.least(low, F.lit(last))).cast("int")
    return base, F.when(inside, x - low).otherwise(0.0)


def _interpolated(near: DataFrame, quads: DataFrame, keys: list[str], band: str) -> DataFrame:
    """``near`` (tile_id, row, col, _r, _c, _fr, _fc) with the weighted mean of the known corners of its cell; one join."""
    own = quads.withColumnsRenamed({"row": "_r", "col": "_c"})
    met = near.join(own, [*keys, "_r", "_c"], "left")
    c = F.col
    weights = {"v00": (1 - c("_fr")) * (1 - c("_fc")), "v01": (1 - c("_fr")) * c("_fc"), "v10": c("_fr") * (1 - c("_fc")), "v11": c("_fr") * c("_fc")}
    zero = F.lit(0.0)
    total = sum((F.when(c(v).isNotNull(), c(v) * w).otherwise(zero) for v, w in weights.items()), zero)
    weight = sum((F.when(c(v).isNotNull(), w).otherwise(zero) for v, w in weights.items()), zero)
    return met.select("tile_id", "row", "col", F.when(weight > 0, total / weight).alias(band))


def bilinear(source: DataFrame, dest: DataFrame, s: int, n: int, band: str) -> DataFrame:
    """Weighted mean of the four source centres around each pixel's centre over the known ones; neighbours stop at the tile's edge."""
    at = lambda c: _between((F.col(c) + 0.5) * s / n - 0.5, 0, s - 1)
    (r, fr), (k, fk) = at("row"), at("col")
    near = dest.select("tile_id", "row", "col", r.alias("_r"), k.alias("_c"), fr.alias("_fr"), fk.alias("_fc"))
    return _interpolated(near, corners(source, ["tile_id"], band), ["tile_id"], band)


def world_in_tiles(world: DataFrame, tile_ids: list[str], width: int, height: int, bands: list[str]) -> tuple[DataFrame, int]:
    """A whole-world layer (row, col, bands) clipped to tiles, as their rows (tile_id, row, col, bands), and its cells a tile side."""
    s = width * tiles.SPAN // 360
    if s * 360 != width * tiles.SPAN or s * 180 != height * tiles.SPAN:
        raise ValueError(f"a layer of {width} x {height} does not divide into tiles")
    lat, lon = 90 - F.floor(F.col("row") / s) * tiles.SPAN, F.floor(F.col("col") / s) * tiles.SPAN - 180
    own = world.withColumn("tile_id", tiles.tile_of(lat.cast("int"), lon.cast("int"))).filter(F.col("tile_id").isin(tile_ids))
    return own.select("tile_id", (F.col("row") % s).cast("int").alias("row"), (F.col("col") % s).cast("int").alias("col"), *bands), s


def world_to_grid(world: DataFrame, pixels: DataFrame, tile_ids: list[str], n: int, width: int, height: int, band: str, band_type: str) -> DataFrame:
    """(tile_id, row, col, band) of a whole-world layer on a grid of ``tile_ids``, ``n`` pixels a tile side.

    The layer is clipped to the grid first; the kernel follows from the band's type and from the sizes after clipping.
    Nearest and bilinear give a row for each of ``pixels``; neighbours stop at the edge of the grid, not of a tile. Mode and average
    give the grid's pixels that have source cells, and need no ``pixels``.
    """
    source, s = world_in_tiles(world, tile_ids, width, height, [band])
    chosen = kernel(band_type, (n, n), (s, s))
    if chosen == "nearest":
        return nearest(source, pixels, s, n, [band])
    if chosen in ("mode", "average"):
        coarse = mode(source, s, n, band) if chosen == "mode" else average(source, s, n, [band])
        return coarse.withColumnsRenamed({"crow": "row", "ccol": "col"})
    corner = [((90 - int(t[:2]) * (1 if t[2] == "N" else -1)) // tiles.SPAN, (180 + int(t[4:7]) * (1 if t[7] == "E" else -1)) // tiles.SPAN) for t in tile_ids]
    rows, cols = zip(*corner, strict=True)
    up, left = (90 - tiles.lat_of(F.col("tile_id"))) / tiles.SPAN, (180 + tiles.lon_of(F.col("tile_id"))) / tiles.SPAN
    world_index = lambda tile, c, size: (tile * size + F.col(c)).cast("int")
    (r, fr), (k, fk) = (
        _between((tile * n + F.col(c) + 0.5) * s / n - 0.5, min(of) * s, (max(of) + 1) * s - 1) for tile, c, of in ((up, "row", rows), (left, "col", cols))
    )
    near = pixels.select("tile_id", "row", "col", r.alias("_r"), k.alias("_c"), fr.alias("_fr"), fk.alias("_fc"))
    clipped = source.select(world_index(up, "row", s).alias("row"), world_index(left, "col", s).alias("col"), band)
    return _interpolated(near, corners(clipped, [], band), [], band)


def projected_map(crop_map: DataFrame, pixels: DataFrame, n: int, west: float, north: float, cell: float, band: str) -> DataFrame:
    """Value of a projected map (row, col, band; square cells of ``cell`` metres from its north-west corner) at each pixel's centre.

    Nearest, anchored at the tile's corner: pixels where the map ends are NULL, partial tiles are not stretched. One equi-join.
    """
    x, y = albers(tiles.pixel_lon(F.col("tile_id"), F.col("col"), n), tiles.pixel_lat(F.col("tile_id"), F.col("row"), n))
    own = pixels.select("tile_id", "row", "col", F.floor((north - y) / cell).cast("int").alias("_r"), F.floor((x - west) / cell).cast("int").alias("_c"))
    layer = crop_map.select(F.col("row").alias("_r"), F.col("col").alias("_c"), band)
    return own.join(layer, ["_r", "_c"], "left").select("tile_id", "row", "col", band)


def albers(lon: Column, lat: Column, lon0: float = -96.0, lat0: float = 23.0, lat1: float = 29.5, lat2: float = 45.5, a: float = 6378137.0, f: float = 1 / 298.257222101) -> tuple[Column, Column]:
    """Forward equal-area conic projection on an ellipsoid, in metres: where a lat/lon pixel falls on a projected crop map."""
    import math

    ecc2 = f * (2 - f)
    ecc = math.sqrt(ecc2)

    def q_of(s):  # of a sine, Python or Column
        log = F.log if isinstance(s, Column) else math.log
        return (1 - ecc2) * (s / (1 - ecc2 * s * s) - log((1 - ecc * s) / (1 + ecc * s)) / (2 * ecc))

    m_of = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - ecc2 * math.sin(math.radians(d)) ** 2)
    q0, q1, q2 = (q_of(math.sin(math.radians(d))) for d in (lat0, lat1, lat2))
    n = (m_of(lat1) ** 2 - m_of(lat2) ** 2) / (q2 - q1)
    c = m_of(lat1) ** 2 + n * q1
    rho0 = a * math.sqrt(c - n * q0) / n
    rho = a * F.sqrt(c - n * q_of(F.sin(F.radians(lat)))) / n
    theta = n * F.radians(lon - lon0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)
