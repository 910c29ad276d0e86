"""Point in polygon by scanlines: an equi-join on pixel rows with a range on columns or on blocks of pixels, never pixels times polygons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terraflux.functions import tiles


def edges_of(zones: DataFrame) -> DataFrame:
    """(zone_id, part, x1, y1, x2, y2) from rings (zone_id, part, ring array<struct<x,y>>); rings close themselves."""
    n = F.size("ring")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get("ring", i).alias("a"), F.get("ring", (i + 1) % n).alias("b")))
    out = zones.filter(n > 0).select("zone_id", "part", F.explode(pairs).alias("e"))
    return out.select("zone_id", "part", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def dissolve(shapes: DataFrame) -> DataFrame:
    """One row per id from shapes (id_parts array, name_parts array, rings): ids and names joined from parts, rings together."""
    named = shapes.select(F.array_join("id_parts", "").alias("id"), F.array_join("name_parts", " | ").alias("name"), "rings")
    return named.groupBy("id").agg(F.min("name").alias("name"), F.flatten(F.collect_list("rings")).alias("rings"))


def jurisdictions(zones: DataFrame, level: str, iso: str) -> DataFrame:
    """Jurisdictions (admin_id, admin_level, ...) of a country at a level, sorted by id."""
    return zones.filter((F.col("admin_level") == level) & F.col("admin_id").startswith(iso)).orderBy("admin_id")


def spans(edges: DataFrame, n: int) -> DataFrame:
    """(zone_id, part, tile_id, row, col_first, col_last): runs of pixels whose centres are inside, ``n`` pixels a tile side.

    An edge crosses the pixel rows whose centre latitude lies in [low, high), half open, so that a corner
    counts once; crossings of a row are paired by longitude (even-odd, so holes fall out), per part.
    Work is edges times rows. Rows are counted from 90 N and columns from 180 W over the whole world,
    then named by tile. Centres are compared as ``tiles`` computes them from a tile's corner, so that an edge through a centre
    has it on the same side as in a test of each pixel.
    """
    d = tiles.SPAN / n
    top, low, high = 90.0, F.least("y1", "y2"), F.greatest("y1", "y2")
    # rows whose centre is near [low, high), then those of which it is in there as computed
    first = F.floor((top - high) / d - 0.5)
    last = F.floor((top - low) / d - 0.5) + 1
    cross = edges.filter("y1 <> y2").withColumn("g", F.explode(F.sequence(first, last)))
    y = tiles.row_lat(90 - F.floor(F.col("g") / n) * tiles.SPAN, F.pmod("g", F.lit(n)), n)
    cross = cross.filter((low <= y) & (y < high))
    x = F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    own = Window.partitionBy("zone_id", "part", "g").orderBy("x")
    cross = cross.select("zone_id", "part", "g", x.alias("x"))
    cross = cross.select("*", F.row_number().over(own).alias("k"), F.lead("x").over(own).alias("x_out")).filter("k % 2 = 1 AND x_out IS NOT NULL")

    def col_at(c: str) -> Column:
        """First global column whose centre is at ``c`` or east of it: one of three beside the quotient, which is rounded."""
        near = F.ceil((F.col(c) + 180) / d - 0.5)
        centre = lambda h: F.floor(h / n) * tiles.SPAN - 180 + (F.pmod(h, F.lit(n)) + 0.5) * d
        return F.when(centre(near - 1) >= F.col(c), near - 1).when(centre(near) >= F.col(c), near).otherwise(near + 1)

    runs = cross.select("zone_id", "part", "g", col_at("x").alias("h0"), (col_at("x_out") - 1).alias("h1")).filter("h0 <= h1")
    # cut at tile borders
    runs = runs.withColumn("t", F.explode(F.sequence(F.floor(F.col("h0") / n), F.floor(F.col("h1") / n))))
    lat, lon = 90 - F.floor(F.col("g") / n) * tiles.SPAN, -180 + F.col("t") * tiles.SPAN
    return runs.select(
        "zone_id", "part", tiles.tile_of(lat.cast("int"), lon.cast("int")).alias("tile_id"), (F.col("g") % n).cast("int").alias("row"),
        F.greatest(F.col("h0") - F.col("t") * n, F.lit(0)).cast("int").alias("col_first"), F.least(F.col("h1") - F.col("t") * n, F.lit(n - 1)).cast("int").alias("col_last"),
    )


def united(spans_: DataFrame) -> DataFrame:
    """(zone_id, tile_id, row, col_first, col_last): runs of all parts of a zone, overlapping and touching ones as one."""
    line = Window.partitionBy("zone_id", "tile_id", "row").orderBy("col_first", "col_last")
    before = F.max("col_last").over(line.rowsBetween(Window.unboundedPreceding, -1))
    own = spans_.select("zone_id", "tile_id", "row", "col_first", "col_last", before.alias("before"))
    own = own.withColumn("island", F.count_if(F.col("before").isNull() | (F.col("col_first") > F.col("before") + 1)).over(line))
    return own.groupBy("zone_id", "tile_id", "row", "island").agg(F.min("col_first").alias("col_first"), F.max("col_last").alias("col_last")).drop("island")


def pixels_in_zones(pixels: DataFrame, spans_: DataFrame) -> DataFrame:
    """Pixels beside each zone_id that their centre is in, once per zone however many parts overlap there: parts are united as runs, before pixels are met."""
    inside = (F.col("col") >= F.col("col_first")) & (F.col("col") <= F.col("col_last"))
    return pixels.join(united(spans_), ["tile_id", "row"]).filter(inside).drop("col_first", "col_last")


def block_of(row: Column, col: Column, block: int) -> Column:
    """Number of a pixel's block in its tile, ``block`` pixels a side."""
    return F.floor(row / block) * 100_000 + F.floor(col / block)


def cover(edges: DataFrame, n: int, block: int) -> DataFrame:
    """(zone_id, tile_id, block_id, whole, runs): the blocks of ``block`` pixels a side that hold centres of a zone, ``n`` pixels a tile side.

    ``whole`` blocks are inside with all their pixels and have no runs; the others have an array with, for each row of the block, its
    runs (first, last) of columns. A row per block: pixels meet it on (tile_id, block_id), and only those of a zone's border look at runs.
    """
    runs = united(spans(edges, n))
    runs = runs.withColumn("b", F.explode(F.sequence(F.floor(F.col("col_first") / block), F.floor(F.col("col_last") / block))))
    first, last = F.greatest("col_first", F.col("b") * block).cast("int"), F.least("col_last", F.col("b") * block + block - 1).cast("int")
    runs = runs.select("zone_id", "tile_id", F.floor(F.col("row") / block).alias("a"), "b", (F.col("row") % block).alias("line"), first.alias("first"), last.alias("last"))
    side = lambda c: F.least(F.lit(block), n - F.col(c) * block)
    lines = runs.groupBy("zone_id", "tile_id", "a", "b", "line").agg(F.collect_list(F.struct("first", "last")).alias("own"), F.sum(F.col("last") - F.col("first") + 1).alias("inside"))
    blocks = lines.groupBy("zone_id", "tile_id", "a", "b").agg(F.sum("inside").alias("inside"), F.map_from_entries(F.collect_list(F.struct("line", "own"))).alias("by_line"))
    whole = F.col("inside") == side("a") * side("b")
    rows = F.transform(F.sequence(F.lit(0), F.lit(block - 1)), lambda i: F.try_element_at("by_line", i))
    return blocks.select("zone_id", "tile_id", (F.col("a") * 100_000 + F.col("b")).alias("block_id"), whole.alias("whole"), F.when(~whole, rows).alias("runs"), F.col("inside").cast("long").alias("inside"))


def quadtree(cover_: DataFrame, side: int) -> DataFrame:
    """(zone_id, tile_id, level, a, b): the whole blocks of a cover as the largest aligned squares of 2**level blocks a side, ``side`` blocks to a tile.

    What a cover of a large zone takes to store grows with its border, not its area. Each level looks at what the one below has left of whole
    blocks: four squares of one parent become the parent.
    """
    nodes = cover_.filter("whole").select("zone_id", "tile_id", F.floor(F.col("block_id") / 100_000).cast("int").alias("a"), (F.col("block_id") % 100_000).cast("int").alias("b"))
    out = None
    for level in range(max(side, 1).bit_length()):
        half = {c: F.shiftright(c, 1) for c in "ab"}
        family = Window.partitionBy("zone_id", "tile_id", half["a"], half["b"])
        nodes = nodes.withColumn("siblings", F.count(F.lit(1)).over(family))
        stays = nodes.filter("siblings < 4").select("zone_id", "tile_id", F.lit(level).alias("level"), "a", "b")
        out = stays if out is None else out.unionAll(stays)
        nodes = nodes.filter("siblings = 4").select("zone_id", "tile_id", half["a"].alias("a"), half["b"].alias("b")).distinct()
    return out


def blocks_of(nodes: DataFrame) -> DataFrame:
    """(zone_id, tile_id, block_id): the blocks of quadtree nodes."""
    along = lambda c: F.explode(F.sequence(F.col(c) * F.col("width"), F.col(c) * F.col("width") + F.col("width") - 1))
    wide = nodes.withColumn("width", F.pow(F.lit(2), F.col("level")).cast("int"))
    blocks = wide.select("zone_id", "tile_id", "width", "b", along("a").alias("r")).select("zone_id", "tile_id", "r", along("b").alias("c"))
    return blocks.select("zone_id", "tile_id", (F.col("r") * 100_000 + F.col("c")).cast("long").alias("block_id"))


def write_cover(cover_: DataFrame, path: str, side: int) -> None:
    """A cover as two tables: the quadtree of its whole blocks, and its border blocks with their runs."""
    quadtree(cover_, side).write.mode("overwrite").parquet(f"{path}/whole")
    cover_.filter("NOT whole").drop("whole").write.mode("overwrite").parquet(f"{path}/border")


def read_cover(spark: SparkSession, path: str, zone_ids: Column | None = None) -> DataFrame:
    """A stored cover, by block; ``zone_ids``: a condition on zone_id, as of one country, that is met as the tables are read."""
    whole, border = spark.read.parquet(f"{path}/whole"), spark.read.parquet(f"{path}/border")
    if zone_ids is not None:
        whole, border = whole.filter(zone_ids), border.filter(zone_ids)
    rows = blocks_of(whole).withColumns({"whole": F.lit(True), "runs": F.lit(None).cast(border.schema["runs"].dataType)})
    return rows.unionByName(border.withColumn("whole", F.lit(False)).select(*rows.columns))


#: Largest cover, in bytes, that is sent to all tasks.
COVER_BYTES = 64 << 20


def pixels_in_cover(pixels: DataFrame, cover_: DataFrame, block: int, most: int = COVER_BYTES) -> DataFrame:
    """Pixels (tile_id, row, col, block_id, ...) beside each zone_id of a cover that their centre is in.

    One equi-join on tile and block; nothing after it moves pixels. ``pixels`` is best a table partitioned by tile_id: then only the tiles of
    the cover are read. The cover, best a stored table, is measured first. Up to ``most`` bytes it is sent to the pixels, which
    stay where they are, and prunes their partitions as they are read (dynamic partition pruning). A larger one is joined by a
    shuffle, and its tiles, 648 at most, are a filter of the scan.
    """
    own = cover_.select("zone_id", "tile_id", "block_id", "whole", "runs")
    size = F.lit(64) + F.coalesce(F.aggregate("runs", F.lit(0), lambda total, line: total + 8 + 16 * F.coalesce(F.size(line), F.lit(0))), F.lit(0))
    if own.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= most:
        own = F.broadcast(own)
    else:
        pixels = pixels.filter(F.col("tile_id").isin([r["tile_id"] for r in own.select("tile_id").distinct().collect()]))
    at = F.get("runs", F.col("row") % block)
    inside = F.col("whole") | F.exists(F.coalesce(at, F.array().cast("array<struct<first:int,last:int>>")), lambda r: F.col("col").between(r["first"], r["last"]))
    return pixels.join(own, ["tile_id", "block_id"]).filter(inside).drop("whole", "runs")


def tiles_touching(edges: DataFrame) -> DataFrame:
    """(zone_id, tile_id): 10-degree tiles that a zone's shape touches, borders included.

    Two ways to touch, each with work by edge, not by tiles times edges: an edge meets the tile's box, for
    the tiles of that edge's own bounding box; or the tile's centre is inside the shape, for runs of centres between the
    crossings of each line of centres (even-odd).
    """
    first, last = lambda x: F.floor(x / 10), lambda x: F.ceil(x / 10) - 1
    # a border belongs to the tiles on both sides, but not beyond the box of the whole shape
    own = Window.partitionBy("zone_id")
    box = edges.select("*", F.min(F.least("x1", "x2")).over(own).alias("w"), F.max(F.greatest("x1", "x2")).over(own).alias("e"), F.min(F.least("y1", "y2")).over(own).alias("s"), F.max(F.greatest("y1", "y2")).over(own).alias("n"))

    def steps(a: str, b: str, low: str, high: str) -> Column:
        begin, end = F.greatest(first(F.least(a, b)) - 1, first(F.col(low))), F.least(first(F.greatest(a, b)), last(F.col(high)))
        return F.explode(F.when(begin <= end, F.sequence(begin, end)))

    near = box.withColumn("lat", steps("y1", "y2", "s", "n")).withColumn("lon", steps("x1", "x2", "w", "e"))
    near = near.withColumn("lat", F.col("lat") * 10).withColumn("lon", F.col("lon") * 10)
    border = near.filter(_edge_meets_box()).select("zone_id", "lat", "lon")
    # lines of centres, off any corner on a round latitude
    y = F.col("k") * 10 + 5.0 + 1e-7
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = edges.filter("y1 <> y2").withColumn("k", F.explode(F.sequence(F.ceil((low - 5.0 - 1e-7) / 10), F.floor((high - 5.0 - 1e-7) / 10) + 1))).filter((low <= y) & (y < high))
    x = F.col("x1") + (y - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    line = Window.partitionBy("zone_id", "part", "k").orderBy("x")
    runs = lines.select("zone_id", "part", "k", x.alias("x"))
    runs = runs.select("*", F.row_number().over(line).alias("i"), F.lead("x").over(line).alias("x_out")).filter("i % 2 = 1 AND x_out IS NOT NULL")
    # centres in [x, x_out)
    ends = runs.select("zone_id", "k", F.ceil((F.col("x") - 5.0) / 10).alias("t0"), (F.ceil((F.col("x_out") - 5.0) / 10) - 1).alias("t1")).filter("t0 <= t1")
    inside = ends.select("zone_id", (F.col("k") * 10).alias("lat"), F.explode(F.sequence("t0", "t1")).alias("t")).select("zone_id", "lat", (F.col("t") * 10).alias("lon"))
    out = border.unionByName(inside).distinct()
    return out.select("zone_id", tiles.tile_of((F.col("lat") + 10).cast("int"), F.col("lon").cast("int")).alias("tile_id"))


def _edge_meets_box() -> Column:
    """Whether the segment (x1, y1)-(x2, y2) meets the closed box of 10 degrees north-east of (lon, lat), by clipping its parameter range."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def enter_leave(p: Column, d: Column, low: Column) -> tuple[Column, Column]:
        high = low + 10
        a, b = (low - p) / F.when(d != 0, d), (high - p) / F.when(d != 0, d)
        inside = p.between(low, high)
        enter = F.when(d != 0, F.least(a, b)).when(inside, F.lit(0.0)).otherwise(F.lit(2.0))
        leave = F.when(d != 0, F.greatest(a, b)).when(inside, F.lit(1.0)).otherwise(F.lit(-1.0))
        return enter, leave

    ex, lx = enter_leave(F.col("x1"), dx, F.col("lon").cast("double"))
    ey, ly = enter_leave(F.col("y1"), dy, F.col("lat").cast("double"))
    return F.greatest(ex, ey, F.lit(0.0)) <= F.least(lx, ly, F.lit(1.0))
