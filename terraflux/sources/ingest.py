"""Ingest decisions as joins: what is missing, what is invalid, what is refused; survey yields; exact merges."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux import factors as k
from terraflux.functions import tiles
from terraflux.operators.zones import block_of
from terraflux.sources.catalog import Source


def to_ingest(wanted: DataFrame, manifest: DataFrame, overwrite: bool = False) -> DataFrame:
    """Rows (dataset, tile_id) that the manifest lacks, or all."""
    return wanted if overwrite else wanted.join(manifest, ["dataset", "tile_id"], "left_anti")


def sort_out(wanted: DataFrame, partitionings: dict[str, str]) -> DataFrame:
    """Rows (dataset, tile_id) with the reason why they are refused, NULL if they are not; whole-world datasets collapse to the tile ``world``."""
    kind = F.create_map(*[F.lit(x) for pair in partitionings.items() for x in pair])
    own = wanted.withColumn("partitioning", F.try_element_at(kind, F.col("dataset")))
    own = own.withColumn("tile_id", F.when(F.col("partitioning") == "WHOLE_WORLD", "world").otherwise(F.col("tile_id"))).distinct()
    valid = F
    for name in tiles.PATTERNS:
        valid = valid.when(F.col("partitioning") == name, tiles.is_valid(F.col("tile_id"), name))
    reason = F.when(F.col("partitioning").isNull(), "unknown dataset").when(~F.coalesce(valid.otherwise(F.lit(False)), F.lit(False)), "invalid tile id")
    return own.select("dataset", "tile_id", reason.alias("reason"))


def ingest_tiles(spark: SparkSession, source: Source, root: str, tile_ids: list[str], read: Callable[[str], DataFrame], overwrite: bool = False) -> dict[str, str | Exception]:
    """Ingests a gridded source tile by tile: the path of each tile, or why it failed; a failure stops no other tile.

    A whole-world source is the one tile ``world``. Ids that do not fit the source's partitioning are an error. Tiles that are there
    are left alone unless ``overwrite``. ``read`` gives (tile_id, row, col, bands) of a tile, and each tile is one distributed job.
    """
    ids = ["world"] if source.partitioning == "WHOLE_WORLD" else list(dict.fromkeys(tile_ids))
    if bad := [t for t in ids if not re.fullmatch(tiles.PATTERNS[source.partitioning], t)]:
        raise ValueError(f"{source.name}: invalid tile ids {', '.join(bad)}")
    path = source.path(root)
    results: dict[str, str | Exception] = {}
    for tile_id in ids:
        own = f"{path}/tile_id={tile_id}"
        try:
            if overwrite or not folder_exists(spark, own):
                write_pixels(read(tile_id).filter(F.col("tile_id") == tile_id).select("tile_id", "row", "col", *source.bands), path)
                if not folder_exists(spark, own):
                    raise ValueError(f"{source.name}: no pixels of tile {tile_id}")
            results[tile_id] = own
        except Exception as failure:  # whatever a reader or the job raises is this tile's result
            results[tile_id] = failure
    return results


MANIFEST = "dataset string, tile_id string, status string, reason string, n_rows long, run int"


def manifest_path(source: Source, root: str) -> str:
    return f"{root}/_manifest/{source.name}/{source.product}"


def read_manifest(spark: SparkSession, source: Source, root: str) -> DataFrame:
    """(dataset, tile_id, status, reason, n_rows, run): what each run did with each tile; no rows before the first run."""
    path = manifest_path(source, root)
    return spark.read.schema(MANIFEST).parquet(path) if folder_exists(spark, path) else spark.createDataFrame([], MANIFEST)


def pixel_problem(n: int, key: tuple[str, ...] = ("row", "col")) -> Column:
    """Why a pixel row is refused, NULL if it is fine: no place, or one outside of a tile of ``n`` pixels a side."""
    known = F.greatest(*[F.col(c).isNull().cast("int") for c in key]) == 0
    inside = F.least(*key) >= 0
    return F.when(~known, "no place").when(~(inside & (F.greatest(*key) < n)), "outside of its tile")


def ingest_missing(spark: SparkSession, source: Source, root: str, wanted: DataFrame, rows: DataFrame, n: int, overwrite: bool = False) -> DataFrame:
    """Ingests all missing tiles of a gridded source in one job; the manifest rows of this run, which are appended to the manifest.

    ``wanted``: (tile_id); ``rows``: (tile_id, row, col, bands) of any tiles. What the manifest has as done is left alone unless ``overwrite``
    (an anti-join), so a rerun does what is absent or failed. ``rows`` is read once, pruned to the tiles to do, and written once, to a
    folder of the run. A tile is published whole, by moving its folder, or not at all: one bad row, no rows, or an id that does not fit the
    partitioning make it ``failed`` with a reason, and stop no other tile. A run that is lost before it appends its manifest rows counts as none.
    """
    done = read_manifest(spark, source, root)
    run = done.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0] + 1
    asked = sort_out(wanted.select(F.lit(source.name).alias("dataset"), "tile_id"), {source.name: source.partitioning})
    todo = to_ingest(asked, done.filter("status = 'done'").select("dataset", "tile_id").distinct(), overwrite)
    # a name for each tile of one source: 64,800 at most, of one degree
    states = {r["tile_id"]: r["reason"] for r in todo.select("tile_id", "reason").collect()}
    valid = sorted(t for t, reason in states.items() if reason is None)
    path, staged = source.path(root), f"{root}/_staged/{source.name}/{source.product}/run-{run}"
    own = rows.filter(F.col("tile_id").isin(valid)).select("tile_id", "row", "col", *source.bands).withColumn("problem", pixel_problem(n))
    write_pixels(own, staged)
    written = spark.read.schema("row int, problem string, tile_id string").parquet(staged)
    counts = {r["tile_id"]: (r["n"], r["problem"]) for r in written.groupBy("tile_id").agg(F.count("*").alias("n"), F.min("problem").alias("problem")).collect()}
    out = []
    for tile_id, reason in sorted(states.items()):
        rows_of, problem = counts.get(tile_id, (0, "no pixels"))
        reason = reason or problem
        if reason is None:
            move_folder(spark, f"{staged}/tile_id={tile_id}", f"{path}/tile_id={tile_id}")
        out.append((source.name, tile_id, "failed" if reason else "done", reason, None if reason else rows_of, run))
    delete_folder(spark, staged)
    made = spark.createDataFrame(out, MANIFEST)
    made.coalesce(1).write.mode("append").parquet(manifest_path(source, root))
    return made


def _hadoop(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder in the place of another: its files are not read."""
    system, folder = _hadoop(spark, source)
    place = spark._jvm.org.apache.hadoop.fs.Path(target)
    system.delete(place, True)
    system.mkdirs(place.getParent())
    if not system.rename(folder, place):
        raise OSError(f"{source} was not moved to {target}")


def delete_folder(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop(spark, path)
    system.delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def grid_problems(meta: DataFrame) -> DataFrame:
    """Reason why each raster's metadata (epsg, width, height, step_x, step_y) is refused, NULL if it is fine."""
    c = F.col
    reason = F.when(~c("epsg").eqNullSafe(4326), "not EPSG 4326").when(~F.coalesce((c("width") > 0) & (c("height") > 0), F.lit(False)), "empty")
    reason = reason.when(~F.coalesce(c("step_x") > 0, F.lit(False)), "x step").when(~F.coalesce(c("step_y") < 0, F.lit(False)), "y step")
    return meta.select("*", reason.alias("reason"))


def missing_tiles(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required (dataset, tile_id) without data."""
    return required.select("dataset", "tile_id").distinct().join(present, ["dataset", "tile_id"], "left_anti")


def refuse_missing(required: DataFrame, present: DataFrame, ignore: bool) -> DataFrame:
    """The missing tiles if they may be ignored; the first one as an error otherwise."""
    missing = missing_tiles(required, present)
    if not ignore and (row := missing.first()):
        raise FileNotFoundError(f"{row['dataset']}: no tile {row['tile_id']}")
    return missing


def parse_yields(raw: DataFrame, states: DataFrame) -> DataFrame:
    """Survey rows (state_fips_code, year, commodity_desc, value as text) to kg a hectare; suppressed values and unknown states go."""
    pounds = F.create_map(*[F.lit(x) for pair in k.LB_PER_BUSHEL.items() for x in pair])
    own = raw.filter(~F.col("value").isin(k.SUPPRESSED)).join(states, "state_fips_code")
    bushels = F.regexp_replace("value", ",", "").cast("double")
    kg = bushels * F.try_element_at(pounds, F.col("commodity_desc")) * k.KG_PER_LB / k.HA_PER_ACRE
    return own.select("admin_id", F.col("commodity_desc").alias("crop_name"), "year", kg.alias("yield_kg_per_ha"))


def us_states() -> list[tuple[int, str]]:
    """(FIPS code, admin id) of the 51 states."""
    return list(k.US_STATES.items())


def exact_merge(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("tile_id", "row", "col")) -> DataFrame:
    """Inner join of two gridded tables that must have the same pixels; a pixel that only one has is an error.

    Tables of ``write_for_merges`` with the same number of buckets are joined where they lie; others are shuffled by the keys.
    """
    a, b = left.withColumn("_a", F.lit(1)), right.withColumn("_b", F.lit(1))
    both = a.join(b, list(keys), "full_outer")
    ok = F.when(F.col("_a").isNull() | F.col("_b").isNull(), F.raise_error(F.lit("grids differ"))).otherwise(F.lit(True))
    return both.filter(ok).drop("_a", "_b")


def merge_layers(layers: list[DataFrame], keys: tuple[str, ...] = ("tile_id", "row", "col")) -> DataFrame:
    """All layers by pixel, with one shuffle whatever their number; a pixel that not every layer has once is an error.

    Layers are united, each row with its own bands and a bit for its layer, and added up by pixel. All columns but the keys are bands.
    """
    bands = [[c for c in df.columns if c not in keys] for df in layers]
    kinds = {c: f.dataType for df, own in zip(layers, bands, strict=True) for c, f in ((f.name, f) for f in df.schema.fields) if c in own}
    if len(kinds) < sum(map(len, bands)):
        raise ValueError("layers have bands of one name")
    rows = None
    for i, (df, own) in enumerate(zip(layers, bands, strict=True)):
        part = df.select(*keys, F.lit(1 << i).cast("long").alias("_layer"), *[(F.col(c) if c in own else F.lit(None).cast(kind)).alias(c) for c, kind in kinds.items()])
        rows = part if rows is None else rows.unionAll(part)
    both = rows.groupBy(*keys).agg(F.bit_or("_layer").alias("_all"), F.count("*").alias("_n"), *[F.max(c).alias(c) for c in kinds])
    whole = (F.col("_all") == (1 << len(layers)) - 1) & (F.col("_n") == len(layers))
    return both.filter(F.when(whole, True).otherwise(F.raise_error(F.lit("grids differ")))).select(*keys, *kinds)


def write_for_merges(df: DataFrame, table: str, path: str, buckets: int, keys: tuple[str, ...] = ("tile_id", "row", "col")) -> DataFrame:
    """A gridded layer as a table bucketed by its pixels: one shuffle here, none in a merge with a layer written likewise."""
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def write_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """A tabular source, sorted by its keys."""
    df.sort(*keys).write.mode("overwrite").parquet(path)


def write_pixels(df: DataFrame, path: str, block: int = 1000) -> None:
    """A gridded stage: partitioned by tile, clustered by block, so that scans prune tiles and skip row groups. Only the tiles in ``df`` are replaced.

    Beside the blocks it stores the tile's latitude as a number, which a file holds once; names other than those of ten-degree tiles have none.
    """
    blocks = df.withColumn("block_id", block_of(F.col("row"), F.col("col"), block))
    named = tiles.is_valid(F.col("tile_id"), "TEN_DEGREE")
    blocks = blocks.withColumn(tiles.LAT, F.when(named, tiles.lat_of(F.col("tile_id"))))
    placed = blocks.repartition("tile_id", "block_id").sortWithinPartitions("tile_id", "block_id", "row", "col")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_id").parquet(path)
