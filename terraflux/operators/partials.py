"""Roll-ups that follow changes: mergeable sums by tile, zone and crop, stored with the version of the tile that they come from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KEYS = ["admin_id", "crop_name"]


def changed_tiles(stored: DataFrame, versions: DataFrame) -> list[str]:
    """Tiles of ``versions`` (tile_id, version) that are not stored with that version: 648 at most, the ten-degree tiles of the world."""
    known = stored.select("tile_id", "version").distinct()
    return [r["tile_id"] for r in versions.join(known, ["tile_id", "version"], "left_anti").select("tile_id").distinct().orderBy("tile_id").collect()]


def refresh(spark: SparkSession, path: str, versions: DataFrame, sums_of: Callable[[list[str]], DataFrame], measures: list[str]) -> tuple[DataFrame, list[str]]:
    """Partial sums of all tiles of ``versions``, and the tiles that were made anew.

    ``sums_of`` gives (tile_id, admin_id, crop_name, measures) of the tiles it is asked for: the changed ones only, in one job. Their partition is
    replaced; a tile without any sum keeps a row without a zone, which tells its version. Tiles that are no longer in ``versions`` do not count.
    """
    kinds = StructType.fromDDL("admin_id string, crop_name string, " + "".join(f"{m} double, " for m in measures) + "version long, tile_id string")
    known = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = known.getFileSystem(spark._jsc.hadoopConfiguration()).exists(known)
    stored = spark.read.schema(kinds).parquet(path) if there else spark.createDataFrame([], kinds)
    tiles = changed_tiles(stored, versions)
    if tiles:
        own = F.broadcast(versions.filter(F.col("tile_id").isin(tiles)).select("tile_id", F.col("version").cast("long").alias("version")))
        sums = sums_of(tiles).select("tile_id", *KEYS, *measures).join(own, "tile_id")
        marks = own.select("tile_id", *[F.lit(None).cast("string").alias(k) for k in KEYS], *[F.lit(None).cast("double").alias(m) for m in measures], "version")
        rows = sums.unionByName(marks).select(*kinds.names)
        rows.repartition("tile_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile_id").parquet(path)
    current = F.broadcast(versions.select("tile_id", F.col("version").cast("long").alias("version")))
    return spark.read.schema(kinds).parquet(path).join(current, ["tile_id", "version"]), tiles


def totals(partials: DataFrame, every: DataFrame, measures: list[str]) -> DataFrame:
    """(admin_id, crop_name, measures) from partial sums; ``every`` (admin_id, crop_name) has a row each, 0 where nothing counts."""
    sums = partials.filter(F.col("admin_id").isNotNull()).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in measures])
    return every.join(sums, KEYS, "left").select(*KEYS, *[F.coalesce(m, F.lit(0.0)).alias(m) for m in measures])
