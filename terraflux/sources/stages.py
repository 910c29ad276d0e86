"""Versioned stage tables: a stage is written once under a key of its name, version and arguments, and always read back."""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.functions.tiles import LAT
from terraflux.sources.ingest import write_pixels


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a folder in the warehouse is used if there are no executors (local mode, as in tests); on a cluster
    it is an error, since the warehouse may be the driver's own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoint"


def stage_path(root: str, name: str, version: int, arguments: dict) -> str:
    key = json.dumps([name, version, arguments], sort_keys=True, default=str)
    return f"{root}/{name}/{hashlib.sha1(key.encode()).hexdigest()}"


def _exists(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def stage(spark: SparkSession, root: str, name: str, make: Callable[[], DataFrame], version: int = 0, **arguments: object) -> DataFrame:
    """The stage's table; ``make`` runs only if no complete one is there. Reading back cuts the lineage."""
    path = stage_path(root, name, version, arguments)
    if not _exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _marks(spark: SparkSession, path: str) -> tuple:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_tiles")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def tiles_present(spark: SparkSession, path: str) -> set[str]:
    """Tiles of a gridded stage that are complete: those with a mark."""
    system, folder = _marks(spark, path)
    return {x.getPath().getName() for x in system.listStatus(folder)} if system.exists(folder) else set()


def gridded_stage(
    spark: SparkSession, root: str, name: str, tile_ids: list[str], make: Callable[[list[str]], DataFrame], version: int = 0, block: int = 1000, **arguments: object
) -> DataFrame:
    """The tiles of a gridded stage (tile_id, row, col, ...), partitioned by tile; ``make`` runs for the absent ones only, all at once.

    The stage's key is its name, version and arguments, not the tiles, so calls with other tiles share what is there. A tile is there when its
    mark is, which is put after the write: what a lost run has written is written again. A tile without pixels is marked,
    too. Reading back prunes to ``tile_ids``.
    """
    path = stage_path(root, name, version, arguments)
    absent = sorted(set(tile_ids) - tiles_present(spark, path))
    if absent:
        made = make(absent)
        write_pixels(made.filter(F.col("tile_id").isin(absent)), path, block)
        system, folder = _marks(spark, path)
        for tile_id in absent:
            system.create(spark._jvm.org.apache.hadoop.fs.Path(folder, tile_id), True).close()
        _keep_schema(spark, path, made)
    return _with_schema(spark, path).filter(F.col("tile_id").isin(list(tile_ids)))


def _keep_schema(spark: SparkSession, path: str, made: DataFrame) -> None:
    """The stage's columns, written beside the tiles, so that a stage without any pixel can be read."""
    made.limit(0).withColumns({"block_id": F.lit(0).cast("long"), LAT: F.lit(0)}).coalesce(1).write.mode("overwrite").parquet(f"{path}/_columns")


def _with_schema(spark: SparkSession, path: str) -> DataFrame:
    columns = spark.read.parquet(f"{path}/_columns").schema
    return spark.read.schema(columns).parquet(path)


def cached(version: int, ignored: tuple[str, ...] = ()) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Makes a function (spark, root, ...) a stage: its key is module, qualified name, version and all arguments but ``ignored`` ones."""

    def decorate(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(make)
        if unknown := set(ignored) - set(signature.parameters):
            raise ValueError(f"no argument {', '.join(sorted(unknown))}")

        @wraps(make)
        def run(spark: SparkSession, root: str, *args: object, **kwargs: object) -> DataFrame:
            bound = signature.bind(spark, root, *args, **kwargs)
            bound.apply_defaults()
            own = list(bound.arguments)[:2]
            arguments = {k: v for k, v in bound.arguments.items() if k not in {*own, *ignored}}
            name = re.sub(r"[^\w.]", "_", f"{make.__module__}.{make.__qualname__}")
            return stage(spark, root, name, lambda: make(spark, root, *args, **kwargs), version, **{"arguments": arguments})

        return run

    return decorate
