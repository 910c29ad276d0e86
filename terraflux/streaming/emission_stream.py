"""Emit pixel files as they arrive: the emission stage is one projection, so it streams without state."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from terraflux.operators.emit import emit


def emit_new_files(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, n: int) -> StreamingQuery:
    """Work off all pixel files that ``checkpoint`` has not seen yet, each exactly once, then stop."""
    pixels = spark.readStream.schema(schema).parquet(source)
    return emit(pixels, n).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).partitionBy("tile_id").trigger(availableNow=True).start()
