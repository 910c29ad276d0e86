"""Shared folder, materialised intermediates and hash splits for the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.sources.stages import shared_dir

#: ASCII white space; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


_open: list[list[DataFrame]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Deletes at its end what is materialised within, but for what is to be kept."""
    made: list[DataFrame] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for df in made:
            discard(df)


def materialise(df: DataFrame, name: str, keep: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the lineage, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    if _open and not keep:
        _open[-1].append(out)
    return out


def discard(df: DataFrame) -> None:
    """Delete the files behind a DataFrame from ``materialise`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
