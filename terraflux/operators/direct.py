"""Attribution to crops by intersecting a crop map with current cropland."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux import factors as k

MEASURES = ["crop_hectares", "peatland_crop_hectares", "peatland_occupation_emissions_mt", "emissions_mt", "forest_emissions_mt", "peatland_conversion_emissions_mt"]


def crop_codes(crops: list[str] | None = None) -> list[tuple[int, str]]:
    return [(code, name) for name, own in k.DIRECT_CROPS.items() if not crops or name in crops for code in own]


def zones_by_crops(zones: DataFrame, crops: list[str] | None = None) -> DataFrame:
    """(admin_id, crop_name): a row for every zone and crop."""
    names = F.array(*[F.lit(n) for n in dict.fromkeys(name for _, name in crop_codes(crops))])
    return zones.select("admin_id").distinct().select("admin_id", F.explode(names).alias("crop_name"))


def measured(emitted: DataFrame, by: list[str], crops: list[str] | None = None, skip_crop_filter: bool = False) -> DataFrame:
    """Six sums by ``by`` and crop_name, NULL where all is unknown; they can be added up further."""
    table = F.broadcast(emitted.sparkSession.createDataFrame(crop_codes(crops), "crop_code int, crop_name string"))
    own = emitted if skip_crop_filter else emitted.filter(F.col(f"class_{k.YEARS[-1]}") == k.CROPLAND)
    ha = F.col("ha")
    values = [ha, F.when(F.col("peat") == 1, ha), F.col("occupation") * ha, F.col("per_ha") * ha, F.col("forest_per_ha") * ha, F.col("peat_conversion_per_ha") * ha]
    return own.join(table, "crop_code").groupBy(*by, "crop_name").agg(*[F.sum(v).alias(m) for v, m in zip(values, MEASURES, strict=True)])


def direct_roll_up(emitted: DataFrame, zones: DataFrame, crops: list[str] | None = None, skip_crop_filter: bool = False) -> DataFrame:
    """Six sums per (admin_id, crop_name) from emitted pixels with admin_id, crop_code and source totals.

    ``zones`` (admin_id) x crops each have a row, with 0 where no pixel counts. Unknown layers are
    skipped one by one: a pixel of unknown total still counts its forest part.
    """
    sums = measured(emitted, ["admin_id"], crops, skip_crop_filter)
    return zones_by_crops(zones, crops).join(sums, ["admin_id", "crop_name"], "left").select("admin_id", "crop_name", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in MEASURES])
